"""Spark-native operators for preparing and measuring text and source-code corpora."""
