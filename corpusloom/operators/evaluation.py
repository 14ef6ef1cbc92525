"""Scoring a table of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.text import strip


def evaluate_predictions(predictions: DataFrame) -> DataFrame:
    """From ``(input_text, target_text, pred_text, seq_log_score)``: exact match after stripping,
    and the score as a percentage with two decimals, 0 when there is none."""
    score = F.round(F.exp("seq_log_score") * 100, 2)
    return predictions.select(
        F.col("input_text").alias("input_provided"),
        (strip(F.col("pred_text")) == strip(F.col("target_text"))).alias("correct"),
        F.col("target_text").alias("expected_if_condition"),
        F.col("pred_text").alias("predicted_if_condition"),
        F.coalesce(score, F.lit(0.0)).alias("prediction_score"),
    )


def summarize(evaluated: DataFrame) -> DataFrame:
    """One row ``(n_rows, accuracy_pct, mean_score)``."""
    return evaluated.agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.avg(F.col("correct").cast("double")) * 100).alias("accuracy_pct"),
        F.avg("prediction_score").alias("mean_score"),
    )
