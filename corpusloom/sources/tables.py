"""Loading input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread_small(df: DataFrame, *by: str) -> DataFrame:
    """Repartition an input that has fewer splits than the session has cores.

    A table of one small file would otherwise keep a single core busy with all the work that
    follows the scan. Inputs with enough splits, as at scale, are returned untouched and
    are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *by) if df.rdd.getNumPartitions() < cores else df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
