"""Training counts over a stream of sequences.

Training only adds up counts. Each micro-batch is counted by the batch operator and written as a
part of its own, named by the batch, so a retried batch replaces its part instead of counting
twice. There is no streaming state that would grow with the vocabulary, and nothing passes
through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.ngram_counts import pair_counts


def stream_pair_counts(seqs: DataFrame, n: int, path: str, checkpoint: str) -> StreamingQuery:
    """Count everything that has arrived and stop; start again to go on from there."""

    def count(batch: DataFrame, batch_id: int) -> None:
        pair_counts(batch, n).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        seqs.writeStream.foreachBatch(count)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_streamed_counts(spark: SparkSession, path: str) -> DataFrame:
    """Counts over all micro-batches so far."""
    parts = spark.read.parquet(path)
    return parts.groupBy("n", "ctx", "next").agg(F.sum("c").alias("c"))
