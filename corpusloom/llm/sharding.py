"""Contiguous shards of near-equal bytes, cut from global prefix sums.

Rows are range-partitioned by their order key; each partition's total is one row of a small
table, whose running sum tells every partition where it starts. No row meets more than its own
partition, and no task sees all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.columns import quoted
from corpusloom.scratch import settle


def byte_shards(df: DataFrame, n_shards: int = 8, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``df``.

    The size of a row is the UTF-8 bytes of its text (null: none) plus 1. Rows are laid out by id
    (null first), then checksum and size; rows alike in all three are interchangeable and are told
    apart by their place in the input. The row whose middle byte lies in ``[k, k + 1) / n_shards``
    of all bytes goes to shard k, so a shard's bytes miss their target by less than half a row at
    either end. ``slot`` counts a shard's rows from 0 without gaps. An empty table gives no rows;
    more shards than rows leaves some shards empty.

    Native throughout. A hot id cannot fill one range, as the place in the input is part of the
    range key. Sums are longs: good for 10^18 / (2 * n_shards) bytes.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))
    rows = df.select(
        F.col(quoted(id_col)).alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("place"))
    order = ["doc_id", "text_crc32", "size", "place"]
    n_ranges = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # The range number is written down: computed twice, sampled range bounds could differ.
    ranged = settle(rows.repartitionByRange(n_ranges, *order).withColumn("part", F.spark_partition_id()))

    totals = ranged.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range, n_ranges at most
    starts = totals.select(
        "part", F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("part_bytes").over(Window.partitionBy()).alias("all_bytes"))

    inside = Window.partitionBy("part").orderBy(*order)
    placed = ranged.select(
        "*", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("up_to"),
        F.row_number().over(inside).alias("row"),
    ).join(F.broadcast(starts), "part").select(
        "doc_id", "size", "text_crc32", (F.col("rows_before") + F.col("row") - 1).alias("at"),
        F.expr(f"cast(((2 * (bytes_before + up_to) - size) * {int(n_shards)}) div (2 * all_bytes) as int)").alias("shard"))
    cut = settle(placed)
    firsts = cut.groupBy("shard").agg(F.min("at").alias("first"))
    return cut.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("at") - F.col("first")).alias("slot"))
