"""Places and running sums of rows inside groups of any size, by range partitions.

Rows are sorted by range, so a group of a third of all rows lies in many partitions. A row's sums are those inside its
partition, plus what the group has in earlier partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.scratch import settle

PART_BITS = 33  # rows of a partition that monotonically_increasing_id numbers


def laid_out(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` written in the order of the columns ``order`` (nulls first) with ``place``, which ascends with it.

    ``order`` ends with a column that no rows share, so that no value is too common for a range.
    """
    n_ranges = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return settle(df.repartitionByRange(n_ranges, *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()))


def part_of(place: str = "place") -> Column:
    return F.shiftright(place, PART_BITS)


def ranked(rows: DataFrame, group: str) -> DataFrame:
    """``rows``, from ``laid_out`` with ``group`` first in order, with ``rank`` in the group from 0 and ``n``, its rows.

    What is joined has one row for each partition and group in it. Null is a group.
    """
    here = rows.groupBy(part_of().alias("p_part"), F.col(group).alias("p_group")).agg(F.min("place").alias("p_first"), F.count(F.lit(1)).alias("p_rows"))
    whole = Window.partitionBy("p_group")
    so_far = whole.orderBy("p_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(here.select("p_part", "p_group", "p_first", F.coalesce(F.sum("p_rows").over(so_far), F.lit(0)).alias("p_before"), F.sum("p_rows").over(whole).alias("n")))
    joined = rows.join(starts, (part_of() == F.col("p_part")) & F.col(group).eqNullSafe(F.col("p_group")))
    return joined.select(*rows.columns, (F.col("place") - F.col("p_first") + F.col("p_before")).alias("rank"), "n")


def summed(rows: DataFrame, groups: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``rows``, from ``laid_out`` with ``groups`` (no nulls) first in order, with ``before_<value>``: its sum over the group's earlier rows.

    Only the first group of a partition can have begun in an earlier one, so what is broadcast has at most two rows a partition.
    """
    part = rows.withColumn("p_part", part_of())
    key = F.struct(*groups)
    ends = part.groupBy("p_part").agg(F.min_by(key, "place").alias("p_first"), F.max_by(key, "place").alias("p_last"))
    edge = part.join(F.broadcast(ends), "p_part").where((key == F.col("p_first")) | (key == F.col("p_last")))
    sums = edge.groupBy("p_part", *groups).agg(*[F.sum(v).alias(f"p_{v}") for v in values])
    so_far = Window.partitionBy(*groups).orderBy("p_part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = settle(sums.select("p_part", *groups, *[F.sum(f"p_{v}").over(so_far).alias(f"p_{v}") for v in values]))
    inside = Window.partitionBy("p_part", *groups).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    own = part.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"own_{v}") for v in values])
    joined = own.join(F.broadcast(earlier), ["p_part", *groups], "left")
    return joined.select(*rows.columns, *[(F.col(f"own_{v}") + F.coalesce(f"p_{v}", F.lit(0))).alias(f"before_{v}") for v in values])
