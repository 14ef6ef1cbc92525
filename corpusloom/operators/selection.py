"""Splits, quotas, and exact selection of the first rows, without a global sort."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusloom.functions.seeded import KEY_SPAN, draw32

_HISTOGRAM = 1 << 14
_GROUP_LIMIT = 1000  # largest rank Spark prunes map-side by default


def prefix_predicate(df: DataFrame, order: Sequence[str], n: int) -> Column:
    """Predicate that holds for exactly the first ``n`` rows by integer columns that identify a row."""
    before, _, missing = _prefix(df, order, n)
    if missing:
        raise ValueError(f"order columns {list(order)} do not identify a row")
    return before


def _prefix(df: DataFrame, order: Sequence[str], n: int) -> tuple[Column, Column, int]:
    """Predicates for the rows surely among the first ``n`` and for those that tie for the last
    places, and how many of the latter belong.

    Finds the n-th smallest key by narrowing a range with histograms of at most 16,384
    counts, one order column after the other; nulls come last. Rows are never sorted, shuffled or
    sent to a single task, and each later pass pushes its narrower range into the scan.
    """
    kinds = dict(df.dtypes)
    for name in order:
        if kinds[name] not in ("tinyint", "smallint", "int", "bigint"):
            raise TypeError(f"order column {name} is {kinds[name]}; integers are needed")
    if n <= 0:
        return F.lit(False), F.lit(False), 0
    scope, wanted = df.select(*[F.col(_quoted(o)) for o in order]), n
    equal, clauses = F.lit(True), []
    for name in order:
        c = F.col(_quoted(name))
        total, present, low, high = scope.agg(F.count(F.lit(1)), F.count(c), F.min(c), F.max(c)).first()
        if total <= wanted:
            clauses.append(equal)
            wanted = 0
            break
        if present <= wanted:  # all that have a value, and some of those without
            clauses.append(equal & c.isNotNull())
            wanted -= present
            if wanted == 0:
                break
            equal, scope = equal & c.isNull(), scope.filter(c.isNull())
            continue
        while low < high:
            width = (high - low) // _HISTOGRAM + 1
            # The whole span of longs does not fit a long.
            slot = F.expr(f"cast((cast({_quoted(name)} as decimal(20,0)) - cast('{low}' as decimal(20,0))) div cast('{width}' as decimal(20,0)) as bigint)")
            counts = dict(
                scope.filter(c.between(low, high)).groupBy(slot.alias("slot")).count().collect()
            )
            for s in sorted(counts):
                if counts[s] > wanted:
                    break
                wanted -= counts[s]
            low, high = low + s * width, min(high, low + s * width + width - 1)
        clauses.append(equal & (c < low))
        if wanted == 0:
            break
        equal, scope = equal & (c == low), scope.filter(c == low)
    return reduce(lambda x, y: x | y, clauses), equal, wanted


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def first_n_rows(df: DataFrame, order: Sequence[str], n: int | None = None) -> DataFrame:
    """The first ``n`` rows by the integer columns ``order``, nulls last; all rows when there are fewer, or without ``n``.

    Of rows that tie for the last places, any are taken.
    """
    if n is None:
        return df
    before, ties, missing = _prefix(df, order, n)
    rows = df.filter(before)
    return rows.unionByName(df.filter(ties).limit(missing)) if missing else rows


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, spread: Sequence[str]
) -> DataFrame:
    """The first ``n`` rows of every group by ``order``.

    Up to rank 1000 Spark itself prunes groups before the shuffle. Above that, a hot group is
    first cut down in as many parts as a shuffle has, spread by the columns ``spread``; the first n of
    the group are among the first n of its parts.
    """
    if n > _GROUP_LIMIT:
        salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = df.withColumn("_part", F.pmod(F.xxhash64(*spread), F.lit(max(salts, 2))))
        ranked = parts.withColumn(
            "_rank", F.row_number().over(W.partitionBy(*keys, "_part").orderBy(*order))
        )
        df = ranked.filter(F.col("_rank") <= n).drop("_rank", "_part")
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def per_repo_quota(
    df: DataFrame, quota: int, repo: str = "repo_name",
    order: Sequence[str] = ("commit_seq", "file_seq", "method_seq"),
) -> DataFrame:
    """At most ``quota`` rows per repository, in commit, file and method order."""
    return top_n_per_group(df, [repo], [F.col(o) for o in order], quota, spread=order)


def global_cap(
    df: DataFrame, limit: int | None,
    order: Sequence[str] = ("repo_seq", "commit_seq", "file_seq", "method_seq"),
) -> DataFrame:
    """At most ``limit`` rows over all repositories (``None``: all), in repository order, nulls last."""
    return first_n_rows(df, order, limit)


def split_column(
    df: DataFrame, id_col: str, ratio: float, seed: int = 42,
    names: tuple[str, str] = ("train", "validation"), exact: bool = False,
) -> DataFrame:
    """Add ``split``: ``names[1]`` for a ``ratio`` share of rows, ``names[0]`` for the rest.

    By default each row decides for itself, so nothing moves and sizes are near the ratio.
    ``exact`` holds out ``ceil(ratio * rows)`` rows, those with the smallest draws; ties in
    the 32-bit draw are settled by the integer id.
    """
    draw = draw32(seed, F.col(id_col))
    if not exact:
        held = draw < F.lit(ratio * KEY_SPAN)
        return df.withColumn("split", F.when(held, names[1]).otherwise(names[0]))
    drawn = df.withColumn("_draw", draw)
    held = prefix_predicate(drawn, ["_draw", id_col], math.ceil(ratio * df.count()))
    return drawn.withColumn("split", F.when(held, names[1]).otherwise(names[0])).drop("_draw")


def three_way_split(df: DataFrame, id_col: str, seed: int = 42, held_out: float = 0.2) -> DataFrame:
    """80/10/10: hold out ``held_out``, then halve that with a second, independent draw."""
    outer = draw32(seed, F.col(id_col)) < F.lit(held_out * KEY_SPAN)
    inner = draw32(f"{seed}.held", F.col(id_col)) < F.lit(0.5 * KEY_SPAN)
    label = F.when(~outer, "train").when(inner, "test").otherwise("validation")
    return df.withColumn("split", label)


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
