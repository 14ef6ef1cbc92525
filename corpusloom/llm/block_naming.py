"""Exact duplicates by naming: equal texts get the same integer, different texts never do.

Each text is cut into blocks of a fixed number of bytes. The distinct blocks are sorted and
numbered, so a block's number stands for its content; adjacent numbers are then paired, and the
distinct pairs numbered in turn, until one number is left for each text. No hash takes part in
the verdict, so there is nothing to collide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.columns import quoted
from corpusloom.scratch import settle

EDGE = 64  # bytes at either end of a text that, with its length, name it first


def _named(rows: DataFrame, *key: str) -> DataFrame:
    """Distinct ``key`` with a unique integer ``name``: numbered in sorted order within the ranges
    of the shuffle. Written, so that the numbers are drawn once."""
    return settle(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("uses")).sortWithinPartitions(*key)
                  .select(*key, F.monotonically_increasing_id().alias("name")))


def identities(texts: DataFrame, *, block_bytes: int = 8192) -> DataFrame:
    """``row_id, n_bytes, name`` of rows ``row_id, content binary``; two rows have equal content
    exactly if both ``n_bytes`` and ``name`` are equal.

    ``row_id`` must be unique. The number of blocks follows from ``n_bytes``, so texts of equal length
    finish in the same round and their names come from the same numbering. One round for each
    doubling of the longest text beyond ``block_bytes``.
    """
    size = F.octet_length("content").cast("long")
    last = F.greatest(F.ceil(size / block_bytes).cast("long") - 1, F.lit(0))
    blocks = texts.select(
        "row_id", size.alias("n_bytes"), F.posexplode(F.transform(
            F.sequence(F.lit(0).cast("long"), last),
            lambda i: F.substring(F.col("content"), (i * block_bytes + 1).cast("int"), F.lit(block_bytes)))).alias("pos", "block"))
    names = _named(blocks, "block")
    level = settle(blocks.join(names, "block").select("row_id", "n_bytes", "pos", "name"))
    done, span = [], block_bytes
    while True:
        done.append(level.where(F.col("n_bytes") <= span).select("row_id", "n_bytes", "name"))
        rest = level.where(F.col("n_bytes") > span)
        if rest.isEmpty():
            break
        # Sides of a pair meet in one aggregate; every second text position has no right side.
        pairs = rest.groupBy("row_id", "n_bytes", F.expr("cast(pos div 2 as int)").alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"))
        pairs = settle(pairs)
        level = settle(pairs.join(_named(pairs, "left", "right"), ["left", "right"]).select("row_id", "n_bytes", "pos", "name"))
        span *= 2
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def exact_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 8192,
                     carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` and the columns ``carry`` (under other names) for every row of ``df``.

    Texts are equal when identical byte for byte; null counts as the empty text. Of equal texts the row
    with the largest id stays (null is the smallest id); among repeated rows with that id, one. The
    digest is output only and decides nothing. An empty table gives no rows.

    The first round names every text by its length and its first and last bytes. A text alone in its
    class is settled: no other can equal it. Only the others are cut into blocks, so texts that occur
    once are shuffled once at most and their blocks never. A class, a block or a pair that many rows
    share is counted before the shuffle, and joined on written tables, where adaptive execution can
    split the partition it fills.
    """
    content = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).cast("binary")
    docs = df.select(F.col(quoted(id_col)).alias("doc_id"), content.alias("content"), *[F.col(quoted(c)) for c in carry])
    docs = docs.withColumns({
        "n_bytes": F.octet_length("content").cast("long"), "head": F.substring("content", 1, EDGE),
        "tail": F.expr(f"substring(content, greatest(octet_length(content) - {EDGE - 1}, 1), {EDGE})")})
    key, kept = ["n_bytes", "head", "tail"], [quoted(c) for c in carry]
    shared = settle(docs.groupBy(*key).agg(F.count(F.lit(1)).alias("uses")).where("uses > 1").select(*key))
    shared = shared.hint("merge")  # one plan at every size: a small list of classes grows with the corpus

    alone = docs.withColumn("text_sha256", F.sha2("content", 256)).drop("content").join(shared, key, "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256", *kept)

    rivals = settle(docs.join(shared, key, "left_semi").select("doc_id", "content", *kept)
                    .withColumn("row_id", F.monotonically_increasing_id()))
    named = settle(identities(rivals.select("row_id", "content"), block_bytes=block_bytes).join(
        rivals.select("row_id", "doc_id", F.sha2("content", 256).alias("text_sha256"), *kept), "row_id"))
    best = settle(named.groupBy("n_bytes", "name").agg(
        F.max(F.struct("doc_id", "row_id")).alias("best"), F.count(F.lit(1)).alias("group_size")))
    judged = named.join(best, ["n_bytes", "name"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("best.row_id")).alias("kept"), "text_sha256", *kept)
    return alone.unionByName(judged)
