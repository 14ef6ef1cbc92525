"""Sources mixed to target weights by temperature, as block permutations within a token budget.

A source's share of all tokens, raised to an exponent between 0 and 1 and normalised, is its weight: 1 keeps the
shares, 0 makes all sources equal. The exponent is found by bisection. Documents belong to numbered blocks
of their source; every pass over a source takes its blocks in an order of its own, until the source's
budget is used up.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.columns import fresh, quoted
from corpusloom.scratch import settle

BLOCKS = 1024  # of a source
PLANNED = 1 << 18  # rows of a plan that is broadcast, of some 100 bytes
STEPS = 60
TOKENS = r"[^\x20\x09-\x0D]+"


def bisect_exponent(totals: DataFrame, *, entropy: float | None = None, repeats: float | None = None) -> float:
    """The exponent for ``totals`` (one row a source, positive ``tokens``).

    With ``entropy``, a fraction of the greatest possible: the largest exponent whose weights reach it. With ``repeats``: the
    smallest at which no source is read more than that many times while the source read least is read once. Aggregates
    only: each step reads the totals, one row a source, and returns two numbers.
    """
    row = totals.agg(F.sum("tokens").alias("all"), F.count(F.lit(1)).alias("n"), F.min("tokens").alias("least"), F.max("tokens").alias("most")).first()
    if not row["n"] or row["least"] == row["most"]:
        return 1.0

    def enough(alpha: float) -> bool:
        if repeats is not None:
            return (row["most"] / row["least"]) ** (1 - alpha) <= repeats
        w = F.pow(F.col("tokens") / F.lit(float(row["all"])), F.lit(alpha))
        z, s = totals.agg(F.sum(w), F.sum(w * F.log(w))).first()
        return math.log(z) - s / z >= entropy * math.log(row["n"])

    low, high = 0.0, 1.0
    if repeats is not None:  # holds from some exponent on
        if enough(0.0):
            return 0.0
        for _ in range(STEPS):
            mid = (low + high) / 2
            low, high = (low, mid) if enough(mid) else (mid, high)
        return high
    if enough(1.0):  # holds up to some exponent
        return 1.0
    for _ in range(STEPS):
        mid = (low + high) / 2
        low, high = (mid, high) if enough(mid) else (low, mid)
    return low


def mix_sources(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                entropy: float | None = None, repeats: float | None = None, budget: int | None = None, seed: int = 5) -> DataFrame:
    """The rows of ``df``, each as often as it is read, with ``pass_no`` (from 0), ``block``, ``block_rank`` (from 1, the
    block's turn in that pass over its source) and ``n_tokens`` added.

    Give ``entropy`` (a fraction of the greatest) or ``repeats`` (most passes over a source). ``budget`` is the number of tokens
    to be read in all; unset, it is the least with which every source is read once in full, so that no row is lost. A
    token is a word between ASCII white space. A source's budget is its weight's share. Whole passes come first, then
    the blocks of one more pass as long as at least half of the next fits in; so a source misses its budget by half a block
    at most. The order of blocks is drawn anew for each pass, by a hash of seed, source, pass and block.

    Rows without source form a source of their own, apart from the empty name. Rows without tokens (null, empty or blank
    texts) have no say in weights and budgets; they are read with their block, and where a whole source has no
    tokens, once. Repeated rows are rows of their own. Names added get underscores before them where ``df`` has them
    already. An empty table gives no rows.

    Texts are not shuffled: sources and blocks are totalled in tasks first, and the plan, one row for each of at
    most ``BLOCKS`` blocks a source, is broadcast up to ``PLANNED`` rows and joined by a shuffle beyond.
    """
    if (entropy is None) == (repeats is None):
        raise ValueError("give entropy or repeats")
    tokens, block, pass_no, rank, key, turns = fresh(df, "n_tokens", "block", "pass_no", "block_rank", "source_key", "turns")
    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))
    source = F.col(quoted(source_col)).cast("string")
    keyed = df.withColumns({
        tokens: F.regexp_count(text, F.lit(TOKENS)).cast("long"),
        key: F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source)),
        block: F.pmod(F.xxhash64(F.lit(seed), F.col(quoted(id_col)).cast("string"), text), F.lit(BLOCKS)).cast("int")})
    blocks = settle(keyed.groupBy(F.col(quoted(key)).alias("source"), F.col(quoted(block)).alias("block")).agg(F.sum(quoted(tokens)).alias("tokens")))
    totals = settle(blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")))
    counted = totals.where("tokens > 0")
    alpha = bisect_exponent(counted, entropy=entropy, repeats=repeats)
    whole = float(counted.agg(F.sum("tokens")).first()[0] or 1)
    w = F.pow(F.col("tokens") / F.lit(whole), F.lit(alpha))
    z, most = (x or 1.0 for x in counted.agg(F.sum(w), F.max(F.col("tokens") / w)).first())
    share = F.round(w * F.lit(most if budget is None else budget / z)).cast("long")
    quota = share if budget is not None else F.greatest(share, F.col("tokens"))
    passes = totals.select(
        "source", F.when(F.col("tokens") > 0, F.floor(quota / F.col("tokens"))).otherwise(1).cast("int").alias("passes"),
        F.when(F.col("tokens") > 0, F.pmod(quota, F.col("tokens"))).otherwise(0).alias("left"))

    each = blocks.join(passes, "source").select("*", F.explode(F.sequence(F.lit(0), F.col("passes"))).alias("pass_no"))
    order = Window.partitionBy("source", "pass_no").orderBy(F.xxhash64(F.lit(seed), "source", "pass_no", "block"), "block")  # BLOCKS rows
    until = F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    plan = each.withColumns({"until": until, "rank": F.row_number().over(order)}).where(
        "pass_no < passes or (left > 0 and 2 * until - tokens <= 2 * left)").groupBy("source", "block").agg(
        F.collect_list(F.struct("pass_no", "rank")).alias("turns"))
    plan = settle(plan.select(F.col("source").alias("__plan_source"), F.col("block").alias("__plan_block"), F.col("turns").alias("__plan_turns")))
    plan = F.broadcast(plan) if plan.count() <= PLANNED else plan.hint("merge")
    met = keyed.join(plan, (F.col(quoted(key)) == F.col("__plan_source")) & (F.col(quoted(block)) == F.col("__plan_block")))
    return met.withColumn(turns, F.explode("__plan_turns")).select(
        *[quoted(c) for c in df.columns], F.col(quoted(turns)).getField("pass_no").alias(pass_no), quoted(block),
        F.col(quoted(turns)).getField("rank").alias(rank), quoted(tokens))
