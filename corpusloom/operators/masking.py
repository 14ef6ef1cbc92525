"""Masked input/target pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.binding import bind
from corpusloom.functions.seeded import draw32
from corpusloom.functions.text import first_non_empty, replace_first, split_whitespace
from corpusloom.operators.python_code import if_conditions

MASK = "<mask>"  # fixed value


def min_tokens_filter(df: DataFrame, text: str = "source", min_tokens: int = 3) -> DataFrame:
    """Rows whose text has at least ``min_tokens`` whitespace-separated tokens; nulls go."""
    return df.filter(F.size(split_whitespace(F.coalesce(text, F.lit("")))) >= min_tokens)


def mask_random_tokens(
    df: DataFrame, id_col: str, text: str = "source", ratio: float = 0.15, seed: int = 42
) -> DataFrame:
    """``(id, input_text, target_text)`` with a ``ratio`` share of tokens, at least one, masked.

    The masked positions are those with the smallest draws. Targets are listed in draw order,
    not text order. Each token is compared with the last accepted draw, so the work is linear
    but for one sort.
    """
    split = split_whitespace(F.coalesce(text, F.lit("")))
    tokens = bind(df, "_tokens", split, lambda t: F.size(t) >= 3).select(id_col, "_tokens")
    drawn = tokens.withColumn(
        "_draws",
        F.transform("_tokens", lambda t, i: F.struct(draw32(seed, F.col(id_col), i).alias("d"), i.alias("i"))),
    )
    n_masked = F.greatest(F.lit(1), F.floor(F.size("_tokens") * F.lit(float(ratio))).cast("int"))
    picked = drawn.withColumn("_picked", F.slice(F.sort_array("_draws"), F.lit(1), n_masked))
    picked = picked.withColumn("_last", F.element_at("_picked", -1))
    masked = F.zip_with("_tokens", "_draws", lambda t, d: F.when(d <= F.col("_last"), MASK).otherwise(t))
    targets = F.transform("_picked", lambda d: F.get("_tokens", d["i"]))
    return picked.select(
        id_col,
        F.array_join(masked, " ").alias("input_text"),
        F.array_join(targets, " ").alias("target_text"),
    )


def coalesce_text(df: DataFrame, columns: tuple[str, ...] = ("source", "code", "input"), name: str = "text") -> DataFrame:
    """Add ``name``, the first non-empty of those ``columns`` that exist; drop rows without any."""
    present = [F.col(c) for c in columns if c in df.columns]
    return df.withColumn(name, first_non_empty(*present)).filter(F.col(name).isNotNull())


def if_eligible(df: DataFrame, code: str = "code", conditions: str = "conditions") -> DataFrame:
    """Rows that mention ``if`` and have a condition."""
    return df.filter(F.col(code).contains("if") & (F.size(conditions) > 0))


def pick_condition(conditions: Column, seed: int, id_col: str) -> Column:
    return F.get(conditions, F.pmod(draw32(seed, F.col(id_col)), F.size(conditions)).cast("int"))


def mask_picked(df: DataFrame, code: str, conditions: str, id_col: str, seed: int = 42) -> DataFrame:
    """Mask one condition per row: its first textual occurrence, wherever that is."""
    target = pick_condition(F.col(conditions), seed, id_col)
    return df.withColumn("target_text", target).withColumn(
        "input_text", replace_first(F.col(code), F.col("target_text"), MASK)
    )


def mask_if_condition(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """Rows with an ``if``, plus ``input_text`` and ``target_text``.

    The code is the first non-empty of ``source`` and ``code``. Texts without ``if`` are dropped
    before the parser sees them.
    """
    kept = df.columns
    present = [F.col(c) for c in ("source", "code") if c in df.columns]
    coded = bind(df, "_code", first_non_empty(*present), lambda c: c.contains("if"))
    parsed = coded.withColumn("_conditions", if_conditions(F.col("_code")))
    eligible = if_eligible(parsed, "_code", "_conditions")
    return mask_picked(eligible, "_code", "_conditions", id_col, seed).select(*kept, "input_text", "target_text")
