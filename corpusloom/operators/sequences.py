"""Token sequences out of serialised token lists and plain text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.binding import bind
from corpusloom.functions.text import split_whitespace, strip


def token_list(code_tokens: Column) -> Column:
    """Tokens of a comma-joined list, stripped, without empty ones. Commas that were tokens, or
    stood inside one, are lost: that is the serialised form's nature."""
    stripped = F.transform(F.split(F.coalesce(code_tokens, F.lit("")), ","), strip)
    return F.array_remove(stripped, "")


def load_sequences(rows: DataFrame, id_col: str, code_tokens: str = "code_tokens") -> DataFrame:
    """``(seq_id, tokens)`` without empty sequences."""
    if code_tokens not in rows.columns:
        raise ValueError(f"the input must contain a {code_tokens!r} column")
    return _non_empty(rows, id_col, token_list(F.col(code_tokens)))


def text_sequences(rows: DataFrame, id_col: str, text: str) -> DataFrame:
    """``(seq_id, tokens)`` of whitespace-separated text, without empty sequences."""
    return _non_empty(rows, id_col, split_whitespace(F.col(text)))


def _non_empty(rows: DataFrame, id_col: str, tokens: Column) -> DataFrame:
    bound = bind(rows, "_tokens", tokens, lambda t: F.size(t) > 0)
    return bound.select(F.col(id_col).alias("seq_id"), F.col("_tokens").alias("tokens"))


def min_length(seqs: DataFrame, n: int = 2) -> DataFrame:
    return seqs.filter(F.size("tokens") >= n)
