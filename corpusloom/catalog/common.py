"""Inputs the queries share, and the same inputs as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.operators.sequences import text_sequences
from corpusloom.sources.tables import read_table, spread_small


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    columns = columns or ("doc_id", "text", "lang", "source", "n_chars")
    return spread_small(read_table(spark, sf, "documents").select(*columns), "doc_id")


def document_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return text_sequences(documents(spark, sf, "doc_id", "text"), "doc_id", "text")


def turn_sequences(spark: SparkSession, sf: str) -> DataFrame:
    turns = read_table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    return text_sequences(spread_small(turns, "id"), "id", "text")


def benchmark_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return text_sequences(read_table(spark, sf, "benchmark"), "item_id", "text")


_WORDS = r"list_filter(string_split_regex(text, '[ \t\r\n]+'), lambda x: x <> '')"
DOC_SEQS = f"doc_seqs AS (SELECT doc_id AS seq_id, {_WORDS} AS toks FROM documents WHERE len({_WORDS}) > 0)"
TURN_SEQS = (
    f"turn_seqs AS (SELECT conv_id * 1000 + turn AS seq_id, {_WORDS} AS toks FROM conversations WHERE len({_WORDS}) > 0)"
)
BENCH_SEQS = f"bench_seqs AS (SELECT item_id AS seq_id, {_WORDS} AS toks FROM benchmark WHERE len({_WORDS}) > 0)"


def draw32_sql(seed: int | str, *key: str) -> str:
    text = " || ':' || ".join([f"'{seed}'", *[f"({k})::VARCHAR" for k in key]])
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


def wide_draw_sql(seed: int | str, *key: str) -> str:
    text = " || ':' || ".join([f"'{seed}'", *[f"({k})::VARCHAR" for k in key]])
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def windows_sql(name: str, seqs: str, n: int, where: str = "") -> str:
    """Two CTEs: tokens with positions, and ``name(seq_id, ctx, nxt)`` with the context joined by spaces."""
    lags = [f"coalesce(lag(tok, {i}) OVER w, '<BOS>')" for i in range(n - 1, 0, -1)]
    return f"""{name}_toks AS (
      SELECT seq_id, unnest(list_append(toks, '<EOS>')) AS tok,
             generate_subscripts(list_append(toks, '<EOS>'), 1) AS pos FROM {seqs} {where}),
    {name} AS (
      SELECT seq_id, {" || ' ' || ".join(lags)} AS ctx, tok AS nxt
      FROM {name}_toks WINDOW w AS (PARTITION BY seq_id ORDER BY pos))"""


def vocab_sql(seqs: str) -> str:
    return f"(SELECT unnest(toks) AS token FROM {seqs} UNION SELECT '<BOS>' UNION SELECT '<EOS>')"
