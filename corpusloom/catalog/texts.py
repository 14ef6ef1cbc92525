"""Text helpers, row filters, random masking and scoring of predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog.common import documents, draw32_sql
from corpusloom.functions.text import (
    first_non_empty, line_count, newline_count, replace_first, repo_full_name, repo_short_name, split_whitespace, strip,
)
from corpusloom.operators.evaluation import evaluate_predictions, summarize
from corpusloom.operators.masking import coalesce_text, mask_random_tokens, min_tokens_filter
from corpusloom.operators.sequences import load_sequences, min_length, text_sequences
from corpusloom.sources.tables import read_table


def _strip(spark, sf):
    """Texts with white space put around them, stripped again."""
    padded = F.concat(F.lit(" \n\t"), "text", F.lit("\r\n  "))
    return documents(spark, sf, "doc_id", "text").select("doc_id", strip(padded).alias("text"))


def _counts(spark, sf):
    return documents(spark, sf, "doc_id", "text").select(
        "doc_id",
        line_count(F.col("text")).cast("bigint").alias("n_lines"),
        newline_count(F.col("text")).cast("bigint").alias("n_newlines"),
        F.size(split_whitespace(F.col("text"))).cast("bigint").alias("n_words"),
    )


def _replace_first(spark, sf):
    return documents(spark, sf, "doc_id", "text").select(
        "doc_id", replace_first(F.col("text"), F.lit("."), "<mask>").alias("text")
    )


def _repo_names(spark, sf):
    host = F.when(F.col("doc_id") % 2 == 0, "git@host.net:").otherwise("https://host.net/")
    end = F.when(F.col("doc_id") % 2 == 0, ".git").otherwise("")
    url = F.concat(host, "source", F.lit("/"), "lang", F.lit("-"), "doc_id", end)
    return documents(spark, sf, "doc_id", "lang", "source").select(
        "doc_id", repo_short_name(url).alias("repo"), repo_full_name(url).alias("full_name")
    )


def _with_gaps(spark, sf):
    """Documents whose text is found in one of three columns, empty or missing in the others."""
    return documents(spark, sf, "doc_id", "text", "lang").select(
        "doc_id",
        F.when(F.col("doc_id") % 3 == 0, F.col("text")).when(F.col("doc_id") % 3 == 1, "").alias("source"),
        F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise("").alias("code"),
        F.when(F.col("doc_id") % 5 == 0, F.col("text")).alias("input"),
    )


def _coalesce(spark, sf):
    return coalesce_text(_with_gaps(spark, sf)).select("doc_id", "text")


def _first_non_empty(spark, sf):
    return _with_gaps(spark, sf).select("doc_id", first_non_empty(F.col("source"), F.col("code")).alias("text"))


def _min_tokens(spark, sf):
    turns = read_table(spark, sf, "conversations").select("conv_id", "turn", F.col("text").alias("source"))
    return min_tokens_filter(turns, "source", 60)


def _min_length(spark, sf):
    turns = read_table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("head")
    )
    return min_length(text_sequences(turns, "id", "head"), 60).select("seq_id", F.size("tokens").cast("bigint").alias("n"))


def _load_sequences(spark, sf):
    """Texts read as comma-joined token lists, some with empty tokens, some missing."""
    listed = F.when(F.col("doc_id") % 11 == 0, None).when(F.col("doc_id") % 13 == 0, " ,, ").otherwise(
        F.concat("text", F.lit(", ,"), "lang")
    )
    rows = documents(spark, sf, "doc_id", "text", "lang").withColumn("code_tokens", listed)
    return load_sequences(rows, "doc_id").select("seq_id", F.array_join("tokens", "|").alias("tokens"))


def _mask_tokens(spark, sf):
    return mask_random_tokens(documents(spark, sf, "doc_id", "text"), "doc_id", "text")


def _predictions(spark, sf):
    docs = documents(spark, sf)
    return docs.select(
        F.col("text").alias("input_text"),
        F.concat(F.lit(" "), "source").alias("target_text"),
        F.when(F.col("doc_id") % 3 == 0, F.concat("source", F.lit("\n"))).otherwise(F.col("lang")).alias("pred_text"),
        F.when(F.col("doc_id") % 4 != 0, -F.col("n_chars") / F.lit(1000.0)).alias("seq_log_score"),
    )


def _evaluate(spark, sf):
    return evaluate_predictions(_predictions(spark, sf))


def _summary(spark, sf):
    scores = summarize(evaluate_predictions(_predictions(spark, sf)))
    return scores.select("n_rows", F.round("accuracy_pct", 6).alias("accuracy_pct"), F.round("mean_score", 6).alias("mean_score"))


QUERIES = {
    "strip": _strip,
    "text_counts": _counts,
    "replace_first": _replace_first,
    "repo_names": _repo_names,
    "coalesce_text": _coalesce,
    "first_non_empty": _first_non_empty,
    "min_tokens_filter": _min_tokens,
    "seq_min_length": _min_length,
    "load_sequences": _load_sequences,
    "mask_random_tokens": _mask_tokens,
    "evaluate_predictions": _evaluate,
    "evaluation_summary": _summary,
}

_SPLIT = r"list_filter(string_split_regex({t}, '[ \t\r\n]+'), lambda x: x <> '')"
_GAPS = """gaps AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN '' END AS source,
  CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END AS code, CASE WHEN doc_id % 5 = 0 THEN text END AS input FROM documents)"""
_EVAL = """preds AS (SELECT text AS input_provided, doc_id % 3 = 0 AS correct, ' ' || source AS expected_if_condition,
  CASE WHEN doc_id % 3 = 0 THEN source || chr(10) ELSE lang END AS predicted_if_condition,
  CASE WHEN doc_id % 4 <> 0 THEN round(exp(-n_chars / 1000.0::DOUBLE) * 100, 2) ELSE 0.0 END AS prediction_score FROM documents)"""

ORACLES = {
    "strip": r"SELECT doc_id, regexp_replace(regexp_replace(text, '^[ \t\r\n]+', ''), '[ \t\r\n]+$', '') AS text FROM documents",
    "text_counts": rf"""SELECT doc_id,
      length(text) - length(replace(text, chr(10), '')) + CASE WHEN text = '' OR text LIKE '%' || chr(10) THEN 0 ELSE 1 END AS n_lines,
      length(text) - length(replace(text, chr(10), '')) + 1 AS n_newlines, len({_SPLIT.format(t='text')}) AS n_words FROM documents""",
    "replace_first": """SELECT doc_id, CASE WHEN position('.' IN text) = 0 THEN text ELSE
      substr(text, 1, position('.' IN text) - 1) || '<mask>' || substr(text, position('.' IN text) + 1) END AS text FROM documents""",
    "repo_names": """SELECT doc_id, lang || '-' || doc_id AS repo, source || '/' || lang || '-' || doc_id AS full_name FROM documents""",
    "coalesce_text": f"""WITH {_GAPS} SELECT doc_id, coalesce(nullif(source, ''), nullif(code, ''), nullif(input, '')) AS text
      FROM gaps WHERE coalesce(nullif(source, ''), nullif(code, ''), nullif(input, '')) IS NOT NULL""",
    "first_non_empty": f"WITH {_GAPS} SELECT doc_id, coalesce(nullif(source, ''), nullif(code, '')) AS text FROM gaps",
    "min_tokens_filter": f"""SELECT conv_id, turn, text AS source FROM conversations
      WHERE len({_SPLIT.format(t='text')}) >= 60""",
    "seq_min_length": f"""SELECT conv_id * 1000 + turn AS seq_id, len({_SPLIT.format(t='text')}) AS n FROM conversations
      WHERE len({_SPLIT.format(t='text')}) >= 60""",
    "load_sequences": r"""WITH parts AS (SELECT doc_id AS seq_id,
        list_filter(list_transform(string_split(text || ', ,' || lang, ','),
          lambda x: regexp_replace(regexp_replace(x, '^[ \t\r\n]+', ''), '[ \t\r\n]+$', '')), lambda x: x <> '') AS toks
      FROM documents WHERE doc_id % 11 <> 0 AND doc_id % 13 <> 0)
      SELECT seq_id, array_to_string(toks, '|') AS tokens FROM parts WHERE len(toks) > 0""",
    "mask_random_tokens": f"""WITH t AS (SELECT doc_id, {_SPLIT.format(t='text')} AS toks FROM documents),
      u AS (SELECT doc_id, len(toks) AS n, unnest(toks) AS tok, generate_subscripts(toks, 1) - 1 AS i FROM t WHERE len(toks) >= 3),
      r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY {draw32_sql(42, 'doc_id', 'i')}, i) AS rk,
        greatest(1, floor(n * 0.15::DOUBLE)) AS m FROM u)
      SELECT doc_id, string_agg(CASE WHEN rk <= m THEN '<mask>' ELSE tok END, ' ' ORDER BY i) AS input_text,
        string_agg(tok, ' ' ORDER BY rk) FILTER (WHERE rk <= m) AS target_text FROM r GROUP BY doc_id""",
    "evaluate_predictions": f"WITH {_EVAL} SELECT * FROM preds",
    "evaluation_summary": f"""WITH {_EVAL} SELECT count(*) AS n_rows, round(avg(correct::INTEGER) * 100, 6) AS accuracy_pct,
      round(avg(prediction_score), 6) AS mean_score FROM preds""",
}
