"""Splits, quotas, caps and first rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog.common import documents, draw32_sql
from corpusloom.functions.seeded import KEY_SPAN
from corpusloom.operators.java_code import license_filter
from corpusloom.operators.selection import (
    first_n_rows, global_cap, per_repo_quota, split_column, split_sizes, three_way_split,
)
from corpusloom.sources.tables import read_table

ORDER = ["l_orderkey", "l_linenumber"]


def _split_sizes(spark, sf):
    return split_sizes(split_column(documents(spark, sf, "doc_id"), "doc_id", 0.1))


def _exact_split(spark, sf):
    return split_column(read_table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.1, exact=True)


def _three_way(spark, sf):
    return three_way_split(read_table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


def _first_rows(spark, sf):
    order = [*ORDER, "l_partkey", "l_suppkey"]
    return first_n_rows(read_table(spark, sf, "lineitem").select(*order), order, 5000)


def _first_rows_of_hashes(spark, sf):
    """Order keys over the whole span of longs, one in seven of them null."""
    rows = documents(spark, sf, "doc_id", "lang")
    sign = F.when(F.col("doc_id") % 2 == 0, 1).otherwise(-1)
    spread = (F.lit(9223372036854775807) - F.col("doc_id") * F.lit(1000000007)) * sign
    keyed = rows.withColumn("key", F.when(F.col("doc_id") % 7 != 0, spread))
    n = keyed.count()
    return first_n_rows(keyed, ["key", "doc_id"], n - n // 14)


def _quota(spark, sf):
    files = documents(spark, sf, "doc_id", "source", "text")
    return per_repo_quota(files, 30, repo="source", order=["doc_id"])


def _large_quota(spark, sf):
    """A quota above what Spark prunes by itself, over few and therefore hot groups."""
    rows = read_table(spark, sf, "lineitem").select("l_returnflag", *ORDER)
    return per_repo_quota(rows, 5000, repo="l_returnflag", order=ORDER)


def _cap(spark, sf):
    files = documents(spark, sf, "doc_id", "source", "n_chars")
    ranked = files.withColumn("repo_seq", F.substring("source", 4, 10).cast("int"))
    return global_cap(ranked, 120, ["repo_seq", "doc_id"])


def _licenses(spark, sf):
    """Documents of the sources whose license, here derived from the source's number, is allowed."""
    docs = documents(spark, sf, "doc_id", "source", "text")
    number = F.substring("source", 4, 10).cast("int") % 5
    keys = F.array(F.lit("mit"), F.lit("agpl-3.0"), F.lit("apache-2.0"), F.lit(None), F.lit("gpl"))
    repos = docs.select("source").distinct().withColumn("license_key", F.get(keys, number))
    return license_filter(docs, repos, on="source")


QUERIES = {
    "split_sizes": _split_sizes,
    "split_exact": _exact_split,
    "split_three_way": _three_way,
    "first_n_rows": _first_rows,
    "first_n_rows_hashed": _first_rows_of_hashes,
    "per_repo_quota": _quota,
    "per_repo_quota_large": _large_quota,
    "global_cap": _cap,
    "license_filter": _licenses,
}

_DRAW = draw32_sql(42, "o_orderkey")

ORACLES = {
    "split_sizes": f"""SELECT CASE WHEN {draw32_sql(42, 'doc_id')} < {0.1 * KEY_SPAN} THEN 'validation' ELSE 'train' END AS split,
      count(*) AS n_rows FROM documents GROUP BY 1""",
    "split_exact": f"""SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {_DRAW}, o_orderkey)
      <= ceil(0.1 * (SELECT count(*) FROM orders)) THEN 'validation' ELSE 'train' END AS split FROM orders""",
    "split_three_way": f"""SELECT o_orderkey, CASE WHEN {_DRAW} >= {0.2 * KEY_SPAN} THEN 'train'
      WHEN {draw32_sql('42.held', 'o_orderkey')} < {0.5 * KEY_SPAN} THEN 'test' ELSE 'validation' END AS split FROM orders""",
    "first_n_rows": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem ORDER BY ALL LIMIT 5000",
    "first_n_rows_hashed": """SELECT doc_id, lang, CASE WHEN doc_id % 7 <> 0 THEN
        (9223372036854775807 - doc_id * 1000000007) * CASE WHEN doc_id % 2 = 0 THEN 1 ELSE -1 END END AS key FROM documents
      QUALIFY row_number() OVER (ORDER BY key NULLS LAST, doc_id) <= (SELECT count(*) - count(*) // 14 FROM documents)""",
    "per_repo_quota": """SELECT doc_id, source, text FROM documents
      QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 30""",
    "per_repo_quota_large": """SELECT l_returnflag, l_orderkey, l_linenumber FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber) <= 5000""",
    "global_cap": """SELECT doc_id, source, n_chars, substr(source, 4)::INTEGER AS repo_seq FROM documents
      ORDER BY repo_seq, doc_id LIMIT 120""",
    "license_filter": "SELECT doc_id, source, text FROM documents WHERE substr(source, 4)::INTEGER % 5 IN (0, 2, 4)",
}
