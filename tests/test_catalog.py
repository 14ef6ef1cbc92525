"""Queries beside their SQL on the smallest tables; check.py does all of them on larger ones."""

import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from check import TABLES, canonical
from corpusloom.catalog import predictions
from corpusloom.scratch import scratch_root

FOLDER = "/root/testdata/sf0.001"
QUICK = [
    "ngram_pair_counts", "vocabulary", "ngram_perplexity", "build_contexts", "split_sizes", "split_exact", "first_n_rows",
    "per_repo_quota_large", "license_filter", "text_counts", "coalesce_text", "load_sequences", "mask_random_tokens",
    "clean_comments", "lexable_filter", "tokenize_java", "java_method_rows", "extract_python_functions", "mask_if_condition",
    "pretoken_counts", "symbol_pair_counts", "frame_template", "truncate_pad", "escaped_csv_round_trip", "write_function_csv",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


def test_names():
    queries, oracles = spark_entry.queries(), spark_entry.oracle_sql()
    assert set(oracles) <= set(queries) and set(QUICK) <= set(oracles)


@pytest.mark.parametrize("name", QUICK)
def test_agrees_with_sql(spark, name):
    df = spark_entry.queries()[name](spark, FOLDER)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    cursor = con.execute(spark_entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    ours, theirs = canonical([tuple(r) for r in df.collect()], df.columns), canonical(cursor.fetchall(), columns)
    assert len(ours) == len(theirs) and ours == theirs


def test_records_leave_only_their_file(spark, monkeypatch):
    """The model's and the walks' tables go once the records are written."""
    monkeypatch.setattr(predictions, "MAX_LEN", 2)
    before = set(os.listdir(scratch_root(spark)))
    records = spark_entry.queries()["prediction_records"](spark, FOLDER)
    left = set(os.listdir(scratch_root(spark))) - before
    assert [name.split("-")[0] for name in left] == ["predictions"] and records.count() > 0


def test_plans(spark):
    """What the plans must show: narrow scans, pruned ranks, and range filters in the scan."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    quota = plan(spark_entry.queries()["per_repo_quota"](spark, FOLDER))
    assert "WindowGroupLimit" in quota
    vocabulary = plan(spark_entry.queries()["vocabulary"](spark, FOLDER))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in vocabulary
    first = plan(spark_entry.queries()["first_n_rows"](spark, FOLDER))
    assert "PushedFilters: [Or(" in first and "Exchange" not in first
    pairs = plan(spark_entry.queries()["ngram_pair_counts"](spark, FOLDER))
    assert "partial_count" in pairs and pairs.count("ENSURE_REQUIREMENTS") == 1
