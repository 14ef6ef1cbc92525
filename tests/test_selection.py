import math
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import selection
from corpusloom.operators.skew import keep_members, lookup, lookup_requested


@pytest.fixture(scope="module")
def keyed(spark):
    rng = random.Random(1)
    rows = list({(rng.randrange(6), rng.randrange(-50, 10**9), rng.randrange(3)) for _ in range(3000)})
    return rows, spark.createDataFrame(rows, "a int, b bigint, c int").repartition(7)


@pytest.mark.parametrize("n", [0, 1, 17, 1500, 10_000])
def test_first_n_rows(keyed, n, monkeypatch):
    monkeypatch.setattr(selection, "_HISTOGRAM", 16)
    rows, df = keyed
    got = selection.first_n_rows(df, ["a", "b", "c"], n).collect()
    assert sorted(tuple(r) for r in got) == sorted(rows)[:n]


def test_ties(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (1, "z"), (0, "w"), (2, "v")], "a int, b string")
    got = sorted(r.b for r in selection.first_n_rows(df, ["a"], 3).collect())
    assert len(got) == 3 and got[0] == "w" and set(got[1:]) < {"x", "y", "z"}
    with pytest.raises(ValueError):
        selection.prefix_predicate(df, ["a"], 3)


def test_quota_above_the_prune_limit(spark, monkeypatch):
    monkeypatch.setattr(selection, "_GROUP_LIMIT", 3)
    df = spark.range(200).select((F.col("id") % 3 * F.col("id") % 2).alias("repo_name"), F.col("id").alias("k"))
    got = selection.per_repo_quota(df, 20, order=["k"]).collect()
    groups = {}
    for r in df.orderBy("k").collect():
        groups.setdefault(r.repo_name, []).append(r.k)
    want = {(g, k) for g, ks in groups.items() for k in ks[:20]}
    assert {(r.repo_name, r.k) for r in got} == want


def test_splits_do_not_depend_on_partitioning(spark):
    df = spark.range(2000)
    one = selection.split_column(df.repartition(3), "id", 0.1)
    two = selection.split_column(df.repartition(11), "id", 0.1)
    assert sorted(one.collect()) == sorted(two.collect())
    sizes = {r.split: r.n_rows for r in selection.split_sizes(one).collect()}
    assert sum(sizes.values()) == 2000 and 130 < sizes["validation"] < 270


@pytest.mark.parametrize("n", [1, 10, 999])
def test_exact_split(spark, n):
    split = selection.split_column(spark.range(n), "id", 0.1, exact=True)
    assert split.filter("split = 'validation'").count() == math.ceil(0.1 * n)


def test_three_way(spark):
    sizes = {r.split: r.n_rows for r in selection.split_sizes(selection.three_way_split(spark.range(5000), "id")).collect()}
    assert sum(sizes.values()) == 5000
    assert abs(sizes["train"] - 4000) < 150 and abs(sizes["test"] - 500) < 100


@pytest.mark.parametrize("hot", [2, 1000])
def test_lookup_with_hot_keys(spark, monkeypatch, hot):
    from corpusloom.operators import skew

    monkeypatch.setattr(skew, "_MAX_HOT", hot)
    rows = spark.range(300).select("id", F.when(F.col("id") < 200, 0).otherwise(F.col("id") % 40).alias("k"))
    values = spark.range(1, 30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    values = values.unionByName(spark.createDataFrame([(0, 7)], "k bigint, v bigint"))
    want = {r.id: (7 if r.k == 0 else r.k * 10 if r.k < 30 else None) for r in rows.collect()}
    used = values.join(rows.groupBy("k").count(), "k").withColumnRenamed("count", "uses")
    assert {r.id: r.v for r in lookup(rows, used, ["k"], ["v"], "uses", 300, F.col("id")).collect()} == want
    got = lookup_requested(rows, values, ["k"], ["v"], 300, F.col("id")).collect()
    assert {r.id: r.v for r in got} == want and len(got) == 300
    kept = keep_members(rows, values.select("k"), "k").collect()
    assert {r.id for r in kept} == {i for i, v in want.items() if v is not None}


@pytest.mark.parametrize("n_wanted", [1, 500, 10**12])
def test_probable_keys_hold_all_wanted(spark, n_wanted):
    from corpusloom.operators.skew import keep_probable

    rows = spark.range(20_000).selectExpr("id % 2000 as a", "id % 7 as b", "id as v")
    wanted = spark.range(300).selectExpr("id * 3 as a", "id % 7 as b")
    got = keep_probable(rows, wanted, ["a", "b"], n_wanted)
    exact = rows.join(wanted, ["a", "b"], "left_semi")
    assert got.columns == rows.columns and exact.exceptAll(got).count() == 0 and got.exceptAll(rows).count() == 0
    if n_wanted > 1:
        assert got.count() < exact.count() + 2_000
    assert keep_probable(rows, wanted.limit(0), ["a", "b"], 0).count() == 0
