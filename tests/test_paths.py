"""Row ids of files, and the workflows from path to path."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.bpe import EXTRA_IDS
from corpusloom.plans.from_files import examples_from_csv, experiment_from_csv, functions_from_csv, functions_to_csv, sequences_from_csv
from corpusloom.plans.java_corpus import METHOD_COLUMNS
from corpusloom.sources.escaped_csv import read_escaped_csv, write_escaped_csv
from corpusloom.sources.results import read_tokenizer_tables


def method_csv(spark, path, tokens, parts=1):
    rows = spark.createDataFrame([(f"{i:05}", t) for i, t in enumerate(tokens)], "file_path string, code_tokens string")
    rows = rows.withColumns({c: F.lit("") for c in METHOD_COLUMNS if c not in ("file_path", "code_tokens")})
    write_escaped_csv(rows.select(*METHOD_COLUMNS).coalesce(parts) if parts == 1 else rows.select(*METHOD_COLUMNS).repartitionByRange(parts, "file_path"), path)


@pytest.mark.parametrize("block", ["128m", "700"])
def test_ids_follow_the_file(spark, tmp_path, block):
    path = str(tmp_path / "csv")
    method_csv(spark, path, [f"a{i}, b" for i in range(300)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        rows = read_escaped_csv(spark, path, id_col="id")
        got = {r.id: r.file_path for r in rows.collect()}
        assert len(got) == 300 and [got[i] for i in sorted(got)] == [f"{i:05}" for i in range(300)]
        again = {r.id: r.file_path for r in rows.repartition(7).collect()}
        assert again == got
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_ids_of_several_and_of_unsplit_files(spark, tmp_path):
    path = str(tmp_path / "csv")
    method_csv(spark, path, [f"t{i}" for i in range(50)], parts=4)
    ids = [r.id for r in read_escaped_csv(spark, path, id_col="id").collect()]
    assert len(set(ids)) == 50
    (tmp_path / "lf.csv").write_text('a\n"x\ny"\nz\n')
    assert [(r.a, r.id) for r in read_escaped_csv(spark, str(tmp_path / "lf.csv"), id_col="id").orderBy("id").collect()] == [("x\ny", 1), ("z", 2)]
    assert read_escaped_csv(spark, str(tmp_path / "none"), required=["a"], id_col="id").columns == ["a", "id"]


def test_experiment_from_paths(spark, tmp_path):
    train, test, out = (str(tmp_path / n) for n in ("train", "test", "out"))
    method_csv(spark, train, ["a, b, c, d", "a, b, c", "b, c, d", ", ,"] * 10, parts=3)
    method_csv(spark, test, ["a, b, d", "c, d"])
    assert sequences_from_csv(spark, train).count() == 30
    done = experiment_from_csv(spark, train, test, out, [2, 3], topk=2)
    assert done.best.count() == 1 and spark.read.text(f"{out}/predictions").count() == 3


def test_examples_from_paths(spark, tmp_path):
    root = tmp_path / "trees" / "proj"
    root.mkdir(parents=True)
    body = "".join(f"def f{i}(x):\n    # <extra_id_{i}> note, \"quoted\"\n    if x > {i}:\n        return x\n    return {i}\n\n" for i in range(12))
    (root / "m.py").write_text(body)
    csv, out = str(tmp_path / "functions"), str(tmp_path / "out")
    functions_to_csv(spark, str(tmp_path / "trees"), csv)
    rows = functions_from_csv(spark, csv)
    assert rows.count() == 12 and rows.select("id").distinct().count() == 12
    examples_from_csv(spark, csv, out, vocab_size=120)
    size = read_tokenizer_tables(spark, f"{out}/tokenizer").vocab.count()
    tuned = spark.read.parquet(f"{out}/finetuning").collect()
    assert len(tuned) == 12 and all(len(r.input_ids) == 256 and len(r.labels) == 64 for r in tuned)
    # Each function holds one sentinel; it stays one id, behind the vocabulary.
    assert sorted(i for r in tuned for i in r.input_ids if i >= size) == [size + i for i in range(12)]
    assert len(EXTRA_IDS) == 100
    assert spark.read.parquet(f"{out}/pretraining").count() == 12


def test_scope_removes_its_tables_only(spark):
    from pathlib import Path

    from corpusloom.scratch import scratch_scope, settle

    outer = settle(spark.range(3))
    with scratch_scope(spark):
        inner = settle(spark.range(4))
        files = [Path(f.removeprefix("file://")) for f in inner.inputFiles()]
        assert inner.count() == 4 and all(f.exists() for f in files)
    assert not any(f.exists() for f in files) and outer.count() == 3
