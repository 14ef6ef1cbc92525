import csv
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.ngram_counts import pair_counts
from corpusloom.operators.sequences import load_sequences, token_list
from corpusloom.plans.training_examples import function_corpus
from corpusloom.scratch import scratch_path, scratch_root
from corpusloom.sources.escaped_csv import read_escaped_csv, write_escaped_csv
from corpusloom.sources.quoted_csv import read_quoted_csv, write_quoted_csv
from corpusloom.sources.quoted_records import ends_inside, quoted_records
from corpusloom.sources.tables import spread_small
from corpusloom.sources.trees import commit_files, read_repo_list, scan_source_tree, source_texts
from corpusloom.streaming.counts import read_streamed_counts, stream_pair_counts

ROWS = [
    ("a,b", 'q"q', "back\\slash"), ("", "x", "y"), ("line\nfeed", "crlf\r\nhere", "\\"), ("", "", ""), ("end,", ",", "\r"),
    ("long " * 30_000, "é日", "\\,"),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "a string, b string, code_tokens string")


def test_escaped_round_trip(spark, rows, tmp_path):
    path = str(tmp_path / "out")
    write_escaped_csv(rows.repartition(3), path)
    assert sorted(map(tuple, read_escaped_csv(spark, path).collect())) == sorted(ROWS)


def test_escaped_like_python(spark, rows, tmp_path):
    """What the csv module writes we read, and what we write it reads."""
    ours, theirs = str(tmp_path / "ours"), tmp_path / "theirs.csv"
    with theirs.open("w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, quoting=csv.QUOTE_NONE, escapechar="\\")
        w.writerow(rows.columns)
        w.writerows(ROWS)
    assert sorted(map(tuple, read_escaped_csv(spark, str(theirs)).collect())) == sorted(ROWS)
    write_escaped_csv(rows.coalesce(1), ours)
    part = next((tmp_path / "ours").glob("part-*"))
    assert sorted(part.read_bytes().split(b"\r\n")) == sorted(theirs.read_bytes().split(b"\r\n"))


def test_missing_inputs(spark, rows, tmp_path):
    empty = read_escaped_csv(spark, str(tmp_path / "nowhere"), required=["code_tokens"])
    assert empty.columns == ["code_tokens"] and empty.count() == 0
    write_escaped_csv(rows.select("a"), str(tmp_path / "a"))
    with pytest.raises(ValueError):
        read_escaped_csv(spark, str(tmp_path / "a"), required=["code_tokens"])
    with pytest.raises(ValueError):
        load_sequences(rows.select("a"), "a")


def test_token_lists(spark):
    df = spark.createDataFrame([(1, 'f, (, a, ,, b, ), "p, q"'), (2, " ,, "), (3, None), (4, "")], "id int, code_tokens string")
    assert [(r.seq_id, r.tokens) for r in load_sequences(df, "id").collect()] == [(1, ["f", "(", "a", "b", ")", '"p', 'q"'])]


def test_quoted_round_trip(spark, tmp_path):
    rows = [("a,b", 'q"q', 1), ("", "two\nlines", 2), (" spaced ", "\\", 3)]
    df = spark.createDataFrame(rows, "a string, b string, n int")
    write_quoted_csv(df.repartition(2), str(tmp_path / "q"))
    assert sorted(map(tuple, read_quoted_csv(spark, str(tmp_path / "q"), df.schema).collect())) == sorted(rows)
    with (tmp_path / "p.csv").open("w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(["a", "b", "n"])
        w.writerows(rows)
    assert sorted(map(tuple, read_quoted_csv(spark, str(tmp_path / "p.csv"), df.schema).collect())) == sorted(rows)


def test_source_tree(spark, tmp_path):
    for name, content in {
        "r1/a.py": b"def f(x):\n  if x:\n    return \xff1\n", "r1/deep/b.py": b"x = 1\n", "r2/c.py": b"def g(:", "r2/d.txt": b"no",
        "top.py": b"def no(): pass",
    }.items():
        file = tmp_path / "tree" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(content)
    files = scan_source_tree(spark, str(tmp_path / "tree"))
    assert {(r.repo, r.file) for r in files.collect()} == {("r1", "r1/a.py"), ("r1", "r1/deep/b.py"), ("r2", "r2/c.py")}
    assert "return 1" in source_texts(files).filter("file = 'r1/a.py'").first().text
    assert [(r.repo, r.function_name, r.num_if) for r in function_corpus(files, "finetune").collect()] == [("r1", "f", 1)]


def test_repo_list(spark, tmp_path):
    (tmp_path / "list.txt").write_text("git@h.com:o/one.git\n\nhttps://h.com/o/two\n")
    got = {(r.repo, r.full_name) for r in read_repo_list(spark, str(tmp_path / "list.txt")).collect()}
    assert got == {("one", "o/one"), ("two", "o/two")}
    with pytest.raises(ValueError):
        commit_files(spark.range(1).withColumn("repo_url", F.lit("https://h/o/n")))


def test_scratch_uses_the_session_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_spread_leaves_large_inputs_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread_small(spark.range(10, numPartitions=1), "id").rdd.getNumPartitions() == cores
    many = spark.range(10, numPartitions=cores + 3)
    assert spread_small(many, "id") is many


def test_stream(spark, tmp_path):
    seqs = spark.createDataFrame([(i, ["a", "b"] * (i % 3)) for i in range(9)], "seq_id bigint, tokens array<string>")
    seqs.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(seqs.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for _ in range(2):  # the second run finds nothing new
        stream_pair_counts(stream, 2, out, checkpoint).awaitTermination()
    batch = pair_counts(seqs, 2)
    assert sorted(read_streamed_counts(spark, out).select(*batch.columns).collect()) == sorted(batch.collect())


AWKWARD = ["", "plain", 'say "hi"', '"', '""', "a,b", "line\nbreak", "\n", "\n\n\n", 'x\n"\n,"\n', "cr\rin", "crlf\r\nin", ",", " lead", "trail ", "é日\U0001f600", '"\n' * 40,
           "a" * 300, "\n".join(str(i) for i in range(60)), "q" + '""' * 50]


@pytest.mark.parametrize("size, end", [(64, "\n"), (256, "\r\n"), (1 << 20, "\n"), (1000, "")])
def test_one_quoted_file_by_many_tasks(spark, tmp_path, size, end):
    """Against Python's reader, at every kind of place where a block may end."""
    draw = random.Random(size)
    rows = [(i, draw.choice(AWKWARD), draw.choice(AWKWARD)) for i in range(400)]
    for name in ("one", "two"):
        (tmp_path / "in").mkdir(exist_ok=True)
        with open(tmp_path / "in" / f"{name}.csv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, lineterminator=end or "\n")
            out.writerows([("id", "te,xt", "more")] + (rows if name == "one" else rows[:7]))
            f.write("\n\r\n" if end else '9,"open\nto the end')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        read = read_quoted_csv(spark, str(tmp_path / "in"), id_col="row")
        assert read.columns == ["id", "te,xt", "more", "row"]
        got = sorted(read.collect(), key=lambda r: r.row)
        blocks = quoted_records(spark, str(tmp_path / "in")).select("file", "block").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = [(str(i), t, m) for i, t, m in rows + rows[:7]]
    if not end:
        expected.insert(400, ("9", "open\nto the end", ""))
        expected.append(("9", "open\nto the end", ""))
    assert [tuple(r)[:3] for r in got] == expected
    assert [r.row for r in got] == list(range(len(got)))
    assert blocks > 20 or size > 1000


def test_stray_quotes_and_many_commas():
    assert not ends_inside('a"b,c', False) and not ends_inside('x,5" pipe', False)
    assert ends_inside('a,"b', False) and not ends_inside('b",c', True) and ends_inside('b"",c', True)
    assert not ends_inside("," * 200_000 + '""', False) and ends_inside('"' + '""' * 200_000, False)


def test_quoted_schema_and_header_only(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,"x"\nnone,\n3\n', encoding="utf-8")
    assert [tuple(r) for r in read_quoted_csv(spark, str(tmp_path / "t.csv"), "n int, t string").collect()] == [(1, "x"), (None, ""), (3, "")]
    (tmp_path / "e.csv").write_text('"a","b"\n', encoding="utf-8")
    empty = read_quoted_csv(spark, str(tmp_path / "e.csv"))
    assert empty.columns == ["a", "b"] and empty.collect() == []


@pytest.mark.parametrize("first", ["\r\n", "\n"])
def test_escaped_folder_of_both_record_ends(spark, tmp_path, first):
    """Every file is read in its own form, whichever comes first."""
    other = "\n" if first == "\r\n" else "\r\n"
    body = lambda end, at: end.join(["id,text"] + [f"{at + i},a\\\n{i}\\,b" for i in range(30)] + [f'{at + 30},"q, ""x"""']) + end
    for name, end, at in (("a", first, 0), ("b", other, 100), ("c", first, 200), ("d", other, 300)):
        (tmp_path / f"{name}.csv").write_bytes(body(end, at).encode())
    (tmp_path / "e.csv").write_bytes(b"id,text")
    rows = read_escaped_csv(spark, str(tmp_path), ["text"], id_col="row").collect()
    expected = {(str(at + i), f"a\n{i},b") for at in (0, 100, 200, 300) for i in range(30)} | {(str(at + 30), 'q, "x"') for at in (0, 100, 200, 300)}
    assert {(r.id, r.text) for r in rows} == expected and len(rows) == len(expected)
    assert [r.id for r in sorted(rows, key=lambda r: r.row)] == [str(at + i) for at in (0, 100, 200, 300) for i in range(31)]
