import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.functions.binding import bind

STRINGS = [
    "", " ", "a", " a b ", "\x1c\x85 a\xa0b 　", "a\n", "a\nb", "a\r\nb\r\n", "\n\n", "a\x0bb\x0cc\x1dd\x85e f",
    "a \t b", "\r", "x" + " " * 50 + "y", "tail\n\n", "﻿a",
]


@pytest.fixture(scope="module")
def strings(spark):
    return spark.createDataFrame(list(enumerate(STRINGS)), "i int, s string")


def column(df, c):
    return [r[0] for r in df.orderBy("i").select(c).collect()]


def test_like_python(strings):
    s = F.col("s")
    assert column(strings, text.strip(s)) == [x.strip() for x in STRINGS]
    assert column(strings, text.line_count(s)) == [len(x.splitlines()) for x in STRINGS]
    assert column(strings, text.split_whitespace(s)) == [x.split() for x in STRINGS]
    assert column(strings, text.is_blank(s)) == [not x.strip() for x in STRINGS]
    assert column(strings, text.newline_count(s)) == [x.count("\n") + 1 for x in STRINGS]


def test_whitespace_class(spark):
    codes = spark.range(1, 0x3100).selectExpr("cast(id AS int) AS i").withColumn(
        "s", F.decode(F.unhex(F.format_string("%08X", "i")), "UTF-32")
    )
    ours = {r.i for r in codes.filter(text.is_blank(F.col("s"))).collect()}
    assert ours == {i for i in range(1, 0x3100) if chr(i).isspace()}


def test_replace_first(spark):
    rows = [("if (a.*b): a.*b", "a.*b"), ("none", "x"), ("$1 \\ $1", "$1"), ("aaa", "aa")]
    df = spark.createDataFrame(rows, "s string, old string")
    got = [r[0] for r in df.select(text.replace_first(F.col("s"), F.col("old"), "<mask>")).collect()]
    assert got == [s.replace(o, "<mask>", 1) for s, o in rows]


def test_repo_names(spark):
    df = spark.createDataFrame([("git@host.com:own/na.me.git",), ("https://host.com/own/na.me",)], "u string")
    assert [tuple(r) for r in df.select(text.repo_short_name(F.col("u")), text.repo_full_name(F.col("u"))).collect()] == [
        ("na.me", "own/na.me")
    ] * 2


def test_first_non_empty(spark):
    df = spark.createDataFrame([(None, "b"), ("", "b"), ("a", "b"), (None, "")], "a string, b string")
    assert [r[0] for r in df.select(text.first_non_empty(F.col("a"), F.col("b"))).collect()] == ["b", "b", "a", None]


def test_bind_computes_once(spark):
    df = bind(spark.range(3), "x", F.upper(F.concat(F.lit("a"), "id")), lambda v: v != "A1").filter("x <> 'A2'")
    assert [r.x for r in df.collect()] == ["A0"]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("upper(") == 1
