"""The unquoted CSV dialect: comma, quote, backslash, CR and LF are escaped by a backslash, and
records end in CRLF.

Since CR and LF inside fields are escaped one by one, a bare CRLF only ever ends a record, so
files stay splittable by line. ``spark.read.csv`` honours its escape character inside quotes
only and cannot read this form. Quoted fields are read too, and files whose records end in LF, also beside others that end in CRLF;
these cannot be split and take one task per file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from corpusloom.scratch import settle
from corpusloom.sources.row_ids import with_file_ids

_RECORD_END = "\r\n"
_QUOTED = r'"(?:[^"\\]++|""|\\.)*+"'
_FIELD = rf"(?s),({_QUOTED}(?=,|\z)|[^,\\]*+(?:\\.[^,\\]*+)*+)"
# A record of a whole file: what is quoted or escaped may hold line ends.
_RECORD = rf'(?s)((?:{_QUOTED}|\\.|[^"\\\r\n]++|"|\r(?!\n))*+)(?:\r?\n|\z)'


def _fields(record: Column) -> Column:
    # The comma put in front makes every field, also an empty first one, start with a comma.
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_FIELD), F.lit(1))
    quoted = lambda f: F.regexp_replace(f.substr(F.lit(2), F.length(f) - 2), '""', '"')
    bare = lambda f: F.when(f.rlike(rf"(?s)\A{_QUOTED}\z"), quoted(f)).otherwise(f)
    return F.transform(raw, lambda f: F.regexp_replace(bare(f), r"(?s)\\(.)", "$1"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``value`` between CRLFs with ``file``, ``block`` (its offset) and ``at``, their order in it."""
    lines = spark.read.option("lineSep", _RECORD_END).text(path)
    return lines.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))


def _records(spark: SparkSession, path: str) -> DataFrame:
    """Records ``value`` of all files, each in its own form, with ``file``, ``block`` and ``at``.

    A file whose first line has a line feed that no backslash escapes and no quotes hold has records that end in LF. Those
    files are read whole; all others are split at CRLF.
    """
    first = _lines(spark, path).where("block = 0")
    heads = first.groupBy("file").agg(F.min_by("value", "at").alias("value"))
    by_feed = settle(heads.where(F.regexp_extract("value", _RECORD, 1) != F.col("value")).select("file"))
    if by_feed.isEmpty():
        return _lines(spark, path)
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    whole = files.join(by_feed, "file", "left_semi").select("file", F.posexplode(F.regexp_extract_all("value", F.lit(_RECORD), F.lit(1))).alias("at", "value"))
    split = _lines(spark, path).join(by_feed, "file", "left_anti")
    return split.unionByName(whole.select("value", "file", F.lit(0).cast("bigint").alias("block"), F.col("at").cast("bigint").alias("at")))


def read_escaped_csv(
    spark: SparkSession, path: str, required: Sequence[str] = (), columns: Sequence[str] | None = None,
    id_col: str | None = None,
) -> DataFrame:
    """All columns as strings. A missing path gives an empty DataFrame; a missing required column
    raises. ``columns`` names the columns of an empty result.

    The first record of a file is its header if it equals that of the first file read; a later record that looks like
    it is data. Lines without anything are no records. ``id_col`` adds a bigint that identifies a record by its
    file and place, ascending in file order.
    """
    try:
        first = spark.read.option("lineSep", _RECORD_END).text(path).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        first = None
    if first is None:
        names = list(columns or required)
        own = [StructField(id_col, LongType())] if id_col else []
        return spark.createDataFrame([], StructType([StructField(n, StringType()) for n in names] + own))
    probe = spark.createDataFrame([(first[0],)], "value string")
    splits = probe.select(F.regexp_extract("value", _RECORD, 1).alias("record")).first()[0]
    lines = _records(spark, path)
    if id_col:
        lines = with_file_ids(lines, "id", "file", "block", "at")
    kept = ["value", "id"] if id_col else ["value"]
    names = probe.select(_fields(F.lit(splits))).first()[0]
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError(f"{path} must contain the columns {missing}")
    is_header = (F.col("value") == F.lit(splits)) & (F.col("block") == 0)
    # Only records that equal the header are put in order, to find the one that begins each file.
    nth = F.row_number().over(Window.partitionBy("file").orderBy("at"))
    alike = lines.filter(is_header).withColumn("nth", nth).filter("nth > 1").select(*kept)
    records = lines.filter(~is_header & (F.col("value") != "")).select(*kept).unionByName(alike)
    fields = records.select(_fields(F.col("value")).alias("f"), *kept[1:])
    return fields.select(*[F.get("f", F.lit(i)).alias(n) for i, n in enumerate(names)], *[F.col(k).alias(id_col) for k in kept[1:]])


def _escape_name(name: str) -> str:
    return "".join("\\" + ch if ch in ',"\\\r\n' else ch for ch in name)


def _escaped(c: Column) -> Column:
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.regexp_replace(text, r'([,"\\\r\n])', r"\\$1")


def write_escaped_csv(df: DataFrame, path: str) -> None:
    """One header per file, as each task writes its own file; nothing is gathered for it.

    A record that is empty (one column, no text) is written as ``""``, the quoted form, so that it
    remains one. A table without rows is written as a header alone.
    """
    record = F.concat_ws(",", *[_escaped(F.col("`" + c.replace("`", "``") + "`")) for c in df.columns])
    record = F.when(record == "", '""').otherwise(record).alias("value")
    header = ",".join(_escape_name(c) for c in df.columns)
    first = "_first"
    # mapInPandas would cost a round trip through Python; numbering rows of a partition is enough.
    numbered = df.select(record, (F.monotonically_increasing_id() % F.lit(1 << 33) == 0).alias(first))
    with_header = F.when(F.col(first), F.concat(F.lit(header + _RECORD_END), "value")).otherwise(F.col("value"))
    numbered.select(with_header.alias("value")).write.option("lineSep", _RECORD_END).text(path)
    spark = df.sparkSession
    if spark.read.text(path).isEmpty():
        only = spark.createDataFrame([(header,)], "value string").coalesce(1)
        only.write.mode("append").option("lineSep", _RECORD_END).text(path)
