"""Source trees, repository lists and commit tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.functions.text import repo_full_name, repo_short_name, strip
from corpusloom.operators.python_code import decode_utf8_ignore

COMMIT_FILE_COLUMNS = (
    "repo_name", "repo_url", "commit_seq", "commit_sha", "file_seq", "file_path", "source_code"
)


def scan_source_tree(spark: SparkSession, root: str, pattern: str = "*.py") -> DataFrame:
    """``(repo, file, content)`` of all matching files below the folders in ``root``.

    The repository is the first folder below ``root``; files directly in it belong to none.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    )
    # As the file system itself spells the root, so that it is compared as a prefix and nothing else.
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    base = system.makeQualified(folder).toString().rstrip("/") + "/"
    path = F.regexp_replace("path", "^file:/+", "file:/")
    base = F.lit(re.sub("^file:/+", "file:/", base))
    below = F.substring(path, F.length(base) + 1, F.length(path))
    return (
        files.select(below.alias("file"), "content", path.startswith(base).alias("_below"))
        .filter(F.col("_below") & F.col("file").contains("/"))
        .select(F.substring_index("file", "/", 1).alias("repo"), "file", "content")
    )


def source_texts(files: DataFrame) -> DataFrame:
    """``content`` decoded to ``text``; bytes that are no UTF-8 are dropped."""
    return files.select(
        *[c for c in files.columns if c != "content"], decode_utf8_ignore(F.col("content")).alias("text")
    )


def read_repo_list(spark: SparkSession, path: str) -> DataFrame:
    """``(repo_url, repo, full_name)`` of a file with one address per line."""
    lines = spark.read.text(path).select(strip(F.col("value")).alias("repo_url")).filter("repo_url <> ''")
    return lines.select(
        "repo_url", repo_short_name(F.col("repo_url")).alias("repo"), repo_full_name(F.col("repo_url")).alias("full_name")
    )


def commit_files(table: DataFrame) -> DataFrame:
    """A table of the files modified by each commit, its columns checked; ``repo_name`` comes from the
    address where the table has none."""
    if "repo_name" not in table.columns:
        table = table.withColumn("repo_name", repo_short_name(F.col("repo_url")))
    missing = [c for c in COMMIT_FILE_COLUMNS if c not in table.columns]
    if missing:
        raise ValueError(f"commit files need the columns {missing}")
    return table
