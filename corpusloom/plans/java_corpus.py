"""From the files of commits to rows of Java methods."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.binding import bind
from corpusloom.functions.text import is_blank, line_count
from corpusloom.operators.java_code import (
    MAX_FILE_LINES, MIN_FILE_LINES, clean_comments, find_java_methods, has_position, java_file_filter,
    lexable, license_filter, line_count_in_range, method_signature, provenance, strip_imports, tokenize_java,
)
from corpusloom.operators.selection import global_cap, per_repo_quota
from corpusloom.scratch import settle
from corpusloom.sources.trees import commit_files

# The columns of method rows.
METHOD_COLUMNS = (
    "dataset_split", "repo_name", "repo_url", "commit_sha", "file_path", "method_name", "start_line",
    "end_line", "signature", "original_code", "code_tokens",
)


def clean_files(files: DataFrame) -> DataFrame:
    """Usable files with the column ``code``, cleaned. Cheap tests come first."""
    code = clean_comments(strip_imports(F.col("source_code")))
    usable = lambda c: ~is_blank(c) & line_count_in_range(c, MIN_FILE_LINES, MAX_FILE_LINES) & lexable(c)
    return bind(java_file_filter(files), "code", code, usable)


def method_rows(files: DataFrame, split: str) -> DataFrame:
    """One row per method with its file's whole cleaned code, and the order columns."""
    methods = has_position(find_java_methods(clean_files(files)))
    rows = methods.withColumns({
        "end_line": F.col("start_line") + line_count(F.col("code")) - 1,
        "signature": method_signature(F.col("return_type"), F.col("method_name"), F.col("params")),
        "original_code": F.col("code"),
    })
    return provenance(rows, split)


def mine_java_methods(
    files: DataFrame, limit: int, split: str, licenses: DataFrame | None = None
) -> DataFrame:
    """At most ``limit // 4`` methods per repository and ``limit`` in all, in commit order.

    ``files`` also has ``repo_seq``, the rank of its repository. Quotas are settled on the narrow
    order keys; only files with a method that stays, at most ``limit``, are then gone through again.
    """
    files = commit_files(files)
    if "repo_seq" not in files.columns:
        raise ValueError("files need repo_seq, the order of the repositories")
    if licenses is not None:
        files = license_filter(files, licenses)
    order = ["repo_seq", "commit_seq", "file_seq", "method_seq"]
    rows = method_rows(files, split)
    within_quota = settle(per_repo_quota(rows.select("repo_name", *order), limit // 4))
    kept = global_cap(within_quota, limit, order)
    keys = settle(kept.select(*order))  # written, so Spark knows whether it is small enough to broadcast
    chosen = method_rows(files.join(keys, order[:-1], "left_semi"), split).join(keys, order, "left_semi")
    return chosen.withColumn("code_tokens", F.array_join(tokenize_java(F.col("code")), ", ")).select(*METHOD_COLUMNS)
