"""Where intermediate tables go.

A cluster names its shared folder in ``spark.checkpoint.dir``; a temporary folder is used only
for a local master that names none.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="corpusloom-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables made inside when it ends.

    For work that writes its result to a place of its own; a DataFrame that is returned unread still
    needs its tables.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for made in _scopes.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(made)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files behind; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to a parquet table in the shared folder and read it back.

    Cuts lineage like a reliable checkpoint, and unlike one keeps column pruning, pushed
    filters and size statistics for whatever reads it next. The shuffles behind it go at once.
    """
    path = scratch_path(df.sparkSession, "settled")
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
