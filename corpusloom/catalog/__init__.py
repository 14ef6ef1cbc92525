"""Every operator as a query over the test tables, most with equivalent DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = ("ngrams", "predictions", "selections", "texts", "codes", "encodings", "files")


def all_queries() -> dict[str, Query]:
    return {name: q for m in _MODULES for name, q in import_module(f"{__name__}.{m}").QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in import_module(f"{__name__}.{m}").ORACLES.items()}
