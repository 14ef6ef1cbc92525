"""Computing a costly column once.

Catalyst pushes filters below projections by copying the projected expression into them, and adds
null and size checks of its own; a text that is cleaned or split would be cleaned or split several
times per row. A generator over a one-element array is a boundary that no filter crosses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def bind(df: DataFrame, name: str, value: Column, keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """Add ``value`` as column ``name``; with ``keep``, only rows whose value passes it."""
    values = F.array(value)
    return df.select("*", F.explode(F.filter(values, keep) if keep else values).alias(name))
