"""Reproducible randomness: every draw is a hash of a seed and the row's own key.

The same rows get the same draws whatever the partitioning, number of executors, retries or
lost tasks, which neither ``rand()`` nor ``randomSplit`` promises.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

KEY_SPAN = 1 << 32


def draw32(seed: int | str, *key: Column) -> Column:
    """Uniform integer in [0, 2**32)."""
    text = F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def unit_draw(seed: int | str, *key: Column) -> Column:
    """Uniform double strictly inside (0, 1)."""
    return (draw32(seed, *key) + F.lit(0.5)) / F.lit(float(KEY_SPAN))


def wide_draw(seed: int | str, *key: Column) -> Column:
    """Uniform integer in [0, 2**60), for an index into very large sets."""
    text = F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def below_ratio(draw: Column, ratio: float) -> Column:
    return draw < F.lit(ratio * KEY_SPAN)
