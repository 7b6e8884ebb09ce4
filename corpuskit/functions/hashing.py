"""Seeded hashes of a row key: the repeatable stand-in for a random draw.

The value depends on the key alone, so a retried task or another partitioning gives the same draw.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw_hex(seed: str, *keys: str | Column) -> Column:
    """32 hex digits; sorting by them is a shuffle of the rows."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws(":", F.lit(seed), *[c.cast("string") for c in cols]))


def draw_int(seed: str, *keys: str | Column) -> Column:
    """The first 32 bits of the draw as a non-negative bigint."""
    return F.conv(F.substring(draw_hex(seed, *keys), 1, 8), 16, 10).cast("bigint")


def draw_unit(seed: str, *keys: str | Column) -> Column:
    """The draw as a number in [0, 1)."""
    return draw_int(seed, *keys) / F.lit(float(2**32))
