"""Naming an intermediate value inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, however often the body uses it.

    Catalyst merges adjacent projections and copies an expression into each of its uses; a lambda variable is not copied.
    """
    return F.transform(F.array(value), body)[0]
