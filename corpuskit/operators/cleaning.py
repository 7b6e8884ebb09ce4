"""Sentence tables and filters over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.functions import text as tx


def sentence_rows(df: DataFrame, keys: Sequence[str], c: str, extra_marks: str = ";；", mark: str = "。") -> DataFrame:
    """One row per piece of text, with its place in the document."""
    pieces = tx.sentences(F.col(c), extra_marks, mark)
    return df.select(*keys, F.posexplode(pieces).alias("pos", "sentence"))


def keep_all(df: DataFrame, filters: Mapping[str, Column]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, filters.values()))


def filter_report(df: DataFrame, by: Sequence[str], filters: Mapping[str, Column]) -> DataFrame:
    """Rows kept and rows dropped per filter, each drop booked on the first filter that fails. One pass."""
    names = list(filters)
    first_failed = reduce(
        lambda rest, name: F.when(~filters[name], F.lit(name)).otherwise(rest), reversed(names), F.lit("kept")
    )
    counts = [
        F.count_if(F.col("__outcome") == name).alias(name if name == "kept" else f"dropped_{name}")
        for name in ["kept", *names]
    ]
    return df.withColumn("__outcome", first_failed).groupBy(*by).agg(*counts)


def with_known_parties(
    df: DataFrame, key: str, c: str, targets: DataFrame, name: str, separator: str = "; ", min_length: int = 4
) -> DataFrame:
    """Rows whose party list has two long enough names or more, one of them at least in the target table."""
    long_names = F.filter(F.split(F.col(c), rf"\Q{separator}\E", -1), lambda p: F.length(p) >= min_length)
    several = df.where(F.contains(F.col(c), F.lit(separator)) & (F.size(long_names) >= 2))
    parties = several.select(key, F.explode(F.array_distinct(long_names)).alias(name))
    hits = parties.join(targets.select(name).distinct(), name, "left_semi").select(key).distinct()
    return several.join(hits, key, "left_semi")


def profile(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Row count, column count, rows with all required columns, and non-null cells per column; one pass."""
    valid = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.count_if(valid).alias("valid_rows"),
        *[F.count(c).alias(f"filled_{c}") for c in df.columns],
    )
