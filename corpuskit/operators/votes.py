"""Votes, group members, pivots and counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.operators import rows


def group_members(df: DataFrame, by: str, key: str) -> DataFrame:
    """Members of each group in key order, as rows (group, pos, member).

    One row per member keeps a hot group spread over many tasks, where an array per group would gather it in one.
    """
    return rows.index_by_key(df.select(by, key), key, [by], name="pos")


def group_sizes(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def size_histogram(df: DataFrame, values: Column) -> DataFrame:
    return df.groupBy(F.size(values).alias("size")).agg(F.count(F.lit(1)).alias("n"))


def votes(df: DataFrame, node: str, items: Column, name: str = "item") -> DataFrame:
    """How often each item was named for each node."""
    return df.select(node, F.explode(items).alias(name)).groupBy(node, name).agg(F.count(F.lit(1)).alias("votes"))


def ranked_votes(counted: DataFrame, catalogue: DataFrame, node: str, name: str) -> DataFrame:
    """Votes for catalogue items only, most votes first; equal votes go by name."""
    known = counted.join(catalogue.select(name).distinct(), name, "left_semi")
    return known.select(node, name, "votes").orderBy(node, F.desc("votes"), name)


def removed_votes(counted: DataFrame, catalogue: DataFrame, node: str, name: str) -> DataFrame:
    """How many items per node the catalogue does not hold."""
    unknown = counted.join(catalogue.select(name).distinct(), name, "left_anti")
    return unknown.groupBy(node).agg(F.count(F.lit(1)).alias("removed"))


def catalogue_coverage(df: DataFrame, by: Sequence[str], c: str, catalogue: Sequence[str]) -> DataFrame:
    inside = F.coalesce(F.col(c).isin(*catalogue), F.lit(False))
    return df.groupBy(*by).agg(F.count_if(inside).alias("in_count"), F.count_if(~inside).alias("out_count"))


def catalogue_misses(df: DataFrame, c: str, catalogue: Sequence[str]) -> DataFrame:
    """The texts outside the catalogue with their counts."""
    inside = F.coalesce(F.col(c).isin(*catalogue), F.lit(False))
    return df.where(~inside).groupBy(c).agg(F.count(F.lit(1)).alias("n"))


def largest_suffix(df: DataFrame, folder: Column, suffix: Column) -> DataFrame:
    """Largest numeric suffix per folder; names without a number are skipped, a folder without any gives null."""
    return df.groupBy(folder.alias("folder")).agg(F.max(suffix.try_cast("bigint")).alias("largest"))


def percent_pivot(df: DataFrame, row: str, column: str, columns: Mapping[int | str, str], value: Column) -> DataFrame:
    """One row per method and one column per setting, in percent with two digits."""
    cells = [F.round(F.avg(F.when(F.col(column) == v, value)) * 100, 2).alias(name) for v, name in columns.items()]
    return df.groupBy(row).agg(*cells)


def one_hot_pivot(df: DataFrame, key: str, label: str, labels: Sequence[str], prefix: str = "") -> DataFrame:
    """0/1 per label, merged over all rows of a key."""
    flags = [F.max((F.col(label) == v).cast("int")) for v in labels]
    named = [F.coalesce(f, F.lit(0)).alias(prefix + v) for f, v in zip(flags, labels, strict=True)]
    return df.groupBy(key).agg(*named)


def mean_vectors(df: DataFrame, by: str, vector: str, weight: Column | None = None) -> DataFrame:
    """Mean vector per group in long form (group, pos, x): sums per position are built before the shuffle."""
    w = F.lit(1.0) if weight is None else weight.cast("double")
    exploded = df.select(by, w.alias("__w"), F.posexplode(F.col(vector).cast("array<double>")).alias("pos", "__x"))
    total = F.sum(F.col("__w") * F.col("__x"))
    return exploded.groupBy(by, "pos").agg(F.try_divide(total, F.sum("__w")).alias("x"))


def as_vectors(long: DataFrame, by: str, value: str = "x", name: str = "vector") -> DataFrame:
    """Back from (group, pos, x) to one array; its length is the dimension."""
    entries = F.sort_array(F.collect_list(F.struct("pos", value)))
    return long.groupBy(by).agg(F.transform(entries, lambda e: e[value]).alias(name))
