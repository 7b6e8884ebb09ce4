"""Keyed tables: latest row per key, insert-if-absent, lookup and merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from corpuskit.session import cut_lineage


def _pick(df: DataFrame, keys: Sequence[str], row: Column) -> DataFrame:
    return df.groupBy(*keys).agg(row.alias("__row")).select(*keys, "__row.*")


def latest_per_key(df: DataFrame, keys: Sequence[str], recency: Column) -> DataFrame:
    """One row per key, the later one wins; reduced in part before the shuffle, so a hot key stays small."""
    return _pick(df, keys, F.max_by(F.struct(*[c for c in df.columns if c not in keys]), recency))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    return _pick(df, keys, F.min_by(F.struct(*[c for c in df.columns if c not in keys]), order))


def insert_outcomes(batch: DataFrame, store: DataFrame, key: str, order: str) -> DataFrame:
    """What a one-by-one insert would return: 1 inserted, 0 rejected because the key exists, -1 no key.

    Rows of a batch that share a key compete by `order` (null last), and exactly one is inserted: of equal orders the row with the
    smaller hash, of equal rows any one.
    """
    numbered = batch.withColumn("__row", F.monotonically_increasing_id()).withColumn("__hash", F.xxhash64(*batch.columns))
    ranked = cut_lineage(numbered, "batch")  # a row keeps its number on both sides of the join
    place = F.struct(F.col(order).isNull(), F.col(order), "__hash", "__row")
    winners = batch_keys(ranked, key).agg(F.min(place)["__row"].alias("__first"))
    free = winners.join(store.select(key), key, "left_anti")
    joined = ranked.join(free, key, "left")
    won = F.coalesce(F.col("__first") == F.col("__row"), F.lit(False))
    outcome = F.when(F.col(key).isNull(), -1).when(won, 1).otherwise(0)
    return joined.withColumn("outcome", outcome).drop("__first", "__row", "__hash")


def batch_keys(batch: DataFrame, key: str) -> GroupedData:
    return batch.where(F.col(key).isNotNull()).groupBy(key)


def new_rows(batch: DataFrame, store: DataFrame, key: str, order: str) -> DataFrame:
    """The rows to append: first per key, key not stored yet."""
    fresh = batch.where(F.col(key).isNotNull()).join(store.select(key), key, "left_anti")
    return first_per_key(fresh, [key], F.col(order)).select(*batch.columns)


def find(store: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Stored row for every wanted key, null where there is none."""
    return wanted.select(key).distinct().join(store, key, "left")


def existing(wanted: DataFrame, store: DataFrame, key: str) -> DataFrame:
    return wanted.join(store.select(key), key, "left_semi")
