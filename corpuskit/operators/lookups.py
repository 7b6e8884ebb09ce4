"""Lookups, catalogues and key-based alignment of tables.

No join here carries a broadcast hint: Catalyst and AQE broadcast a side only below the configured size, and split
skewed partitions of a sort-merge join otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.functions.permute import permuted, round_keys
from corpuskit.operators import rows
from corpuskit.session import cut_lineage

KEYS_PER_TASK = 32  # join keys per task when each entry of a catalogue goes to each row: enough for even tasks


def strict_lookup(df: DataFrame, dim: DataFrame, key: str, value: str) -> DataFrame:
    """Every row must find its key, and the key must be there once; the query fails with the key otherwise."""
    found = df.join(unique_by(dim.select(key, value, F.lit(True).alias("__found")), key), key, "left")
    missing = F.raise_error(F.concat(F.lit(f"no {value} for {key} "), F.col(key).cast("string")))
    return found.withColumn(value, F.when(F.col("__found").isNull(), missing).otherwise(F.col(value))).drop("__found")


def left_lookup(df: DataFrame, dim: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Values of a dimension, null where the key is absent. Fails if a key occurs twice, so rows never multiply."""
    return df.join(unique_by(dim.select(key, *values), key), key, "left")


def not_cached(df: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    return df.join(cache.select(key), key, "left_anti")


def unique_by(df: DataFrame, key: str) -> DataFrame:
    """The same rows; the query fails when a key occurs twice."""
    others = [c for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in others])
    twice = F.raise_error(F.concat(F.lit(f"{key} occurs twice: "), F.col(key).cast("string")))
    # A null key matches nothing in a lookup, however often it occurs.
    checked = F.when((F.col("__n") > 1) & F.col(key).isNotNull(), twice.cast(df.schema[key].dataType)).otherwise(F.col(key))
    return grouped.select(checked.alias(key), *others)


def side_by_side(df: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    """Add columns of another table by key, keeping exactly the rows of the first."""
    return df.join(unique_by(extra, key), key, "left")


def with_label_id(df: DataFrame, catalogue: DataFrame, label: str, name: str = "label_id", unknown: int = -1) -> DataFrame:
    """`catalogue` has the columns (label, id)."""
    ids = catalogue.select(F.col("label").alias(label), F.col("id").alias(name))
    return df.join(ids, label, "left").withColumn(name, F.coalesce(name, F.lit(unknown)))


def known_only(df: DataFrame, catalogue: DataFrame, label: str, name: str = "label_id") -> DataFrame:
    return with_label_id(df, catalogue, label, name).where(F.col(name) != -1)


def catalogue_frame(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """A fixed list of class names as a table (label, id)."""
    pairs = [(label, i) for i, label in enumerate(labels)]
    return df.sparkSession.createDataFrame(pairs, "label string, id int")


def numbered_catalogue(catalogue: DataFrame, column: str) -> tuple[DataFrame, int]:
    """The distinct entries with their places (__number) in sorted order, a null first, and how many there are."""
    named = catalogue.select(column).distinct()
    numbered = cut_lineage(rows.index_by_key(named, column, name="__number"), "catalogue")
    return numbered, numbered.count()


def _entries(asked: DataFrame, key: Column, catalogue: DataFrame, n: int) -> DataFrame:
    """Give each row the catalogue entry of its __number.

    A number is asked for by every row, so copies of the catalogue share the rows out: about `KEYS_PER_TASK` join keys per task,
    however few entries there are.
    """
    copies = -(-KEYS_PER_TASK * rows.slice_count(asked) // max(1, n))
    dealt = catalogue.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return asked.withColumn("__copy", F.pmod(F.xxhash64(key), F.lit(copies)).cast("int")).join(dealt, ["__number", "__copy"]).drop("__copy")


def each_with(df: DataFrame, catalogue: DataFrame, column: str) -> DataFrame:
    """Every row with every catalogue entry, by a join on the entry's number."""
    numbered, n = numbered_catalogue(catalogue, column)
    places = F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")) if n else F.expr("cast(array() as array<bigint>)")
    asked = df.withColumn("__number", F.explode(places))
    return _entries(asked, F.struct(*df.columns), numbered, n).select(*df.columns, column)


def catalogue_blocks(df: DataFrame, catalogue: DataFrame, column: str, key: str, size: int, seed: str) -> DataFrame:
    """Cut the catalogue, shuffled anew for each row, into blocks of `size`; the last block may be short. `key` tells rows apart.

    Which entry stands at a place of a row's shuffle is computed (`functions.permute`), so that no row's catalogue is sorted; only
    the entries of one block come together.
    """
    numbered, n = numbered_catalogue(catalogue, column)
    slim = df.select(F.struct(key).alias("__key"), round_keys(seed, key).alias("__keys"))
    places = F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")) if n else F.expr("cast(array() as array<bigint>)")
    placed = slim.withColumn("__i", F.explode(places)).select("__key", "__i", permuted(F.col("__i"), F.col("__keys"), max(1, n)).alias("__number"))
    named = _entries(placed, F.col("__key"), numbered, n)
    grouped = named.groupBy("__key", F.expr(f"cast(__i div {size} as int)").alias("block"))
    members = grouped.agg(F.sort_array(F.collect_list(F.struct("__i", column))).alias("__m"))
    listed = members.select("__key", "block", F.transform("__m", lambda m: m[column]).alias("members"))
    return df.withColumn("__key", F.struct(key)).join(listed, "__key").drop("__key")


def sign_labels(df: DataFrame, x: Column, y: Column) -> DataFrame:
    """Mirror each point into the four quadrants and label each axis by its sign."""
    # The four directions.
    directions = [(1, 1), (1, -1), (-1, 1), (-1, -1)]
    literal = F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a, b in directions])
    moved = df.withColumn("__d", F.explode(literal))
    moved = moved.withColumn("x", x * F.col("__d.dx")).withColumn("y", y * F.col("__d.dy")).drop("__d")
    return moved.withColumn("right", (F.col("x") > 0).cast("int")).withColumn("up", (F.col("y") > 0).cast("int"))


def folded_changes(changes: DataFrame, key: str, order: str) -> DataFrame:
    """One change per key: of each field the last non-null value in `order`, as if the changes came one after the other."""
    fields = [c for c in changes.columns if c not in (key, order)]
    newest = [F.max(F.when(F.col(c).isNotNull(), F.struct(order, c)))[c].alias(c) for c in fields]
    return changes.groupBy(key).agg(*newest)


def merged_fields(base: DataFrame, changes: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Upsert by key: a non-null changed field replaces the old one, other fields stay, new keys are added.

    Several changes of a key are folded in `order`; without an order, a key changes once.
    """
    if order is not None:
        changes = folded_changes(changes, key, order)
    fields: Mapping[str, None] = dict.fromkeys([*base.columns, *changes.columns])
    old = base.select(F.col(key), F.struct(*[c for c in base.columns if c != key]).alias("__old"))
    new = changes.select(F.col(key), F.struct(*[c for c in changes.columns if c != key]).alias("__new"))
    joined = old.join(new, key, "full_outer")

    def field(name: str) -> Column:
        sides = [F.col(f"{side}.{name}") for side, df in (("__new", changes), ("__old", base)) if name in df.columns]
        return F.coalesce(*sides).alias(name)

    return joined.select(key, *[field(name) for name in fields if name != key])
