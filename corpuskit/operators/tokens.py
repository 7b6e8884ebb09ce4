"""Token tables: vocabularies, ids, labels and padded batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.functions import arrays
from corpuskit.operators import rows


def padded_batches(df: DataFrame, key: str, ids: str, batch_size: int, multiple_of: int = 1, pad_id: int = 0) -> DataFrame:
    """Pad each batch to its own longest row; the window holds `batch_size` rows and no more.

    Only keys and sizes are numbered and batched; the arrays meet their width in one join. A key that occurs twice fails the query.
    """
    sized = rows.chunked(df.select(key, F.size(ids).alias("__size")), key, batch_size, name="batch")
    longest = F.max("__size").over(Window.partitionBy("batch"))
    placed = sized.select(F.col(key).alias("__key"), "batch", arrays.padded_length(longest, multiple_of).alias("width"))
    counted = placed.groupBy("__key").agg(F.count(F.lit(1)).alias("__n"), F.first("batch").alias("batch"), F.first("width").alias("width"))
    twice = F.raise_error(F.concat(F.lit(f"{key} occurs twice: "), F.coalesce(F.col("__key").cast("string"), F.lit("null"))))
    once = counted.where(F.when(F.col("__n") > 1, twice.cast("boolean")).otherwise(True)).drop("__n")
    joined = df.drop("batch", "width").join(once, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")
    return joined.select(
        "*",
        (F.col("width") - F.size(ids)).alias("padding"),
        arrays.pad_right(F.col(ids), F.col("width"), pad_id).alias("input_ids"),
        arrays.pad_right(F.col(ids), F.col("width"), arrays.IGNORED_LABEL).alias("labels"),
        arrays.pad_right(F.transform(ids, lambda _: F.lit(1)), F.col("width"), 0).alias("attention_mask"),
    )


def padded_to(df: DataFrame, ids: str, length: int, pad_id: int = 0) -> DataFrame:
    """Fixed length: longer rows are cut, shorter ones padded, as a model's maximum input demands."""
    return df.withColumn(ids, arrays.pad_right(F.slice(F.col(ids), 1, length), F.lit(length), pad_id))


def distinct_tokens(df: DataFrame, tokens: Column, name: str = "token") -> DataFrame:
    """Each token once; repeats inside a text go before the shuffle sees them."""
    return df.select(F.explode(F.array_distinct(tokens)).alias(name)).distinct()


def vocabulary(tokens: DataFrame, name: str = "token", first_id: int = 0) -> DataFrame:
    """Token ids in the order of the tokens' hashes: dense, repeatable, and numbered without one big sort."""
    return rows.index_by_draw(tokens, "vocabulary", name, name="__idx").select(
        name, (F.col("__idx") + first_id).alias("id")
    )


def extended_vocabulary(known: DataFrame, tokens: DataFrame, name: str = "token") -> DataFrame:
    """Known tokens keep their ids; new ones follow after the largest."""
    fresh = tokens.join(known, name, "left_anti")
    last = known.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("last")).scalar()
    numbered = vocabulary(fresh, name).withColumn("id", F.col("id") + last + 1)
    return known.select(name, "id").unionByName(numbered)


def token_ids(df: DataFrame, keys: Sequence[str], tokens: Column, vocab: DataFrame, name: str = "token", unknown: int = 0) -> DataFrame:
    """Long form (keys, pos, id): one row per token, so that no text has to be gathered for the lookup.

    A hot token is a hot join key: Catalyst broadcasts a vocabulary below its size limit, and above it adaptive
    skew handling splits the hot partition.
    """
    exploded = df.select(*keys, F.posexplode(tokens).alias("pos", name))
    found = exploded.join(vocab, name, "left")
    return found.select(*keys, "pos", F.coalesce("id", F.lit(unknown)).alias("id"))
