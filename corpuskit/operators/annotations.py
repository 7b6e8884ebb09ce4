"""Span annotations, entities and relations: conversions that stay inside the row."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import islice

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from corpuskit.functions import text as tx
from corpuskit.functions.arrays import text_array
from corpuskit.functions.binding import let
from corpuskit.functions.prompts import render
from corpuskit.operators import rows
from corpuskit.session import cut_lineage

SWAP_ROWS = 256  # rows whose entities are Python strings at a time


def typed_spans(raw: Column) -> Column:
    """`[[start, end, class], ...]` read as strings, with typed fields."""
    return F.transform(
        raw,
        lambda s: F.struct(
            s[0].try_cast("int").alias("start"), s[1].try_cast("int").alias("end"), s[2].alias("label")
        ),
    )


def has_unknown_class(spans: Column, schema: Sequence[str]) -> Column:
    known = text_array(schema)
    return F.exists(spans, lambda s: ~F.array_contains(known, s["label"]))


def entities_by_class(text: Column, spans: Column, schema: Sequence[str]) -> Column:
    """Struct with a list of entity texts for every class of the schema, empty where there is none."""
    return F.struct(
        *[
            F.transform(
                F.filter(spans, _labelled(name)),
                lambda s: tx.slice_text(text, s["start"], s["end"]),
            ).alias(name)
            for name in schema
        ]
    )


def _labelled(name: str):
    return lambda s: s["label"] == name


def extraction_records(df: DataFrame, text: str, spans: str, schema: Sequence[str], template: str) -> tuple[DataFrame, DataFrame]:
    """Instruction records, and the rows set aside because a span has a class outside the schema."""
    strange = F.coalesce(has_unknown_class(F.col(spans), schema), F.lit(False))
    listed = ", ".join(schema)
    records = df.where(~strange).select(
        *[c for c in df.columns if c not in (text, spans)],
        render(template, {"schema": listed, "text": F.col(text)}).alias("instruction"),
        F.lit("").alias("input"),
        F.to_json(entities_by_class(F.col(text), F.col(spans), schema)).alias("output"),
    )
    return records, df.where(strange)


def named_entities(text: Column, entities: Column) -> Column:
    """Entity texts with their types, in annotation order."""
    return F.transform(
        entities,
        lambda e: F.struct(
            tx.slice_text(text, e["start_offset"], e["end_offset"]).alias("entity"), e["label"].alias("entity_type")
        ),
    )


def triples(text: Column, entities: Column, relations: Column) -> Column:
    """Relations with both ends resolved by entity id; a relation to a missing entity has null ends."""
    by_id = F.map_from_entries(
        F.transform(
            entities,
            lambda e: F.struct(
                e["id"],
                F.struct(
                    tx.slice_text(text, e["start_offset"], e["end_offset"]).alias("name"), e["label"].alias("type")
                ),
            ),
        )
    )

    def resolved(lookup: Column) -> Column:
        return F.transform(
            relations,
            lambda r: F.struct(
                F.element_at(lookup, r["from_id"])["name"].alias("head"),
                F.element_at(lookup, r["from_id"])["type"].alias("head_type"),
                r["type"].alias("relation"),
                F.element_at(lookup, r["to_id"])["name"].alias("tail"),
                F.element_at(lookup, r["to_id"])["type"].alias("tail_type"),
            ),
        )

    return let(by_id, resolved)


def spans_from_predictions(text: Column, predicted: Column, schema: Sequence[str]) -> Column:
    """Spans of the first occurrence of every predicted entity, class by class; entities not in the text are left out.

    `predicted` maps a class to its entity texts.
    """

    def of_class(name: Column) -> Column:
        return F.transform(
            F.coalesce(F.element_at(predicted, name), F.array().cast("array<string>")),
            lambda e: F.struct(
                (F.position(e, text) - 1).cast("int").alias("start"),
                (F.position(e, text) - 1 + F.length(e)).cast("int").alias("end"),
                name.alias("label"),
            ),
        )

    return F.filter(F.flatten(F.transform(text_array(schema), of_class)), lambda s: s["start"] >= 0)


def labels_by_class(entities: Column, schema: Sequence[str]) -> Column:
    """Map from every class to its entity texts; entities of other classes are left out."""
    return F.map_from_entries(
        F.transform(
            text_array(schema),
            lambda name: F.struct(
                name,
                F.transform(F.filter(entities, lambda e: e["entity_type"] == name), lambda e: e["entity"]),
            ),
        )
    )


def _successors(known: DataFrame, entity: str, label: str, seed: str) -> DataFrame:
    """(label, entity, replacement): the next entity of the same class and length in a seeded order."""
    described = cut_lineage(known.select(label, F.length(entity).alias("__len"), entity).distinct(), "described")
    numbered = cut_lineage(rows.index_by_draw(described, seed, entity, by=[label, "__len"], name="__i"), "numbered")
    sizes = described.groupBy(label, "__len").agg(F.count(F.lit(1)).alias("__n"))
    successor = numbered.join(sizes, [label, "__len"]).withColumn("__next", (F.col("__i") + 1) % F.col("__n"))
    target = numbered.select(label, "__len", F.col("__i").alias("__next"), F.col(entity).alias("replacement"))
    return successor.join(target, [label, "__len", "__next"]).select(label, entity, "replacement")


@F.arrow_udf(returnType=StructType([StructField("swapped", IntegerType()), StructField("text", StringType())]))
def _with_swaps(texts: pa.Array, entities: pa.Array, swaps: pa.Array) -> pa.Array:
    """Texts with their entities replaced, each read once from start to end, and how many changed. Entities without a swap stay."""
    changed, out = [], []
    for first in range(0, len(texts), SWAP_ROWS):
        lists = [x.slice(first, SWAP_ROWS) for x in (entities, swaps)]
        sizes = [pc.list_value_length(x).fill_null(0).to_pylist() for x in lists]
        placed, known = (zip(*(pc.struct_field(x.flatten(), i).to_pylist() for i in (0, 1)), strict=True) for x in lists)
        for text, n, m in zip(texts.slice(first, SWAP_ROWS).to_pylist(), *sizes, strict=True):
            to, pieces, end, n_changed = dict(islice(known, m)), [], 0, 0
            for start, entity in islice(placed, n):
                old = entity or ""
                new = to.get(old, old)
                pieces += (text[end:start], new)
                n_changed += new != old
                end = start + len(old)
            changed.append(n_changed)
            out.append("".join([*pieces, text[end:]]) if pieces else text)
    return pa.StructArray.from_arrays([pa.array(changed, pa.int32()), pa.array(out, pa.string())], ["swapped", "text"])


def all_entities_swapped(df: DataFrame, key: str, text: str, entities: str, label: str, seed: str) -> DataFrame:
    """Every entity of a text replaced by the next one of its class and length; adds `swapped`, how many of them changed.

    `entities` is an array of (start, entity) in the order of the text, without overlaps. Each distinct entity of a text is looked
    up once; texts themselves are not multiplied, and each is put together in one pass over it. Rows without a class keep their text. `key` tells rows apart.
    """
    own = df.select(F.struct(key).alias("__key"), F.col(label).alias("__label"), F.explode(F.array_distinct(F.col(entities)["entity"])).alias("__entity"))
    held = cut_lineage(own, "entities")
    swaps = cut_lineage(_successors(held.where(F.col("__label").isNotNull()), "__entity", "__label", seed), "swaps")
    named = held.join(swaps, ["__label", "__entity"]).groupBy("__key").agg(F.map_from_entries(F.collect_list(F.struct("__entity", "replacement"))).alias("__swaps"))
    found = df.withColumn("__key", F.struct(key)).join(named, "__key", "left")
    placed = F.transform(entities, lambda e: F.struct(e["start"].alias("start"), e["entity"].alias("entity")))
    found = found.withColumn("__new", _with_swaps(F.col(text), placed, F.map_entries("__swaps")))
    return found.withColumn("swapped", F.col("__new.swapped")).withColumn(text, F.col("__new.text")).drop("__key", "__swaps", "__new")


def entity_swaps(df: DataFrame, key: str, text: str, entity: str, start: str, label: str, seed: str) -> DataFrame:
    """Each entity replaced by the next one of its class and length in a seeded order; alone in both, or without a class, it stays."""
    swaps = _successors(df, entity, label, seed)
    swapped = F.overlay(F.col(text), F.col("replacement"), F.col(start) + 1, F.length(entity))
    found = df.join(swaps, [label, entity], "left").withColumn("replacement", F.coalesce("replacement", entity))
    return found.withColumn(text, F.coalesce(swapped, F.col(text)))
