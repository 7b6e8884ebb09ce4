"""Strict reading of model output: fenced JSON, lists, typed records.

Spark's JSON functions stop at the end of the first value and ignore what follows. Here the text is put inside an
outer object that ends with a sentinel field; trailing text breaks the outer object, so the sentinel is not found.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.functions.binding import let
from corpuskit.functions.text import strip

SENTINEL = "__whole"


def fenced_json(c: Column) -> Column:
    """Text inside the first ```json fence; null without one."""
    return F.when(c.rlike(r"(?s)```json.*?```"), strip(F.regexp_extract(c, r"(?s)```json(.*?)```", 1)))


def bare_json(c: Column) -> Column:
    """Text inside the first fence of either kind, else the whole text."""
    inner = F.regexp_extract(c, r"(?s)```(?:json)?(.*?)```", 1)
    return strip(F.when(c.rlike(r"(?s)```.*?```"), inner).otherwise(c))


def _wrapped(text: Column) -> Column:
    """The outer object around a text that may be one JSON object, parsed."""
    outer = F.concat(F.lit('{"v":'), text, F.lit(f',"{SENTINEL}":1}}'))
    return F.when(F.startswith(text, F.lit("{")) & ~F.contains(text, F.lit(SENTINEL)), F.try_parse_json(outer))


def _unwrapped(parsed: Column) -> Column:
    return F.when(F.try_variant_get(parsed, f"$.{SENTINEL}", "int") == 1, F.try_variant_get(parsed, "$.v", "variant"))


def whole_variant(json: Column) -> Column:
    """Variant of a text that is exactly one JSON object, else null."""
    return let(json, lambda text: let(_wrapped(text), _unwrapped))


def list_after_think(c: Column) -> Column:
    """The bracketed list right after the closing think tag; empty when there is none."""
    return F.regexp_extract(c, r"(?s)</think>\n*(\[.*?\])", 1)


def first_list(c: Column) -> Column:
    """The first bracketed list anywhere; empty when there is none."""
    return F.regexp_extract(c, r"(?s)(\[.*?\])", 1)


def text_list(c: Column) -> Column:
    """A list literal with single or double quotes as an array; empty unless its first item is quoted. Nothing is evaluated."""
    options = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}

    def read(text: Column) -> Column:
        quoted_first = text.rlike(r"""(?s)\A\[\s*['"].*\]\z""")
        return F.when(quoted_first, F.from_json(F.regexp_replace(text, r",\s*\]\z", "]"), "array<string>", options))

    return F.coalesce(let(c, read), F.array().cast("array<string>"))


def lon_lat(response: Column) -> Column:
    """Struct of doubles from a map-service answer whose first geocode holds `"lon,lat"`; nulls when it holds none."""
    parsed = F.from_json(response, "struct<status: string, geocodes: array<struct<location: string>>>")
    parts = F.split(F.try_element_at(parsed["geocodes"], F.lit(1))["location"], ",")
    return F.struct(
        F.try_element_at(parts, F.lit(1)).try_cast("double").alias("lon"),
        F.try_element_at(parts, F.lit(2)).try_cast("double").alias("lat"),
    )


@dataclass(frozen=True)
class Field:
    """A field of a typed record. Kinds: text, list, text_or_list (always read as a list), number."""

    name: str
    kind: str = "text"
    required: bool = True
    choices: Sequence[str] | None = None
    lo: float | None = None
    hi: float | None = None


def _value(raw: Column, kind: Column, field: Field) -> Column:
    """The field as its type, or null; `kind` is the schema of the raw value."""
    text_kind, list_kind = kind == "STRING", kind.isin("ARRAY<STRING>", "ARRAY<VOID>")
    as_text, as_list = F.try_variant_get(raw, "$", "string"), F.try_variant_get(raw, "$", "array<string>")
    if field.kind == "text":
        return F.when(text_kind, as_text)
    if field.kind == "list":
        return F.when(list_kind, as_list)
    if field.kind == "text_or_list":
        return F.when(text_kind, F.array(as_text)).when(list_kind, as_list)
    if field.kind == "number":
        numeric = kind.isin("BIGINT", "DOUBLE", "FLOAT") | F.startswith(kind, F.lit("DECIMAL"))
        return F.when(numeric, F.try_variant_get(raw, "$", "double"))
    raise ValueError(f"unknown kind {field.kind}")


def _error(raw: Column, value: Column, field: Field) -> Column:
    """What is wrong with the field, or null."""
    checks: list[tuple[Column, str]] = [(value.isNull(), "wrong type")]
    if field.choices is not None:
        known = F.array(*[F.lit(c) for c in field.choices])
        named = F.array(value) if field.kind == "text" else value
        checks.append((F.exists(named, lambda x: ~F.array_contains(known, x)), "not a choice"))
    if field.lo is not None:
        checks.append((value < field.lo, "too small"))
    if field.hi is not None:
        checks.append((value > field.hi, "too large"))
    wrong = reduce(
        lambda rest, check: F.when(check[0], F.lit(f"{field.name}: {check[1]}")).otherwise(rest),
        reversed(checks),
        F.lit(None).cast("string"),
    )
    absent = F.lit(f"{field.name}: missing") if field.required else F.lit(None).cast("string")
    return F.when(raw.isNotNull() & ~F.is_variant_null(raw), wrong).otherwise(absent)


def _field(raw: Column, field: Field) -> Column:
    """Struct of the value and the error text, one of them null."""
    value = _value(raw, F.schema_of_variant(raw), field)
    return let(value, lambda v: F.struct(v.alias("value"), _error(raw, v, field).alias("error")))


def typed_record(c: Column, fields: Sequence[Field]) -> Column:
    """Struct of `valid`, `errors` and one value per field. Fences and lead-in text before a fence are allowed."""

    def assemble(read: Column) -> Column:
        errors = F.array_compact(F.array(*[read[f.name]["error"] for f in fields]))
        return F.struct(
            (F.size(errors) == 0).alias("valid"),
            errors.alias("errors"),
            *[read[f.name]["value"].alias(f.name) for f in fields],
        )

    def part(record: Column, f: Field) -> Column:
        return let(F.try_variant_get(record, f"$.{f.name}", "variant"), lambda raw: _field(raw, f)).alias(f.name)

    def from_record(record: Column) -> Column:
        good = let(F.struct(*[part(record, f) for f in fields]), assemble)
        return let(
            good,
            lambda g: F.struct(
                (g["valid"] & record.isNotNull()).alias("valid"),
                F.when(record.isNull(), F.array(F.lit("not one JSON object"))).otherwise(g["errors"]).alias("errors"),
                *[g[f.name].alias(f.name) for f in fields],
            ),
        )

    return let(whole_variant(bare_json(c)), from_record)


def with_typed_record(df: DataFrame, reply: Column, fields: Sequence[Field], name: str = "record") -> DataFrame:
    """Add `typed_record` of a reply, one projection per step instead of nested functions.

    A step is used several times by the next one, so Catalyst keeps the projections apart: each text is parsed once and each field
    read once, inside generated code.
    """
    marks = range(len(fields))
    parsed = df.withColumn("__json", bare_json(reply)).withColumn("__outer", _wrapped(F.col("__json")))
    found = parsed.withColumn("__object", _unwrapped(F.col("__outer"))).drop("__json", "__outer")
    raw = found.withColumns({f"__raw{i}": F.try_variant_get("__object", f"$.{fields[i].name}", "variant") for i in marks})
    kinds = raw.withColumns({f"__kind{i}": F.schema_of_variant(f"__raw{i}") for i in marks})
    values = kinds.withColumns({f"__value{i}": _value(F.col(f"__raw{i}"), F.col(f"__kind{i}"), fields[i]) for i in marks})
    wrong = F.array_compact(F.array(*[_error(F.col(f"__raw{i}"), F.col(f"__value{i}"), fields[i]) for i in marks]))
    broken = F.col("__object").isNull()
    errors = values.withColumn("__errors", F.when(broken, F.array(F.lit("not one JSON object"))).otherwise(wrong))
    record = F.struct(
        (F.size("__errors") == 0).alias("valid"), F.col("__errors").alias("errors"), *[F.col(f"__value{i}").alias(fields[i].name) for i in marks]
    )
    return errors.select(*[F.col(c) for c in df.columns if c != name], record.alias(name))
