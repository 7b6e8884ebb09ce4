"""Text templates compiled once into a single Column expression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def render(template: str, slots: Mapping[str, Column | str | int | float]) -> Column:
    """`{name}` takes the slot's value (null becomes empty); `{{` and `}}` are plain braces."""
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            value = slots[name]
            column = value if isinstance(value, Column) else F.lit(str(value))
            parts.append(F.coalesce(column.cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def bind(template: str, **values: str) -> str:
    """Fill some slots now and keep the others open."""
    out: list[str] = []
    for literal, name, _, _ in Formatter().parse(template):
        out.append(double_braces(literal))
        if name is not None:
            out.append(double_braces(str(values[name])) if name in values else "{" + name + "}")
    return "".join(out)


def double_braces(text: str) -> str:
    return text.replace("{", "{{").replace("}", "}}")


def escape_braces(c: Column) -> Column:
    """Make a text safe for use inside a template."""
    return F.replace(F.replace(c, F.lit("{"), F.lit("{{")), F.lit("}"), F.lit("}}"))


def replace_keyword(template: str, keyword: str, c: Column) -> Column:
    return F.replace(F.lit(template), F.lit(keyword), F.coalesce(c, F.lit("")))


def example_block(examples: DataFrame, template: str, order: str, k: int, separator: str = "\n\n") -> str:
    """The first `k` examples rendered and joined. Prompts hold few examples, so `k` rows come to the driver."""
    slots = {name: F.col(name) for name in examples.columns}
    rendered = examples.orderBy(order).limit(k).select(order, render(template, slots).alias("__text"))
    return separator.join(row["__text"] for row in sorted(rendered.collect(), key=lambda r: r[order]))


def few_shot(prefix: str, examples: str, suffix: str, slots: Mapping[str, Column], separator: str = "\n\n") -> Column:
    """Prefix, ready examples and suffix; slots are filled in prefix and suffix only."""
    return F.concat_ws(separator, render(prefix, slots), F.lit(examples), render(suffix, slots))


def with_instruction(instruction: str, c: Column) -> Column:
    return F.concat(F.lit(instruction), c)


def with_instruction_each(instruction: str, passages: Column) -> Column:
    return F.transform(passages, lambda p: F.concat(F.lit(instruction), p))


def instruction_record(instruction: Column, text: Column, output: Column) -> Sequence[Column]:
    return [instruction.alias("instruction"), text.alias("input"), output.alias("output")]
