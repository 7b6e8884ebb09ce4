"""Conversation rows rendered as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN_BLOCK = 64


def _joined(order: str, value: str, separator: str = "") -> Column:
    ordered = F.sort_array(F.collect_list(F.struct(order, value)))
    return F.array_join(F.transform(ordered, lambda e: e[value]), separator)


def with_history(df: DataFrame, conv: str = "conv_id", turn: str = "turn", separator: str = "\n") -> DataFrame:
    """All earlier turns of the conversation as `role: text` lines. The result itself holds every prefix.

    Turns are taken in blocks: a row's history is the text of the earlier blocks and the earlier turns of its own. So the
    rows of one long conversation are built in many tasks, and only its block texts meet in one.
    """
    line = F.concat_ws(": ", "role", "text")
    blocked = df.withColumn("__b", F.floor(F.col(turn) / TURN_BLOCK)).withColumn("__line", line)
    texts = blocked.groupBy(conv, "__b").agg(_joined(turn, "__line", separator).alias("__t"))
    earlier_blocks = Window.partitionBy(conv).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    prefixes = texts.select(conv, "__b", F.collect_list("__t").over(earlier_blocks).alias("__before"))
    earlier_turns = Window.partitionBy(conv, "__b").orderBy(turn).rowsBetween(Window.unboundedPreceding, -1)
    local = blocked.withColumn("__own", F.collect_list("__line").over(earlier_turns))
    history = F.array_join(F.concat("__before", "__own"), separator)
    return local.join(prefixes, [conv, "__b"]).withColumn("history", history).select(*df.columns, "history")


def rendered_chat(df: DataFrame, conv: str = "conv_id", turn: str = "turn", begin: str = "<|", end: str = "|>") -> DataFrame:
    """One text per conversation: blocks of turns are joined first, and the blocks after that."""
    line = F.concat(F.lit(begin), "role", F.lit(end + "\n"), F.coalesce("text", F.lit("")), F.lit("\n"))
    blocked = df.select(conv, turn, F.floor(F.col(turn) / TURN_BLOCK).alias("__b"), line.alias("__t"))
    parts = blocked.groupBy(conv, "__b").agg(_joined(turn, "__t").alias("__p"), F.count(F.lit(1)).alias("__n"))
    return parts.groupBy(conv).agg(_joined("__b", "__p").alias("text"), F.sum("__n").alias("turns"))
