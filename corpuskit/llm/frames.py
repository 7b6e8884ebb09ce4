"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def whole(df: DataFrame, name: str = "text") -> Column:
    """The whole text; null reads as the empty text."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def beside(df: DataFrame, fields: Column, names: list[str]) -> DataFrame:
    """The rows of `df` and the named fields of one struct, computed once per row.

    A column of `df` that has the name of a field gives way to the field.
    """
    held = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), fields.alias("out"))
    kept = [F.col(f"row.`{c}`") for c in df.columns if c not in names]
    return held.select(*kept, *[F.col(f"out.`{n}`") for n in names])


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which grows with the cluster and the input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send Python at most `rows` rows at a time, for tables of whole texts, whose batches would else be as large as their texts are long.

    A session that asks for fewer keeps its number.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))
