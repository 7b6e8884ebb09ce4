"""Reading with SQL and writing in batches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FETCH_LIMITS = {"one": 1, "many": 10, "all": None}  # fixed values: rows per fetch type


def fetch(spark: SparkSession, sql: str, fetch_type: str = "all", args: Mapping | None = None, **tables: DataFrame) -> DataFrame:
    """Rows of a query with bound parameters; `{name}` stands for a table. Give an ORDER BY with 'one' and 'many'."""
    df = spark.sql(sql, args=dict(args or {}), **tables)
    limit = FETCH_LIMITS[fetch_type]
    return df if limit is None else df.limit(limit)


def updated(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Rows with some columns replaced where the condition holds."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def append_jdbc(df: DataFrame, url: str, name: str, properties: Mapping[str, str], batch_size: int = 1000) -> None:
    """Every partition inserts over its own connection, in batches."""
    df.write.option("batchsize", str(batch_size)).jdbc(url, name, mode="append", properties=dict(properties))
