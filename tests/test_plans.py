"""What the physical plans may and may not hold, with automatic broadcasts switched off as for large tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the queries
from corpuskit.operators import lookups, rows, votes
from corpuskit.plans import registry

# Queries that call Python by nature: outside calls, encoders, matrix products, index blocks, common subsequences, the batch map.
PYTHON = {"x1", "x2", "x3", "x4", "x8", "v1", "v2", "v3", "v4", "v5", "v6", "v7", "v8", "v9", "v12", "v13", "v14", "v15", "j14"} | {
    "e1", "e2", "e3", "e4", "e11", "e15",
}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(n for n in registry.QUERIES if not n.startswith(("t", "s"))))
def test_no_cross_joins_and_no_row_functions(spark, sf_dir, no_broadcast, name):
    plan = _plan(registry.QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan
    if name.split("_")[0] not in PYTHON:
        assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = _plan(votes.group_sizes(events.where(F.col("user_id") == 3), ["event_type"]))
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,3)]" in plan
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan


def test_ranked_groups_are_cut_before_the_shuffle(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    plan = _plan(rows.sampled_per_group(docs, ["source"], "s", "doc_id", 10))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_group_numbers_shuffle_the_rows_once(spark, sf_dir, no_broadcast):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id")
    plan = _plan(rows.index_by_key(events, "event_id", ["user_id"]))
    rows_side = plan.split("SortMergeJoin")[1].split("FileScan")[0]
    assert rows_side.count("Exchange") == 1


def test_upsert_is_one_join(spark, sf_dir, no_broadcast):
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    plan = _plan(lookups.merged_fields(customer, customer.select("c_custkey", "c_acctbal"), "c_custkey"))
    assert plan.count("Exchange") == 2
