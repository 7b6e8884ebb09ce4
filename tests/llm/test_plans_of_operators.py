from __future__ import annotations

import pytest

from corpuskit.llm import queries  # noqa: F401  registers the queries
from corpuskit.llm.registry import QUERIES

# Operators without Python in the last plan, native ones among them.
NATIVE = {"op6", "op7", "op12"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_row_functions(spark, sf_dir, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan
    if name.split("_")[0] in NATIVE:
        assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan
