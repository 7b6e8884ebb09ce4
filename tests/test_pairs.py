from __future__ import annotations

import hashlib
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from corpuskit.functions import permute
from corpuskit.operators import lookups, pairs
from corpuskit.session import PARTITIONS_KEY, cut_lineage


def test_hot_group_in_blocks_equals_combinations(spark):
    members = {1: [*range(200)], 2: [3, 1, 2], 3: [7], 4: [5, 5, 6]}
    df = spark.createDataFrame([(g, m) for g, ms in members.items() for m in ms], "g int, m bigint")
    expected = {(g, a, b) for g, ms in members.items() for a, b in combinations(sorted(set(ms)), 2)}
    for block in (7, 50, 1000):
        found = pairs.unordered_pairs(df, "g", "m", block_members=block).collect()
        assert len(found) == len(expected)
        assert {tuple(r) for r in found} == expected


def test_no_join_key_holds_a_whole_hot_group(spark):
    df = spark.range(2000).select(F.concat(F.lit("hot"), (F.col("id") % 1).cast("string")).alias("g"), "id")
    found = pairs.unordered_pairs(df, "g", "id", block_members=100)
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert found.count() == 2000 * 1999 // 2


def test_all_pairs_of_a_table(spark):
    df = spark.range(300)
    for block in (40, 1000):
        found = pairs.all_pairs(df, "id", block_members=block)
        plan = found._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert {tuple(r) for r in found.collect()} == set(combinations(range(300), 2))
        assert found.count() == 300 * 299 // 2


def test_order_of_ends_does_not_matter(spark):
    df = spark.createDataFrame([(1, "A"), (1, "B"), (2, "B"), (2, "A"), (3, None), (3, "A")], "g int, m string")
    assert [tuple(r) for r in pairs.pair_counts(df, "g", "m").collect()] == [("A", "B", 2)]


def test_both_in(spark):
    df = spark.createDataFrame([("A", "B", 2), ("A", "C", 1)], "a string, b string, n int")
    targets = spark.createDataFrame([("A",), ("B",), ("B",)], "name string")
    out = {(r["a"], r["b"]): r["both_in"] for r in pairs.flag_both_in(df, targets, "name").collect()}
    assert out == {("A", "B"): 1, ("A", "C"): 0}


def test_more_pairs_are_more_partitions(spark, monkeypatch):
    widest = []

    def cut(df, name="stage"):
        widest.append(int(spark.conf.get(PARTITIONS_KEY)))
        return cut_lineage(df, name)

    monkeypatch.setattr(pairs, "cut_lineage", cut)
    before = spark.conf.get(PARTITIONS_KEY)
    df = spark.range(0, 2_400_000, numPartitions=8).select(F.floor(F.col("id") / 8).alias("g"), (F.col("id") * 7 % 2_400_000).alias("m"))
    counted = pairs.pair_counts(df, "g", "m")
    assert counted.count() == 300_000 * 28 and widest[-1] >= 9, "8.4 million pairs are not left to the session's eight partitions"
    assert pairs.distinct_pairs(df.where("g < 10"), "g", "m").count() == 280
    assert spark.conf.get(PARTITIONS_KEY) == before


def brute_shuffle(seed, key, n):
    a, b = permute.grid(n)
    digits = hashlib.md5(f"{seed}:{key}".encode()).hexdigest()
    keys = [int(digits[8 * j : 8 * j + 8], 16) for j in range(4)]

    def step(x):
        sides = [x // b, x % b]
        for j, k in enumerate(keys):
            sides[j % 2] = (sides[j % 2] + (((sides[1 - j % 2] + 1) * (k | 1)) >> 9 & 0x7FFFFFFF)) % (a, b)[j % 2]
        return sides[0] * b + sides[1]

    out = []
    for i in range(n):
        x = step(i)
        while x >= n:
            x = step(x)
        out.append(x)
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 23, 25])
def test_catalogue_blocks_are_shuffles(spark, n):
    firms = spark.range(20).withColumnRenamed("id", "k")
    names = [f"c{i:02}" for i in range(n)]
    catalogue = spark.createDataFrame([(name,) for name in names * 2], "name string")
    got = {(r["k"], r["block"]): r["members"] for r in lookups.catalogue_blocks(firms, catalogue, "name", "k", 5, "s").collect()}
    for k in range(20):
        order = brute_shuffle("s", k, n)
        assert sorted(order) == list(range(n))
        assert [name for b in range(-(-n // 5)) for name in got.pop((k, b))] == [names[x] for x in order]
    assert not got
    assert n < 9 or len({tuple(brute_shuffle("s", k, n)) for k in range(200)}) == 200


def test_grid_has_few_cells_too_many():
    for n in range(1, 3000):
        a, b = permute.grid(n)
        assert n <= a * b < n + max(2, a)


def test_each_with_every_entry_in_even_tasks(spark):
    firms = spark.range(2000).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in (5, 3000 // 20):
            catalogue = spark.range(n).selectExpr("concat('c', id) AS name")
            out = lookups.each_with(firms, catalogue, "name")
            sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 2000 * n and max(sizes) < 2 * sum(sizes) / 8
            assert out.distinct().count() == 2000 * n
        assert lookups.each_with(firms, catalogue.limit(0), "name").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
