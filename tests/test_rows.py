from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpuskit.functions.hashing import draw_hex
from corpuskit.operators import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one group, and the ids are far from evenly spread."""
    ids = spark.range(3000).select((F.col("id") * F.col("id")).alias("id"))
    group = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 50).cast("string")))
    return ids.withColumn("g", group)


def _same(a, b, columns):
    left = {tuple(r) for r in a.select(*columns).collect()}
    right = {tuple(r) for r in b.select(*columns).collect()}
    assert left == right


def test_index_equals_simple_window(skewed):
    simple = skewed.withColumn("idx", (F.row_number().over(Window.orderBy("id")) - 1).cast("bigint"))
    _same(rows.index_by_key(skewed, "id", slices=16), simple, ["id", "idx"])


def test_group_index_equals_simple_window(skewed):
    w = Window.partitionBy("g").orderBy("id")
    simple = skewed.withColumn("idx", (F.row_number().over(w) - 1).cast("bigint"))
    _same(rows.index_by_key(skewed, "id", ["g"], slices=16), simple, ["g", "id", "idx"])


def test_text_keys(skewed):
    named = skewed.withColumn("name", F.concat(F.lit("Müller#"), F.lpad(F.col("id").cast("string"), 9, "0")))
    simple = named.withColumn("idx", (F.row_number().over(Window.orderBy("name")) - 1).cast("bigint"))
    _same(rows.index_by_key(named, "name", slices=16), simple, ["name", "idx"])
    assert rows.sliced_by_value(named, "name", 16).select(rows.SLICE).distinct().count() > 8
    mixed = skewed.sparkSession.createDataFrame([("",), ("a",), ("é",), ("𝒳",), ("Z",), ("ab",)], "name string")
    order = sorted((r["name"] for r in mixed.collect()), key=str.encode)
    assert {r["name"]: r["idx"] for r in rows.index_by_key(mixed, "name").collect()} == {n: i for i, n in enumerate(order)}


def test_head_of_any_size_without_a_sort(spark, monkeypatch):
    monkeypatch.setattr(rows, "CUT_ROWS", 3)
    monkeypatch.setattr(rows, "CUT_DIGITS", 1)
    keys = [*range(300), None, *[7] * 40]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "id bigint, n int").repartition(5)
    order = sorted(keys, key=lambda k: (hashlib.md5((f"s:{k}" if k is not None else "s").encode()).hexdigest(), k is not None, k or 0))
    for n in (0, 1, 2, 150, order.index(7) + 1, order.index(7) + 41, len(keys), 10_000):
        out = rows.shuffled_head(df, "s", "id", n)
        assert sorted((r["id"] for r in out.collect()), key=str) == sorted(order[:n], key=str)
    plan = rows.shuffled_head(df, "s", "id", order.index(7))._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Limit" not in plan and "SinglePartition" not in plan


def test_nested_samples(skewed):
    out = rows.nested_samples(skewed, "s", "id", [5, 20]).collect()
    small, large = ({r["id"] for r in out if r["size"] == n} for n in (5, 20))
    assert len(small) == 5 and len(large) == 20 and small < large


def test_draw_index_is_a_permutation_by_hash(skewed):
    simple = skewed.withColumn("idx", (F.row_number().over(Window.orderBy(draw_hex("s", "id"))) - 1).cast("bigint"))
    _same(rows.index_by_draw(skewed, "s", "id", slices=16), simple, ["id", "idx"])


def test_index_does_not_depend_on_partitions(skewed):
    _same(rows.index_by_draw(skewed.repartition(3), "s", "id"), rows.index_by_draw(skewed.repartition(11), "s", "id"), ["id", "idx"])


def test_hot_group_is_cut_into_slices(skewed):
    sliced = rows.sliced_by_value(skewed.where(F.col("g") == "hot"), "id", 16)
    sizes = [r["count"] for r in sliced.groupBy(rows.SLICE).count().collect()]
    assert len(sizes) >= 12 and max(sizes) <= 2 * 1000 / 12


def test_null_groups_and_empty_input(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id bigint, g string")
    assert {tuple(r) for r in rows.index_by_key(df, "id", ["g"]).collect()} == {(1, None, 0), (2, None, 1), (3, "a", 0)}
    assert rows.index_by_key(df.limit(0), "id").count() == 0


def test_large_cap_equals_small_cap_rule(skewed):
    w = Window.partitionBy("g").orderBy(draw_hex("s", "id"))
    simple = skewed.withColumn("n", F.row_number().over(w)).where("n <= 1500")
    _same(rows.sampled_per_group(skewed, ["g"], "s", "id", 1500), simple, ["g", "id"])
    middle = skewed.withColumn("n", F.row_number().over(w)).where("n <= 150")
    _same(rows.sampled_per_group(skewed, ["g"], "s", "id", 150), middle, ["g", "id"])
    small = skewed.withColumn("n", F.row_number().over(w)).where("n <= 5")
    _same(rows.sampled_per_group(skewed, ["g"], "s", "id", 5), small, ["g", "id"])


def test_splits_are_disjoint_and_complete(skewed):
    split = rows.split_by_ratio(skewed, "42", "id", 20)
    assert split.count() == 3000
    shares = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert 480 < shares["test"] < 720
    exact = rows.split_by_count(skewed, "42", "id", 100)
    assert exact.where("split = 'test'").count() == 100 and exact.count() == 3000


def test_chunks_and_quota(skewed):
    sizes = sorted(r["count"] for r in rows.chunked(skewed, "id", 700).groupBy("chunk").count().collect())
    assert sizes == [200, 700, 700, 700, 700]
    assert rows.daily_quota(skewed, "id", 0).where("day IS NOT NULL").count() == 0
    assert rows.daily_quota(skewed, "id", 1000).select(F.max("day")).first()[0] == 2


def test_batches_never_mix_sources(skewed):
    batches = rows.same_source_batches(skewed, "g", "id", 64)
    per_batch = batches.groupBy("batch").agg(F.countDistinct("g").alias("sources"), F.count("*").alias("n"))
    assert per_batch.where("sources > 1 OR n > 64").count() == 0


def test_error_budget(spark):
    flags = [0, 1, 1, 0, 1, 0]
    df = spark.createDataFrame([(i, "u", f) for i, f in enumerate(flags)], "id bigint, u string, f int")
    out = {r["id"]: (r["failures_before"], r["attempted"]) for r in rows.within_error_budget(df, ["u"], "id", F.col("f") == 1, 2).collect()}
    assert out == {0: (0, True), 1: (0, True), 2: (1, True), 3: (2, False), 4: (2, False), 5: (3, False)}


def test_call_slots_keep_the_rate(skewed):
    slots = rows.call_slots(skewed, "id", endpoints=3, per_second=4)
    assert slots.groupBy("endpoint", "second").count().where("count > 4").count() == 0


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_rows_without_a_key_come_first(spark, kind):
    keys = [None, 3, 1, None, 2, *range(10, 26)]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "n int, k bigint").withColumn("k", F.col("k").cast(kind))
    out = rows.index_by_key(df, "k", slices=4).collect()
    assert len(out) == len(keys) and sorted(r["idx"] for r in out) == list(range(len(keys)))
    assert {r["idx"] for r in out if r["k"] is None} == {0, 1}
    known = sorted((r["k"] for r in out if r["k"] is not None))
    assert [r["k"] for r in sorted(out, key=lambda r: r["idx"])][2:] == known
    chunks = rows.chunked(df, "k", 3).groupBy("chunk").count().collect()
    assert {r["chunk"]: r["count"] for r in chunks} == {i: 3 for i in range(7)}
    marked = rows.within_error_budget(df, [], "k", F.col("k").isNull(), 1).collect()
    assert len(marked) == len(keys)


def test_one_odd_text_key_does_not_fill_a_slice(spark):
    urls = [f"https://www.site.org/p/{i:06d}" for i in range(20_000)] + ["http://a.org/", "http://b.org/"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    sizes = [r["count"] for r in rows.sliced_by_value(df, "u", 16).groupBy(rows.SLICE).count().collect()]
    assert max(sizes) < 2 * len(urls) / 16
