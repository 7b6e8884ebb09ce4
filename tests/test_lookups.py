from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpuskit.operators import lookups
from corpuskit.sources import keyed


def test_strict_lookup_names_the_missing_key(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    dim = spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(PySparkException, match="no v for k 2"):
        lookups.strict_lookup(df, dim, "k", "v").collect()
    assert lookups.left_lookup(df, dim, "k", ["v"]).count() == 2


def test_side_by_side_rejects_repeated_keys(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    extra = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(PySparkException, match="k occurs twice: 1"):
        lookups.side_by_side(df, extra, "k").collect()


def test_merge_keeps_old_fields_and_adds_keys(spark):
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, name string, x double")
    changes = spark.createDataFrame([(2, 5.0, "new"), (3, None, "only")], "k int, x double, tag string")
    out = {r["k"]: (r["name"], r["x"], r["tag"]) for r in lookups.merged_fields(base, changes, "k").collect()}
    assert out == {1: ("a", 1.0, None), 2: ("b", 5.0, "new"), 3: (None, None, "only")}


def test_unknown_labels(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "l string")
    ids = lookups.with_label_id(df, lookups.catalogue_frame(df, ["a", "b"]), "l")
    assert sorted(r["label_id"] for r in ids.collect()) == [-1, -1, 0]


def test_insert_outcomes(spark):
    store = spark.createDataFrame([("old",)], "k string")
    batch = spark.createDataFrame([("old", 1), ("new", 3), ("new", 2), (None, 4)], "k string, n int")
    out = {r["n"]: r["outcome"] for r in keyed.insert_outcomes(batch, store, "k", "n").collect()}
    assert out == {1: 0, 2: 1, 3: 0, 4: -1}
    assert [tuple(r) for r in keyed.new_rows(batch, store, "k", "n").collect()] == [("new", 2)]


def test_latest_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, t int, v string")
    assert {tuple(r) for r in keyed.latest_per_key(df, ["k"], F.col("t")).collect()} == {("a", 2, "y"), ("b", 1, "z")}


def test_repeated_dimension_key_fails(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    dim = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    for lookup in (lookups.left_lookup(df, dim, "k", ["v"]), lookups.strict_lookup(df.where("k = 1"), dim, "k", "v")):
        with pytest.raises(Exception, match="occurs twice"):
            lookup.collect()
    nulls = spark.createDataFrame([(1, "a"), (None, "x"), (None, "y")], "k int, v string")
    assert {(r["k"], r["v"]) for r in lookups.left_lookup(df, nulls, "k", ["v"]).collect()} == {(1, "a"), (None, None)}


def test_several_changes_of_a_key(spark):
    base = spark.createDataFrame([(1, "a", 1)], "k int, v string, w int")
    changes = spark.createDataFrame([(1, "b", None, 2), (1, None, 7, 1), (1, "c", None, 1), (2, None, None, 1)], "k int, v string, w int, t int")
    got = {tuple(r) for r in lookups.merged_fields(base, changes, "k", order="t").collect()}
    assert got == {(1, "b", 7), (2, None, None)}


def test_outcomes_of_equal_and_null_orders(spark):
    batch = spark.createDataFrame([(1, 5), (1, 5), (2, None), (2, None), (3, 1), (None, 1), (4, None), (4, 9)], "k int, n int")
    store = spark.createDataFrame([(3, None)], "k int, n int")
    out = keyed.insert_outcomes(batch, store, "k", "n").groupBy("k").agg({"outcome": "sum"}).collect()
    assert {r[0]: r[1] for r in out} == {1: 1, 2: 1, 3: 0, None: -1, 4: 1}


def test_catalogue_with_a_null_entry(spark):
    df = spark.createDataFrame([(1,)], "k int")
    catalogue = spark.createDataFrame([("a",), (None,)], "c string")
    assert {r["c"] for r in lookups.each_with(df, catalogue, "c").collect()} == {"a", None}
