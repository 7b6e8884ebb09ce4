from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from corpuskit.functions import parsing

GOOD = ['{"a": 1}', ' {"a": [1, 2], "b": {"c": "x"}} ', '{"a": "}"}', "{}", '{"a": "目\\n"}']
BAD = ['{"a": 1} tail', '{"a": 1}, {"b": 2}', "{'a': 1}", '{"a": 1', "[1]", "1", "", '{"a": }', '{"a": 1}]', "text", '{"a": 1}}', "{a: 1}"]


@pytest.mark.parametrize("fence", [True, False])
def test_only_whole_json_objects_pass(spark, fence):
    texts = GOOD + BAD
    wrapped = [f"x ```json\n{t}\n``` y" if fence else t.strip() for t in texts]
    df = spark.createDataFrame(list(enumerate(wrapped)), "i int, c string")
    body = parsing.fenced_json(F.col("c")) if fence else F.col("c")
    found = df.orderBy("i").select(parsing.whole_variant(body).cast("string").alias("v")).collect()
    for text, row in zip(texts, found, strict=True):
        if text in GOOD:
            assert json.loads(row["v"]) == json.loads(text)
        else:
            assert row["v"] is None, text


def test_no_fence_gives_nothing(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("```\n{}\n```",), (None,)], "c string")
    assert [r[0] for r in df.select(parsing.fenced_json(F.col("c"))).collect()] == [None, None, None]


def test_lists(spark):
    cases = {
        "<think>[1]</think>\n\n['a', 'b']": ["a", "b"],
        '</think>["a",]': ["a"],
        "</think>[1, 'a']": [],
        "</think>[]": [],
        "</think>['a', __import__('os')]": [],
        "no list": [],
        "</think>['a": [],
        "</think>[\n 'a',\n \"b\"\n]": ["a", "b"],
        "</think> text ['a']": [],
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, c string")
    out = df.orderBy("i").select(parsing.text_list(parsing.list_after_think(F.col("c")))).collect()
    assert [r[0] for r in out] == list(cases.values())
    first = df.where("i = 8").select(parsing.text_list(parsing.first_list(F.col("c")))).first()[0]
    assert first == ["a"]


RECORD = '{"reason": "because", "label": %s}'
FIELDS = [parsing.Field("reason"), parsing.Field("label", "text_or_list")]


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("```json\n%s\n```" % (RECORD % '"sport"'), ["sport"]),
        ("```\n%s\n```" % (RECORD % '"sport"'), ["sport"]),
        ("``` \n \n%s\n\n ```" % (RECORD % '["sport", "ball"]'), ["sport", "ball"]),
        ("see below```  \n%s\n  ```" % (RECORD % '["sport", "ball"]'), ["sport", "ball"]),
        ("so the label is ``` \n%s ```" % (RECORD % '"sport"'), ["sport"]),
        (RECORD % '"sport"', ["sport"]),
        (RECORD % "[]", []),
    ],
)
def test_wrappings_of_typed_output(spark, text, label):
    row = spark.createDataFrame([(text,)], "c string").select(parsing.typed_record(F.col("c"), FIELDS).alias("p")).first()["p"]
    assert row["valid"] and row["errors"] == [] and row["label"] == label and row["reason"] == "because"


def test_typed_errors(spark):
    fields = [
        parsing.Field("kind", choices=["a", "b"]),
        parsing.Field("belong", "list"),
        parsing.Field("confidence", "number", required=False, lo=0, hi=1),
    ]
    cases = {
        '{"kind": "a", "belong": ["x"], "confidence": 0.5}': [],
        '{"kind": "a", "belong": ["x"]}': [],
        '{"kind": "c", "belong": "x", "confidence": 2}': ["kind: not a choice", "belong: wrong type", "confidence: too large"],
        '{"kind": 1, "confidence": -1}': ["kind: wrong type", "belong: missing", "confidence: too small"],
        '{"kind": null, "belong": [1]}': ["kind: missing", "belong: wrong type"],
        "nothing": ["not one JSON object"],
        None: ["not one JSON object"],
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, c string")
    out = df.orderBy("i").select(parsing.typed_record(F.col("c"), fields).alias("p")).collect()
    for row, errors in zip(out, cases.values(), strict=True):
        assert row["p"]["errors"] == errors and row["p"]["valid"] == (not errors)
    staged = parsing.with_typed_record(df.withColumn("p", F.lit(0)), F.col("c"), fields, "p")
    assert staged.columns == ["i", "c", "p"]
    assert [r["p"] for r in staged.orderBy("i").collect()] == [r["p"] for r in out]


def test_lon_lat(spark):
    cases = [
        '{"status": "1", "geocodes": [{"location": "116.4,39.9"}, {"location": "1,2"}]}',
        '{"status": "1", "geocodes": []}',
        '{"status": "0"}',
        "broken",
        '{"status": "1", "geocodes": [{"location": "x,y"}]}',
    ]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, c string")
    out = [tuple(r[0]) for r in df.orderBy("i").select(parsing.lon_lat(F.col("c"))).collect()]
    assert out == [(116.4, 39.9)] + [(None, None)] * 4
