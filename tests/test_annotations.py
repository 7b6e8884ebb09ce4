from __future__ import annotations

import json
import time

from pyspark.sql import functions as F

from corpuskit.functions import arrays
from corpuskit.operators import annotations, datasets

SCHEMA = ["工程", "目标", "数值"]


def test_spans_to_records(spark):
    text = "𝒳建设大桥，增长10%"
    rows = [
        (1, text, [["1", "5", "工程"], ["8", "11", "数值"], ["0", "1", "工程"]]),
        (2, "空", []),
        (3, "坏", [["0", "1", "其他"]]),
    ]
    df = spark.createDataFrame(rows, "id int, text string, label array<array<string>>")
    typed = df.withColumn("label", annotations.typed_spans(F.col("label")))
    records, aside = annotations.extraction_records(typed, "text", "label", SCHEMA, "找 {schema}: {text}")
    out = {r["id"]: r for r in records.collect()}
    assert json.loads(out[1]["output"]) == {"工程": ["建设大桥", "𝒳"], "目标": [], "数值": ["10%"]}
    assert out[1]["instruction"] == "找 工程, 目标, 数值: " + text and out[1]["input"] == ""
    assert json.loads(out[2]["output"]) == {c: [] for c in SCHEMA}
    assert [r["id"] for r in aside.collect()] == [3]


ANNOTATED = (
    "id int, text string, entities array<struct<id: int, label: string, start_offset: int, end_offset: int>>, "
    "relations array<struct<id: int, from_id: int, to_id: int, type: string>>"
)


def test_entities_and_triples(spark):
    rows = [
        (1, "河流 A 流入 湖 B", [(7, "水", 0, 4), (9, "水", 8, 11)], [(1, 7, 9, "流入"), (2, 9, 5, "缺")]),
        (2, "x", [], []),
    ]
    df = spark.createDataFrame(rows, ANNOTATED)
    named = df.select("id", annotations.named_entities(F.col("text"), F.col("entities")).alias("e")).collect()
    assert [tuple(e) for e in named[0]["e"]] == [("河流 A", "水"), ("湖 B", "水")] and named[1]["e"] == []
    found = df.select("id", annotations.triples(F.col("text"), F.col("entities"), F.col("relations")).alias("t")).collect()
    assert [tuple(t) for t in found[0]["t"]] == [("河流 A", "水", "流入", "湖 B", "水"), ("湖 B", "水", "缺", None, None)]


def test_predictions_to_spans_keeps_every_row(spark):
    rows = [
        (1, "甲乙丙甲", {"目标": ["丙", "丁"], "工程": ["甲", "甲乙"]}),
        (2, "无", {"目标": []}),
        (3, "有", {"别的": ["有"]}),
    ]
    df = spark.createDataFrame(rows, "id int, text string, predict map<string, array<string>>")
    out = df.select("id", annotations.spans_from_predictions(F.col("text"), F.col("predict"), SCHEMA).alias("s")).orderBy("id").collect()
    assert [tuple(s) for s in out[0]["s"]] == [(0, 1, "工程"), (0, 2, "工程"), (2, 3, "目标")]
    assert out[1]["s"] == [] and out[2]["s"] == []


def test_labels_by_class(spark):
    df = spark.createDataFrame([([("a", "工程"), ("b", "别的"), ("c", "工程")],)], "e array<struct<entity: string, entity_type: string>>")
    assert df.select(annotations.labels_by_class(F.col("e"), SCHEMA)).first()[0] == {"工程": ["a", "c"], "目标": [], "数值": []}


def test_swapped_entities_share_class_and_length(spark):
    rows = [(1, "see Rome now", "Rome", 4, "city"), (2, "Oslo is cold", "Oslo", 0, "city"), (3, "in Berlin", "Berlin", 3, "city"), (4, "Mary ran", "Mary", 0, "name")]
    df = spark.createDataFrame(rows, "id int, text string, entity string, start int, label string")
    out = {r["id"]: r["text"] for r in annotations.entity_swaps(df, "id", "text", "entity", "start", "label", "s").collect()}
    assert out == {1: "see Oslo now", 2: "Rome is cold", 3: "in Berlin", 4: "Mary ran"}


def test_negatives_are_distinct_and_never_self(spark):
    df = spark.range(40).withColumnRenamed("id", "k")
    ids = datasets.negative_ids(df, "k", 6, "s").collect()
    by_row: dict[int, list[int]] = {}
    for r in ids:
        by_row.setdefault(r["k"], []).append(r["neg"])
    assert len(by_row) == 40
    assert all(len(n) == len(set(n)) == 6 and k not in n for k, n in by_row.items())
    few = datasets.negative_ids(df.where("k < 4"), "k", 6, "s").collect()
    assert {(r["k"], r["neg"]) for r in few} == {(a, b) for a in range(4) for b in range(4) if a != b} and len(few) == 12
    assert datasets.negative_ids(df.where("k = 1"), "k", 6, "s").count() == 0


def test_class_triples(spark):
    df = spark.range(100).select(F.col("id").alias("k"), F.when(F.col("id") < 70, "big").when(F.col("id") < 98, "mid").otherwise("tiny").alias("c"))
    label = {r["k"]: r["c"] for r in df.collect()}
    out = datasets.class_triples(df, "k", "c", 5, "s").collect()
    assert all(label[r["other"]] == r["class"] and r["is_pos"] == (label[r["k"]] == r["class"]) for r in out)
    groups: dict[tuple, list[int]] = {}
    for r in out:
        groups.setdefault((r["k"], r["class"]), []).append(r["other"])
    for (k, c), others in groups.items():
        expected = 1 if label[k] == c else {"big": 5, "mid": 5, "tiny": 2}[c]
        assert len(others) == len(set(others)) == expected
    assert len(groups) == 300


def test_short_negative_lists_are_repeated(spark):
    df = spark.createDataFrame([(1, ["p"], ["a", "b"]), (2, ["p", "q"], ["c"] * 9)], "k bigint, pos array<string>, neg array<string>")
    out = {r["k"]: r["g"] for r in df.select("k", datasets.training_group(F.col("k"), F.col("pos"), F.col("neg"), 6, "s").alias("g")).collect()}
    assert len(out[1]) == 6 and out[1][0] == "p" and {"a", "b"} == set(out[1][1:])
    assert min(out[1][1:].count(x) for x in "ab") >= 2
    assert out[2][0] in ("p", "q") and out[2][1:] == ["c"] * 5


def test_arithmetic_equals_python(spark):
    df = spark.range(200).withColumnRenamed("id", "k")
    for operators in (1, 2, 5):
        for r in datasets.arithmetic(df, "k", operators, "s").collect():
            terms, total, sign = r["expression"].split(" "), 0, 1
            product = int(terms[0])
            for op, value in zip(terms[1::2], terms[2::2], strict=True):
                if op == "x":
                    product *= int(value)
                else:
                    total += sign * product
                    sign, product = (1 if op == "+" else -1), int(value)
            assert r["result"] == total + sign * product


def test_tuning_rows_hide_the_prompt(spark):
    vocab = spark.createDataFrame([("a", 5), ("b", 6)], "token string, id bigint")
    df = spark.createDataFrame([(1, ["a", "b"], ["b"]), (2, [], ["zz"]), (3, [], [])], "k int, p array<string>, q array<string>")
    out = {r["k"]: (r["input_ids"], r["labels"]) for r in datasets.tuning_rows(df, ["k"], F.col("p"), F.col("q"), vocab, end_id=2).collect()}
    assert out == {1: ([5, 6, 6, 2], [-100, -100, 6, 2]), 2: ([0, 2], [0, 2]), 3: ([2], [2])}


def test_swapping_all_entities_reads_a_long_text_once(spark):
    """Time in proportion to the words: the old lookups and substrings took the square of them."""
    n = 40_000
    words = [f"{'abcdefghij'[i % 10]}{i:05d}" for i in range(n)]
    starts = [8 * i + 1 for i in range(n)]
    rows = [(1, "k", " " + "  ".join(words) + "!", list(zip(starts, words, strict=True))), (2, "k", "é none", []), (3, None, "a00000", [(0, "a00000")]), (4, "k", None, None)]
    df = spark.createDataFrame(rows, "id int, lang string, text string, found array<struct<start: int, entity: string>>")
    began = time.monotonic()
    out = {r["id"]: r for r in annotations.all_entities_swapped(df, "id", "text", "found", "lang", "s").collect()}
    assert time.monotonic() - began < 60
    new = out[1]["text"][1:-1].split("  ")
    assert out[1]["swapped"] == n and sorted(new) == sorted(words) and all(a != b for a, b in zip(new, words, strict=True))
    assert (out[1]["text"][0], out[1]["text"][-1]) == (" ", "!")
    assert [(out[i]["swapped"], out[i]["text"]) for i in (2, 3, 4)] == [(0, "é none"), (0, "a00000"), (0, None)]


def test_running_sums(spark):
    df = spark.createDataFrame([(1, [3, 0, 4]), (2, []), (3, None), (4, [5])], "id int, n array<int>").repartition(2)
    assert {r["id"]: r["s"] for r in df.select("id", arrays.running_sums(F.col("n")).alias("s")).collect()} == {1: [3, 3, 7], 2: [], 3: None, 4: [5]}
