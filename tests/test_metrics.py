from __future__ import annotations

import math

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuskit.functions import stems
from corpuskit.operators import metrics


def _report(spark, pairs, **kwargs):
    df = spark.createDataFrame(pairs, "gold string, pred string")
    return metrics.classification_report(df, "gold", "pred", **kwargs).first().asDict()


def test_macro_and_weighted(spark):
    pairs = [("a", "a"), ("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("b", "d")]
    per_class = {"a": (2 / 3, 2 / 3, 3), "b": (1 / 2, 1 / 2, 2), "c": (0, 0, 1), "d": (0, 0, 0)}
    f1 = {c: 2 * p * r / (p + r) if p + r else 0 for c, (p, r, _) in per_class.items()}
    macro = _report(spark, pairs)
    assert macro["accuracy"] == pytest.approx(3 / 6) and macro["support"] == 6
    assert macro["f1"] == pytest.approx(sum(f1.values()) / 4)
    weighted = _report(spark, pairs, average="weighted")
    assert weighted["f1"] == pytest.approx(sum(f1[c] * per_class[c][2] for c in f1) / 6)
    assert weighted["precision"] == pytest.approx((2 / 3 * 3 + 1 / 2 * 2) / 6)


def test_extraction(spark):
    rows = [
        ({"x": ["a", "a", "b"], "y": []}, {"x": ["a", "c"], "y": ["q"]}),
        ({"x": ["d"], "y": ["z"]}, {"x": ["d"], "y": []}),
        ({"x": ["e"], "y": []}, None),
    ]
    df = spark.createDataFrame(rows, "gold map<string, array<string>>, predicted map<string, array<string>>")
    out = {r["class"]: r for r in metrics.extraction_report(df, "gold", "predicted", ["x", "y"]).collect()}
    assert (out["x"]["right"], out["x"]["predicted"], out["x"]["gold"], out["x"]["errors"]) == (2, 3, 3, 1)
    assert out["x"]["precision"] == pytest.approx(2 / (3 + 1e-6))
    assert out["y"]["f1"] == 0.0 and out["y"]["predicted"] == 1


def test_multi_label(spark):
    df = spark.createDataFrame([([1, 0], [1, 0]), ([1, 1], [0, 1]), ([0, 0], [0, 0])], "gold array<int>, pred array<int>")
    out = {r["metric"]: r["value"] for r in metrics.multi_label_report(df, "gold", "pred", 2).collect()}
    assert out["accuracy"] == pytest.approx(2 / 3) and out["f1_class_0"] == pytest.approx(2 / 3)
    assert out["f1_class_1"] == 1.0 and out["f1"] == pytest.approx(5 / 6)


# Published examples of the algorithm, and words that pass each of its steps.
STEMS = (
    "caresses:caress ponies:poni ties:ti caress:caress cats:cat feed:feed agreed:agre plastered:plaster bled:bled motoring:motor sing:sing "
    "conflated:conflat troubled:troubl sized:size hopping:hop tanned:tan falling:fall hissing:hiss fizzed:fizz failing:fail filing:file "
    "happy:happi sky:sky relational:relat conditional:condit rational:ration valenci:valenc hesitanci:hesit digitizer:digit "
    "conformabli:conform radicalli:radic differentli:differ vileli:vile analogousli:analog vietnamization:vietnam predication:predic "
    "operator:oper feudalism:feudal decisiveness:decis hopefulness:hope callousness:callous formaliti:formal sensitiviti:sensit "
    "sensibiliti:sensibl triplicate:triplic formative:form formalize:formal electriciti:electr electrical:electr hopeful:hope goodness:good "
    "revival:reviv allowance:allow inference:infer airliner:airlin gyroscopic:gyroscop adjustable:adjust defensible:defens irritant:irrit "
    "replacement:replac adjustment:adjust dependent:depend adoption:adopt homologou:homolog communism:commun activate:activ angulariti:angular "
    "homologous:homolog effective:effect bowdlerize:bowdler probate:probat rate:rate cease:ceas controll:control roll:roll "
    "yes:ye youth:youth enjoy:enjoi toying:toi generalizations:gener oscillators:oscil"
)


def test_stems(spark):
    pairs = [p.split(":") for p in STEMS.split()]
    df = spark.createDataFrame([(a, b) for a, b in pairs] + [("is", "is"), ("a1", "a1"), ("", "")], "token string, want string")
    assert {(r["token"], r["stem"]) for r in stems.stemmed(df).collect()} == {(r["token"], r["want"]) for r in df.collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE words AS SELECT unnest($1) AS token", [[a for a, _ in pairs]])
    assert set(con.execute(f"SELECT token, stem FROM {stems.stemmed_sql('words')}").fetchall()) == {tuple(p) for p in pairs}


def test_rouge_over_stems(spark):
    rows = [(1, "the running dogs", "dog runs the"), (2, None, ""), (3, "cats", "cat")]
    df = spark.createDataFrame(rows, "k int, p string, r string")
    table = {r["k"]: (r["pred"], r["ref"]) for r in metrics.rouge_table(df, ["k"], "p", "r", stem=True).collect()}
    assert table == {1: (["the", "run", "dog"], ["dog", "run", "the"]), 2: ([], []), 3: (["cat"], ["cat"])}
    assert {r["k"]: r["score"] for r in metrics.rouge_n(df, ["k"], "p", "r", 1, stem=True).collect()} == {1: 1.0, 2: 0.0, 3: 1.0}


def test_rouge(spark):
    rows = [(1, "The cat sat on the mat", "the cat the cat"), (2, "same text", "same text"), (3, "", "x"), (4, "a", "b")]
    df = spark.createDataFrame(rows, "k int, p string, r string")
    one = {r["k"]: r["score"] for r in metrics.rouge_n(df, ["k"], "p", "r", 1).collect()}
    assert one == {1: pytest.approx(2 * 3 / 10), 2: 1.0, 3: 0.0, 4: 0.0}
    two = {r["k"]: r["score"] for r in metrics.rouge_n(df, ["k"], "p", "r", 2).collect()}
    assert two == {1: pytest.approx(2 * 1 / 8), 2: 1.0, 3: 0.0, 4: 0.0}
    report = metrics.generation_report(df, ["k"], "p", "r").first()
    assert report["acc"] == 0.25 and report["rougeL"] == pytest.approx((2 * 3 / 10 + 1) / 4, abs=1e-4)


@given(st.lists(st.sampled_from("abc"), max_size=30), st.lists(st.sampled_from("abcd"), max_size=30))
@settings(max_examples=200, deadline=None)
def test_shared_subsequence_equals_the_table_method(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert metrics.shared_subsequence(a, b) == table[-1][-1]


def test_ranking(spark):
    ranked = spark.createDataFrame(
        [(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 10, 1), (2, 13, 2)], "query int, id int, rank int"
    )
    truth = spark.createDataFrame([(1, 11), (1, 12), (1, 99), (2, 50)], "query int, id int")
    queries = spark.createDataFrame([(1, 3), (2, 1), (3, 2)], "query int, truths int")
    hits = metrics.mark_hits(ranked, truth)
    out = {(r["metric"], r["k"]): r["value"] for r in metrics.ranking_report(hits, queries, [1, 3]).collect()}
    assert out[("recall_hit", 1)] == 0.0 and out[("recall_hit", 3)] == pytest.approx(1 / 3 / 3)
    assert out[("recall_set", 3)] == pytest.approx(2 / 3 / 3) and out[("mrr", 3)] == pytest.approx(0.5 / 3)
    dcg, ideal = 1 / math.log2(3) + 1 / math.log2(4), 1 + 1 / math.log2(3)
    assert out[("ndcg", 3)] == pytest.approx(dcg / ideal / 3) and out[("ndcg", 1)] == 0.0
