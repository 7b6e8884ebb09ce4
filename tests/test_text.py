from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpuskit.functions import arrays, prompts
from corpuskit.functions import text as tx
from corpuskit.operators import cleaning, tokens


def _map(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("c"))).collect()]


BLANKS = ["", "  a b ", "　x　", "\xa0\t\ny\x85\x1c", "\x0bz", "none", "𝒳 ", "   \n", " q "]


def test_strip_equals_python(spark):
    assert _map(spark, BLANKS, tx.strip) == [v.strip() for v in BLANKS]


def test_digits(spark):
    values = ["a1", "abc", "１２", "x²", "", "Ⅳ", "٣", "①", "❶", "½", "𝟘", "፩"]
    assert _map(spark, values, tx.has_digit) == [any(ch.isdigit() for ch in v) for v in values]


def test_page_numbers(spark):
    values = ["a\n- 12 -  \nb", "a\n— 3 — \nb", "a\n45 \nb", "a\nIII\nb", "a 45\nb", "\n1\n\n2\n", "a\n- x -\nb"]
    assert _map(spark, values, tx.remove_page_numbers) == ["ab", "ab", "ab", "ab", "a 45\nb", "", "a\n- x -\nb"]


def test_junk_goes_before_the_heading_is_looked_for(spark):
    assert _map(spark, ["目\n录\n正 文", "目 \n录\t\n正​文\n", "a﻿b"], tx.remove_junk) == ["正文", "正文", "ab"]


def test_sentences(spark):
    assert _map(spark, ["一;二；三。四", "", "。"], tx.sentences) == [["一", "二", "三", "四"], [""], ["", ""]]


def test_sentence_filters(spark):
    assert _map(spark, ["第一章 总则", "  第二节", "第一名的成绩", "关于第一章", "", "第"], tx.not_heading) == [False, False, True, True, True, True]
    long = "国民经济和社会发展" + "很" * 40 + "五年规划"
    assert _map(spark, ["国民经济和社会发展第五年规划", long, "五年规划"], tx.not_title) == [False, True, True]
    assert _map(spark, ["1234567", "12345678", "x" * 1000, "x" * 1001], tx.length_within) == [False, True, True, False]


def test_small_helpers(spark):
    assert _map(spark, ["111", "0111", "1", "12345"], tx.zero_pad) == ["0111", "0111", "0001", "12345"]
    assert _map(spark, ["省（含市）城", "a（b\nc）d", "（）"], tx.remove_parenthesised) == ["省城", "a（b\nc）d", ""]
    assert _map(spark, ["被引用次数：12", "Cited by 345", "none", "7 "], tx.last_number) == [0, 345, 0, 7]
    assert _map(spark, ["/a/b/x.tar.gz", "plain", "dir/"], tx.file_stem) == ["x", "plain", ""]
    assert _map(spark, ["汉字", "abc", "a龥", "㐀"], tx.has_character_in) == [True, False, True, False]
    assert _map(spark, [" A-B: c：", "ab c"], tx.match_key) == ["ab c", "ab c"]
    assert [tuple(r) for r in _map(spark, ["𝒳bab", "zzz"], lambda c: tx.find_text(c, F.lit("ab")))] == [(2, 4), (-1, -1)]
    assert _map(spark, ["𝒳bcd"], lambda c: tx.slice_text(c, F.lit(1), F.lit(3))) == ["bc"]
    for start in (-9, -3, -1, 0, 2, 9):
        for end in (-9, -2, 0, 2, 5, 9):
            assert _map(spark, ["abcdef", ""], lambda c, a=start, b=end: tx.slice_text(c, F.lit(a), F.lit(b))) == ["abcdef"[start:end], ""]


def test_known_parties(spark):
    values = [(1, "Alpha Co; Beta Co"), (2, "Alpha Co"), (3, "Gamma; Delta"), (4, None), (5, "abc; Alpha Co"), (6, "Alpha Co; Alpha Co")]
    df = spark.createDataFrame(values, "id int, parties string")
    targets = spark.createDataFrame([("Alpha Co",)], "name string")
    out = cleaning.with_known_parties(df, "id", "parties", targets, "name")
    assert sorted(r["id"] for r in out.collect()) == [1, 6]


def test_templates(spark):
    row = spark.createDataFrame([("x{y}", None)], "a string, b string")
    assert row.select(prompts.render("{{k}} {a}|{b}|{n}", {"a": F.col("a"), "b": F.col("b"), "n": 3})).first()[0] == "{k} x{y}||3"
    bound = prompts.bind("{{}} {a} {b}", b="has {braces}")
    assert row.select(prompts.render(bound, {"a": F.col("a")})).first()[0] == "{} x{y} has {braces}"
    with pytest.raises(KeyError):
        prompts.render("{missing}", {})


def test_labels_and_padding(spark):
    df = spark.createDataFrame([(0, [5, 6, 7]), (1, []), (2, [9])], "k bigint, ids array<int>")
    shifted = {r["k"]: r["s"] for r in df.select("k", arrays.next_token_labels(F.col("ids")).alias("s")).collect()}
    assert shifted == {0: [6, 7, -100], 1: [], 2: [-100]}
    padded = {r["k"]: r for r in tokens.padded_batches(df, "k", "ids", batch_size=2, multiple_of=4).collect()}
    assert padded[0]["input_ids"] == [5, 6, 7, 0] and padded[1]["labels"] == [-100] * 4 and padded[2]["attention_mask"] == [1, 0, 0, 0]
    with pytest.raises(Exception, match="k occurs twice: 2"):
        tokens.padded_batches(df.unionByName(df.where("k = 2")), "k", "ids", batch_size=2).collect()
    cut = {r["k"]: r["ids"] for r in tokens.padded_to(df, "ids", 2).collect()}
    assert cut == {0: [5, 6], 1: [0, 0], 2: [9, 0]}


def test_vocabulary_grows_without_moving_ids(spark):
    old = tokens.vocabulary(spark.createDataFrame([("a",), ("b",)], "token string"))
    fresh = spark.createDataFrame([("b",), ("c",), ("d",)], "token string")
    before = {r["token"]: r["id"] for r in old.collect()}
    after = {r["token"]: r["id"] for r in tokens.extended_vocabulary(old, fresh).collect()}
    assert before.items() <= after.items() and sorted(after.values()) == [0, 1, 2, 3]
