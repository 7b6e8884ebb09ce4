from __future__ import annotations

import hashlib
import re

from corpuskit.llm import decontamination
from tests.llm import cases

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, n=10):
    own, hit, found = words(text), set(), set()
    for item, body in items:
        w = words(body)
        for g in {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else ():
            for i in range(len(own) - len(g) + 1):
                if tuple(own[i : i + len(g)]) == g:
                    hit |= set(range(i, i + len(g)))
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Été: naïve"), (10, "the of"), (3, None), (4, ""),
         (5, "..."), (1, "of stone"), (6, "a a a"), (7, "12 3.14")]


def test_rows_against_brute_force(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    df = cases.frame(spark).unionByName(
        spark.createDataFrame([(900, "x ONE, two three four-five six seven eight nine ten eleven", *[None] * 6), (901, "a a a a a", *[None] * 6)], cases.SCHEMA)
    )
    for most in (50_000, 2):
        got = decontamination.contamination(df, items, windows_per_automaton=most)
        assert got.columns == [c for c in df.columns if c != "n_words"] + ["n_words", "n_hit", "hit_items", "hit_spans"]
        for r in got.collect():
            assert (r["n_words"], r["n_hit"], r["hit_items"]) == brute(r["text"], ITEMS)


def test_offsets_are_of_the_original(spark):
    items = spark.createDataFrame([(1, "naïve été 😀")], "item_id bigint, text string")
    df = spark.createDataFrame([(1, "É. Naïve -- été, 😀! end")], "doc_id bigint, text string")
    row = decontamination.contamination(df, items).first()
    assert [row["text"][s["start"] : s["end"]] for s in row["hit_spans"]] == ["Naïve -- été, 😀"]


def test_empty_sides(spark):
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert {r["n_hit"] for r in decontamination.contamination(cases.frame(spark), items).collect()} == {0}
    some = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontamination.contamination(cases.empty(spark), some).count() == 0
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_item_without_an_id_marks_words(spark):
    items = spark.createDataFrame([(None, "stone river")], "item_id bigint, text string")
    df = spark.createDataFrame([(1, "a stone river")], "doc_id bigint, text string")
    row = decontamination.contamination(df, items).first()
    assert row["n_hit"] == 2 and row["hit_items"] == []
