from __future__ import annotations

import random

import pyarrow as pa
import pytest

from corpuskit.llm import jaccard, queries
from tests.llm import cases


def brute_set(text, k=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\x09\x0a\x0b\x0c\x0d":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(rows):
    """rows: (doc_id, text) -> (doc_id, n_shingles, component_id)"""
    sets = [brute_set(t) for _, t in rows]
    distinct = sorted({s for s in sets if s}, key=len)
    group = {s: i for i, s in enumerate(distinct)}
    for x, a in enumerate(distinct):
        for b in distinct[:x]:
            if 5 * len(b) >= 4 * len(a) and 100 * len(a & b) >= 80 * len(a | b) and group[a] != group[b]:
                old, new = group[a], group[b]
                group = {s: new if g == old else g for s, g in group.items()}
    least = {}
    for (i, _), s in zip(rows, sets, strict=True):
        if s and i is not None:
            least[group[s]] = min(least.get(group[s], i), i)
    return [(i, len(s), least.get(group[s]) if s else i) for (i, _), s in zip(rows, sets, strict=True)]


def near_texts(seed=5, copies=90):
    """Near copies around the threshold, lines that many texts share, texts that differ by one word, and short ones."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    line = " ".join(word() for _ in range(30))
    base = [word() for _ in range(110)]
    out = []
    for k in range(copies):
        new = list(base)
        for _ in range(rng.randint(0, 6)):
            new[rng.randrange(len(new))] = f"x{rng.randrange(30) if k % 2 else rng.random()}"
        out.append(" ".join(new) + (" " + line if k % 3 == 0 else ""))
    out += [line + " " + " ".join(word() for _ in range(rng.choice([0, 3, 8, 40]))) for _ in range(40)]
    out += [" ".join(str(i) for i in range(n)) for n in (4, 5, 6, 24, 25, 28, 29, 30, 34, 35)]
    out += ["a b c", "A\tb\nc", "a b", "a b c d e", "a b c d e f"] + [out[0], out[1].upper()]
    return out


def order(r):
    return tuple((x is not None, x or 0) for x in r)


def found(df, **how):
    return sorted((tuple(r) for r in jaccard.components(df, **how).collect()), key=order)


@pytest.mark.parametrize("few, cell", [(64, 1 << 18), (3, 900)])
def test_by_brute_force(spark, few, cell):
    texts = near_texts()
    rows = [((i * 7) % len(texts), t) for i, t in enumerate(texts)] if len(texts) % 7 else list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = sorted(brute(rows), key=order)
    assert found(df, few_members=few, cell_tokens=cell) == want
    assert 1 < len({r[2] for r in want}) < len(want)


def test_odd_rows(spark):
    df = cases.frame(spark).selectExpr("*", "1 AS n", "'x' AS digest", "2 AS token", "3 AS node", "'y' AS tokens", "4 AS h1")
    assert found(df) == sorted(brute([(r["doc_id"], r["text"]) for r in df.collect()]), key=order)
    assert found(cases.empty(spark)) == []


def test_given_documents(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in queries.documents(spark, sf_dir).collect()]
    assert sorted((tuple(r) for r in queries.op13(spark, sf_dir).collect()), key=order) == sorted(brute(rows), key=order)


def test_sets_do_not_depend_on_the_batch(monkeypatch):
    texts = pa.array([t or "" for t in cases.texts()])
    whole = [s.tolist() for s in jaccard.token_sets(texts, 5)]
    assert [len(s) for s in whole] == [len(brute_set(t)) for t in texts.to_pylist()]
    monkeypatch.setattr(jaccard, "SLICE_BYTES", 50)
    assert whole == [s.tolist() for s in jaccard.token_sets(texts, 5)]
    assert whole == [s.tolist() for i in range(len(texts)) for s in jaccard.token_sets(texts.slice(i, 1), 5)]
