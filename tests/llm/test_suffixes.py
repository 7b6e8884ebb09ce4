from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpuskit.llm import frontcode, suffixes
from corpuskit.session import cut_lineage
from tests.llm import cases


def brute(texts):
    """(n_bytes, n_removed, n_spans, digest of the rest) of each text."""
    raws = [(t or "").encode() for t in texts]
    n = suffixes.WINDOW
    counts = Counter(r[i : i + n] for r in raws for i in range(len(r) - n + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - n + 1):
            if counts[r[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def result(spark, texts, **options):
    df = cut_lineage(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4))
    rows, spans, held = suffixes.repeats(df, **options)
    cut = suffixes.cut_out(held, spans)
    joined = rows.join(cut, "row", "left").orderBy("doc_id").collect()
    out = []
    for r in joined:
        raw = (r["text"] or "").encode()
        kept = raw if r["kept"] is None else bytes(r["kept"])
        out.append((len(raw), r["n_removed"] or 0, r["n_spans"] or 0, hashlib.sha256(kept).hexdigest()))
    return out


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "stone", "été", "river", "12", "house", "ing", "ed"]) + rng.choice("abcdefg") for _ in range(n))


def planted(seed):
    rng = random.Random(seed)
    passages = [words(rng, rng.randint(60, 130)) for _ in range(6)] + [words(rng, 66)[:n] for n in (398, 399, 400, 401, 402)]
    texts = [words(rng, rng.randint(1, 400)) for _ in range(60)]
    texts += [t[: rng.randint(0, 300)] + rng.choice(passages) + t[-rng.randint(1, 300) :] for t in texts for _ in range(2)]
    texts += [texts[3]] * 5 + [texts[7] + "!"] + ["x" * 1500, "ab" * 700, "x" * 399, "y" * 400, "y" * 400]
    texts += [passages[0][i : i + 420] + words(rng, 30) for i in range(0, 200, 7)]
    edited = [list(texts[9 + i % 3].split(" ")) for i in range(30)]
    for e in edited:
        for _ in range(3):
            e[rng.randrange(len(e))] = rng.choice("pqrstuv")
    return texts + [" ".join(e) for e in edited]


@pytest.mark.parametrize(("seed", "reach", "run"), [(1, 16, 12_000), (2, 1, 50), (3, 2, 7)])
def test_planted_repeats(spark, monkeypatch, seed, reach, run):
    monkeypatch.setattr(suffixes, "RUN_KEYS", run)
    texts = planted(seed)
    assert result(spark, texts, reach=reach) == brute(texts)


def test_one_common_passage_on_many_ranges(spark):
    rng = random.Random(8)
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        for size in (397, 404):
            passage = words(rng, 90)[:size]
            texts = [words(rng, 40) + passage + words(rng, 40) for _ in range(300)]
            assert result(spark, texts, reach=1) == brute(texts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_answers_are_taken_apart_once(spark, monkeypatch):
    """Every round reads written answers, so that none takes them apart again."""
    rng = random.Random(3)
    common = words(rng, 120)
    texts = [f"{words(rng, 40)} {common} {words(rng, 40)}" for _ in range(12)]
    read, decided = [], suffixes._decided

    def noted(answers, parts):
        read.append(answers)
        return decided(answers, parts)

    monkeypatch.setattr(suffixes, "_decided", noted)
    assert result(spark, texts, reach=1) == brute(texts)
    assert read and all("MapInArrow" not in answers._jdf.queryExecution().toString() for answers in read)


def test_odd_rows(spark):
    texts = cases.texts()
    assert result(spark, texts) == brute(texts)
    assert result(spark, []) == []
    assert result(spark, [None, "", "short"]) == brute([None, "", "short"])
    rows, spans, _ = suffixes.repeats(cut_lineage(cases.frame(spark)))
    assert spans.count() > 0 and rows.filter(F.col("doc_id").isNull()).count() == 1


def test_merge_never_loses_order():
    rng = random.Random(2)
    for _ in range(500):
        width, signs = rng.choice([3, 20]), rng.choice([b"ab", b"a\xff\x00"])
        runs = [sorted({bytes(rng.choice(signs) for _ in range(width)) for _ in range(rng.randint(0, 12))}) for _ in range(rng.randint(0, 9))]
        got = list(frontcode.merge([frontcode.decode(frontcode.encode(r, frontcode.prefixes(r)), width) for r in runs]))
        assert [(k, i) for _, k, i in got] == sorted((k, i) for i, r in enumerate(runs) for k in r)
        assert all(s == frontcode.common(a, b) for (_, a, _), (s, b, _) in zip(got, got[1:], strict=False))


def test_anchors_depend_on_the_window_alone():
    import numpy as np

    rng = random.Random(4)
    raw = np.frombuffer(words(rng, 900).encode(), np.uint8)
    bounds = np.array([0, 1500, 1500, len(raw)])
    text, place, least, most, core = suffixes.anchors(raw, bounds)
    seen = sum(most - least + 1)
    assert seen == sum(max(0, n - suffixes.WINDOW + 1) for n in np.diff(bounds))
    again = suffixes.anchors(raw[:1500], np.array([0, 1500]))
    assert list(again[1]) == list(place[text == 0]) and list(again[4]) == list(core[text == 0])
