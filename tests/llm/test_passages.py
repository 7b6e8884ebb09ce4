from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from corpuskit.llm import passages, queries, suffixes
from corpuskit.session import cut_lineage
from tests.llm import cases

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(texts):
    """Bytes of each text inside windows that another one holds."""
    found, holders = [], defaultdict(set)
    for i, t in enumerate(texts):
        spans = [m.span() for m in WORD.finditer((t or "").encode())]
        words = [(t or "").encode()[a:b] for a, b in spans]
        windows = [tuple(words[j : j + passages.WINDOW]) for j in range(len(words) - passages.WINDOW + 1)]
        found.append((spans, windows))
        for w in windows:
            holders[w].add(i)
    out = []
    for spans, windows in found:
        held = set()
        for j, w in enumerate(windows):
            if len(holders[w]) > 1:
                held |= set(range(spans[j][0], spans[j + passages.WINDOW - 1][1]))
        out.append(len(held))
    return out


def result(spark, texts):
    df = cut_lineage(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4))
    rows, _, held = suffixes.repeats(df, beside=passages.candidates(df))
    joined = rows.join(passages.shared_bytes(held), "row", "left").orderBy("doc_id").collect()
    return [r["n_passage_bytes"] or 0 for r in joined]


def words(rng, n, blanks=" "):
    stems = ["the", "of", "stone", "été", "river", "12", "house", "ing", "ed", "a", "I"]
    return "".join(rng.choice(stems) + rng.choice("abcdefg") * rng.randint(0, 1) + rng.choice(blanks) for _ in range(n))


def planted(seed):
    rng = random.Random(seed)
    shared = [words(rng, n) for n in (49, 50, 51, 60, 90, 200)]
    texts = [words(rng, rng.randint(1, 300)) for _ in range(50)]
    texts += [words(rng, rng.randint(0, 150)) + rng.choice(shared) + words(rng, rng.randint(0, 150), " \n\t") for _ in range(60)]
    texts += [rng.choice(shared).replace(" ", "\n\n") + words(rng, 20) for _ in range(10)]
    texts += [texts[3]] * 4 + [texts[7] + " more", shared[5][:400] + "x", "ab " * 400, "ab " * 49, "ab " * 50, "x" * 3000]
    alone = words(rng, 80)
    texts += [alone + words(rng, 30) + alone]  # twice in one row, nowhere else
    for i in range(25):
        edited = texts[i % 3 + 10].split(" ")
        edited[rng.randrange(len(edited))] = "edited"
        texts.append(" ".join(edited))
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_planted_passages(spark, seed):
    texts = planted(seed)
    assert result(spark, texts) == brute(texts)


def test_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE_BYTES", 700)
    monkeypatch.setattr(passages, "PIECE_BYTES", 900)
    texts = planted(4)
    assert result(spark, texts) == brute(texts)


def test_odd_rows(spark):
    texts = cases.texts()
    assert result(spark, texts) == brute(texts)
    assert result(spark, []) == []
    assert result(spark, [None, "", "short", None]) == [0] * 4


def test_one_passage_in_many_rows(spark):
    rng = random.Random(5)
    passage = words(rng, 55)
    texts = [words(rng, 30) + passage + words(rng, 30) for _ in range(400)]
    assert result(spark, texts) == brute(texts)


def test_op1_tells_passages_below_400_bytes(spark, tmp_path):
    """Passages of 51 words are mostly shorter than the strings that op1 removes."""
    rng = random.Random(6)
    passage = words(rng, 51)
    assert len(passage.encode()) < suffixes.WINDOW
    texts = [words(rng, 100) + passage + words(rng, 100), passage + words(rng, 150), words(rng, 250), None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op1(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in rows] == [0, 0, 0, 0]
    assert [r["n_passage_bytes"] for r in rows] == brute(texts) and rows[0]["n_passage_bytes"] > 0 == rows[2]["n_passage_bytes"]
