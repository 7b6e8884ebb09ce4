from __future__ import annotations

import math
import random

import pytest

from corpuskit.llm import topk


def brute(rows, k):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, asked = [], {}
    for i, v in good:
        if i % 20 == 0:
            asked[i] = min(asked.get(i, v), v)
    for q, a in asked.items():
        scores = sorted((-sum(x * y for x, y in zip(a, v, strict=False)), i) for i, v in good if i != q)[:k]
        out += [(q, n, i, max(-(2**63), min(2**63 - 1, -s))) for n, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def result(spark, rows, k=20):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    good = topk.usable(df, "vec_id", "embedding")
    return sorted(tuple(r) for r in topk.top_k(good.filter("id % 20 = 0"), good, k).collect())


def vectors(seed, n, dim=8):
    rng = random.Random(seed)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(dim)]) for i in range(n)]
    same = [0.25] * dim
    return rows + [(n + i, same) for i in range(90)]


@pytest.mark.parametrize(("rows_per_block", "queries_per_block"), [(8192, 4096), (40, 3)])
def test_against_brute_force(spark, monkeypatch, rows_per_block, queries_per_block):
    monkeypatch.setattr(topk, "ROWS_PER_BLOCK", rows_per_block)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", queries_per_block)
    odd = [(1000, None), (1020, [math.nan] * 8), (1001, [math.inf] + [0.0] * 7), (1003, [None] * 8), (None, [1.0] * 8), (1040, [0.5, 0.5]),
           (1060, []), (1080, [0.0] * 8), (1100, [-9.0] * 8), (20, [0.9] * 8)]
    rows = vectors(1, 250) + odd
    assert result(spark, rows) == brute(rows, 20)


def test_few_rows_and_none(spark):
    assert result(spark, []) == []
    assert result(spark, [(20, [1.0])]) == []
    assert result(spark, [(20, [1.0]), (3, [2.0]), (4, [2.0])]) == [(20, 1, 3, 64 * 128), (20, 2, 4, 64 * 128)]


def test_large_numbers_stay_exact(spark):
    rows = [(0, [1e9, 1.0, -1e9]), (1, [1e9, 2.0, 1e9]), (2, [1e9, 1.0, 1e9]), (3, [1e300, 0.0, 0.0])]
    assert result(spark, rows) == brute(rows, 20)
