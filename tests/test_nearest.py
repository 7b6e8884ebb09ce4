from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskit.functions import vectors as vec
from corpuskit.operators import nearest, votes


@pytest.fixture(scope="module")
def data(spark):
    """Vectors of which a third are copies of one."""
    rng = np.random.default_rng(7)
    matrix = np.round(rng.normal(size=(90, 5)), 3)
    matrix[::3] = matrix[0]
    df = spark.createDataFrame([(i, v.tolist(), int(i % 4)) for i, v in enumerate(matrix)], "id bigint, vector array<float>, label int")
    return matrix.astype(np.float32).astype(np.float64), df


def _brute(matrix, k, metric, skip_same):
    if metric == "cosine":
        unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
        scores = unit @ unit.T
    elif metric == "euclidean":
        scores = -np.sqrt(((matrix[:, None] - matrix[None]) ** 2).sum(axis=2))
    else:
        scores = matrix @ matrix.T
    out = {}
    for q in range(len(matrix)):
        order = sorted((i for i in range(len(matrix)) if not (skip_same and i == q)), key=lambda i: (-round(scores[q, i], 8), i))
        out[q] = order[:k]
    return out


@pytest.mark.parametrize("metric", ["dot", "cosine", "euclidean"])
@pytest.mark.parametrize("cells", [None, (1, 1), (3, 4)])
def test_top_k_equals_brute_force(data, metric, cells):
    matrix, df = data
    found = nearest.top_k(df.withColumnRenamed("id", "query"), df, 7, metric, skip_same=True, cells=cells).collect()
    lists: dict[int, list[int]] = {}
    for row in sorted(found, key=lambda r: (r["query"], r["rank"])):
        lists.setdefault(row["query"], []).append(row["id"])
    assert lists == _brute(matrix, 7, metric, True)


@pytest.mark.parametrize("blocks", [None, 1, 4])
def test_graph_meets_each_pair_once(spark, blocks):
    rng = np.random.default_rng(5)
    matrix = np.round(rng.normal(size=(150, 6)), 2)
    matrix[::5], matrix[1::20] = matrix[0], 0.0  # copies, and vectors without a length
    df = spark.createDataFrame([(i // 2 if i > 140 else i, v.tolist()) for i, v in enumerate(matrix)] + [(500, None)], "id bigint, vector array<double>")
    pairs = {tuple(r) for r in nearest.knn_graph(df, 4, blocks=blocks).collect()}
    assert pairs == {tuple(r) for r in nearest.top_k(df.withColumnRenamed("id", "query"), df, 4, "cosine", skip_same=True).collect()}


def test_float32_products_only_choose(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(8)
    matrix = np.repeat(rng.normal(size=(20, 16)), 12, axis=0) + rng.normal(size=(240, 16)) * 1e-7  # neighbours that float32 can't tell apart
    n = len(matrix)
    side = np.where(np.arange(n) % 3 == 0, 2, 1)
    monkeypatch.setattr(nearest, "QUERY_STEP", 8)
    monkeypatch.setattr(nearest, "OWN_STEP", 24)
    unit = matrix / np.linalg.norm(matrix, axis=1, keepdims=True)
    scores = np.round(unit @ unit.T, 9)
    for sides in (np.zeros(n, int), side):
        table = pa.table({"cell": pa.array([0] * n, pa.int32()), "side": pa.array(sides, pa.int32()), "id": np.arange(n), "v": matrix.tolist()})
        got: dict[int, list[int]] = {}
        for batch in nearest._own_top(3)(iter(table.to_batches())):
            for r in sorted(batch.to_pylist(), key=lambda r: (-r["score"], r["id"])):
                got.setdefault(r["query"], []).append(r["id"])
        want = {q: sorted((j for j in range(n) if j != q and (sides[j] != sides[q] or not sides[q])), key=lambda j: (-scores[q, j], j))[:3] for q in range(n)}
        assert got == want


def test_steps_inside_a_cell_do_not_matter(data, monkeypatch):
    _, df = data
    queries = df.withColumnRenamed("id", "query")
    whole = {tuple(r) for r in nearest.top_k(queries, df, 4).collect()}
    cell = nearest._cell_top(4, "dot", False)
    monkeypatch.setattr(nearest, "QUERY_STEP", 8)
    monkeypatch.setattr(nearest, "CORPUS_STEP", 11)
    import pyarrow as pa

    rows = df.collect()
    left = pa.table({"query": [r["id"] for r in rows], "qv": [[float(x) for x in r["vector"]] for r in rows]})
    right = pa.table({"id": [r["id"] for r in rows], "cv": [[float(x) for x in r["vector"]] for r in rows]})
    assert {(r["query"], r["id"]) for r in cell(left, right).to_pylist()} == {(q, i) for q, i, *_ in whole}


def test_fewer_candidates_than_k(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id bigint, vector array<float>")
    assert nearest.top_k(df.withColumnRenamed("id", "query"), df, 10, skip_same=True).count() == 2
    assert nearest.top_k(df.withColumnRenamed("id", "query"), df.limit(0), 10).count() == 0


def test_columns_and_blocks_agree(data):
    _, df = data
    pairs = df.alias("a").join(df.alias("b"), F.col("a.id") < F.col("b.id"))
    by_columns = pairs.select("a.id", "b.id", vec.cosine(F.col("a.vector"), F.col("b.vector")))
    by_blocks = nearest.similarity(df.withColumnRenamed("id", "query"), df, "cosine", cells=(2, 3)).where("query < id")
    columns = {(q, i): s for q, i, s in by_columns.collect()}
    blocks = {(r["query"], r["id"]): r["score"] for r in by_blocks.collect()}
    assert columns.keys() == blocks.keys() and len(columns) == 90 * 89 // 2
    assert all(abs(columns[pair] - blocks[pair]) < 1e-9 for pair in columns)


def test_zero_vectors_stay_zero(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0])], "id bigint, vector array<float>")
    assert df.select(vec.unit(F.col("vector"))).first()[0] == [0.0, 0.0]
    assert nearest.similarity(df.withColumnRenamed("id", "query"), df, "cosine").first()["score"] == 0.0


def test_grid_grows_with_the_tables():
    assert nearest.grid(100, 100, 64, 1000) == (1, 1)
    qs, cs = nearest.grid(10**6, 10**9, 768, 1000)
    assert 10**9 / cs * 768 * 8 <= nearest.BLOCK_BYTES and 10**6 / qs * 768 * 8 <= nearest.BLOCK_BYTES
    qs, cs = nearest.grid(10**5, 10**5, 64, 100)
    assert qs * cs >= 100


def test_knn_mode_and_ties(spark):
    corpus = spark.createDataFrame([(1, [1.0], 2), (2, [1.0], 1), (3, [1.0], 1), (4, [1.0], 2)], "id bigint, vector array<float>, label int")
    query = spark.createDataFrame([(9, [1.0])], "query bigint, vector array<float>")
    assert nearest.knn_classes(query, corpus, 4, "dot").first()["predicted"] == 1
    assert nearest.knn_classes(query, corpus, 1, "dot").first()["predicted"] == 2


def test_lloyd_step_equals_numpy(data, spark):
    matrix, df = data
    start = spark.createDataFrame([(0, matrix[0].tolist()), (1, matrix[1].tolist()), (2, [99.0] * 5)], "id bigint, vector array<double>")
    moved = {r["id"]: np.array(r["vector"]) for r in nearest.lloyd_step(df.select("id", "vector"), start).collect()}
    centers = np.array([matrix[0], matrix[1], [99.0] * 5])
    nearest_center = ((matrix[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
    for c in (0, 1):
        assert np.allclose(moved[c], matrix[nearest_center == c].mean(axis=0))
    assert np.allclose(moved[2], 99.0)


def test_weighted_means(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0], 1), ("a", [9.0, 9.0], 0), ("b", [1.0, 1.0], 0)], "g string, v array<float>, m int")
    out = {(r["g"], r["pos"]): r["x"] for r in votes.mean_vectors(df, "g", "v", weight=F.col("m")).collect()}
    assert out == {("a", 0): 1.0, ("a", 1): 2.0, ("b", 0): None, ("b", 1): None}


def test_null_and_ragged_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 5.0]), (4, None), (5, [None, 1.0])]
    df = spark.createDataFrame(rows, "id bigint, vector array<double>")
    got = nearest.top_k(df.withColumnRenamed("id", "query"), df, 5).collect()
    assert {(r["query"], r["id"], r["score"]) for r in got} == {(1, 1, 1.0), (1, 3, 0.0), (3, 3, 25.0), (3, 1, 0.0)}
    ragged = spark.createDataFrame([(1, [1.0, 0.0, 0.0]), (2, [1.0])], "id bigint, vector array<double>")
    with pytest.raises(Exception, match="different lengths"):
        nearest.top_k(ragged.withColumnRenamed("id", "query"), ragged, 1).collect()


def test_text_ids(spark):
    rows = [("b/1", [1.0, 0.0]), ("a/9", [1.0, 0.0]), ("c", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id string, vector array<double>")
    got = nearest.top_k(df.withColumnRenamed("id", "query"), df, 1, skip_same=True).collect()
    assert {(r["query"], r["id"]) for r in got} == {("b/1", "a/9"), ("a/9", "b/1"), ("c", "a/9")}
