from __future__ import annotations

import numpy as np
import pytest

from corpuskit.operators import learning, votes


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=4) * 0.1 + (i % 3) * 5).tolist(), i % 3) for i in range(90)]
    return spark.createDataFrame(rows, "id bigint, vector array<float>, label int")


def test_logistic_regression(blobs):
    train, test = blobs.where("id < 60"), blobs.where("id >= 60")
    out = learning.logistic_predictions(train, test).collect()
    assert len(out) == 30 and all(r["label"] == r["predicted"] for r in out)


def test_kmeans(blobs):
    found = learning.kmeans_clusters(blobs, 3).join(blobs, "id").groupBy("cluster", "label").count().collect()
    assert sorted(r["count"] for r in found) == [30, 30, 30]


def test_text_clusters(spark):
    texts = [(i, "red fox snow" if i % 2 else "green tea house") for i in range(20)]
    out = learning.text_clusters(spark.createDataFrame(texts, "id int, text string"), "text", 2)
    assert len({(r["id"] % 2, r["cluster"]) for r in out.collect()}) == 2 and "text" not in out.columns


def test_one_projection_for_points_and_centroids(blobs):
    centroids = votes.as_vectors(votes.mean_vectors(blobs, "label", "vector"), "label").withColumnRenamed("label", "id")
    out = learning.plane_projection(blobs, centroids).collect()
    points = {r["id"]: (r["x"], r["y"]) for r in out if r["kind"] == "point"}
    for r in out:
        if r["kind"] == "centroid":
            mean = np.mean([p for i, p in points.items() if i % 3 == r["id"]], axis=0)
            assert np.allclose(mean, (r["x"], r["y"]), atol=1e-4)
