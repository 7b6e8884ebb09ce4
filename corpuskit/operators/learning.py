"""Clustering, classification and projection, mostly with Spark's own estimators."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, PCA, HashingTF, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.operators import nearest
from corpuskit.session import cut_lineage


def logistic_predictions(train: DataFrame, test: DataFrame, iterations: int = 100) -> DataFrame:
    """(id, label, predicted) for `test`. Both have (id, vector, label)."""
    features = array_to_vector(F.col("vector").cast("array<double>")).alias("features")
    model = LogisticRegression(maxIter=iterations).fit(train.select(features, F.col("label").cast("double").alias("label")))
    scored = model.transform(test.select("id", F.col("label").alias("gold"), features))
    return scored.select("id", F.col("gold").alias("label"), F.col("prediction").cast("int").alias("predicted"))


def kmeans_clusters(vectors: DataFrame, k: int, steps: int = 20) -> DataFrame:
    """(id, cluster) after Lloyd's steps from far points (`nearest.kmeans`)."""
    return nearest.kmeans(vectors, k, steps)[1]


def text_clusters(texts: DataFrame, text: str, k: int, features: int = 1 << 14, seed: int = 42) -> DataFrame:
    """Cluster texts by TF-IDF of hashed words; keeps the other columns.

    The hashed counts are written once, since the fits and the final assignment all read them.
    """
    counted = Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="__words", pattern=r"[^\p{L}\p{N}]+"),
            HashingTF(inputCol="__words", outputCol="__tf", numFeatures=features),
        ]
    ).fit(texts)
    stored = cut_lineage(counted.transform(texts).drop("__words", text), "tf")
    fitted = Pipeline(
        stages=[
            IDF(inputCol="__tf", outputCol="features"),
            KMeans(k=k, seed=seed, predictionCol="cluster"),
        ]
    ).fit(stored)
    return fitted.transform(stored).drop("__tf", "features")


def plane_projection(points: DataFrame, centroids: DataFrame) -> DataFrame:
    """(kind, id, x, y): points and centroids on the two main axes of the points, from a single fit."""
    features = array_to_vector(F.col("vector").cast("array<double>")).alias("features")
    both = points.select(F.lit("point").alias("kind"), "id", features).unionByName(
        centroids.select(F.lit("centroid").alias("kind"), "id", features)
    )
    model = PCA(k=2, inputCol="features", outputCol="plane").fit(points.select(features))
    plane = vector_to_array("plane")
    return model.transform(both).select("kind", "id", plane[0].alias("x"), plane[1].alias("y"))
