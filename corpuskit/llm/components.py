"""Connected components of an edge table by star contraction, one shuffle of the edges per step.

Each step lets every node point at the smallest node it knows: first the larger neighbours of a node, then the smaller ones.
Stars get flatter until nothing changes, in a number of steps that grows with the logarithm of the longest path. The minimum
per node is a partially aggregated count of bytes, and the join that hands it back is one Spark can split, so that a node with
very many neighbours needs no single task. Edges are written to the shared folder between steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.session import cut_lineage

MOST_STEPS = 60


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], int(row[1] or 0)


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Edges (a > b) after one half step."""
    if larger:
        both = edges.select(F.col("a").alias("n"), F.col("b").alias("m")).unionByName(edges.select(F.col("b").alias("n"), F.col("a").alias("m")))
    else:
        both = edges.select(F.col("a").alias("n"), F.col("b").alias("m"))
    least = both.groupBy("n").agg(F.min("m").alias("low")).withColumn("low", F.least("n", "low"))
    joined = both.join(least, "n")
    if larger:
        out = joined.filter("m > n").select(F.col("m").alias("a"), F.col("low").alias("b"))
    else:
        out = joined.select(F.when(F.col("m") == F.col("low"), F.col("n")).otherwise(F.col("m")).alias("a"), F.col("low").alias("b"))
    return out.filter("a != b").distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b), any two bigints; root is the smallest node of its component.

    Null ends and loops are left out. No edges give no rows.
    """
    pairs = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a != b")
    now = cut_lineage(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    for _ in range(MOST_STEPS):
        if not state[0]:
            break
        now = cut_lineage(_stars(_stars(now, True), False), "edges")
        last, state = state, _state(now)
        if last == state:
            break
    else:
        raise RuntimeError("components did not settle")
    low = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(low)
