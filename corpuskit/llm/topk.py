"""Exact top-k by inner product: a three-phase uniform threshold.

Vectors stand in blocks, queries too; each pair of blocks is a cell, one bounded task of matrix products. Inside a cell the places
of a vector are `SLICES` lists of partial scores.
1. Each list gives its k best vectors per query; their whole scores are gathered, and the k-th best of all cells is a safe
   cutoff t, since k vectors reach it.
2. The cutoff goes back to the cells. A vector whose whole score reaches t has a partial score of at least t / SLICES in some list, so
   only such vectors are collected.
3. The remaining partial scores of these vectors are added, and k per query and cell leave the task.
Scores are whole numbers and exact: in doubles below 2^53, else in Python integers, held to the range of a long.

Vectors that are null or hold a null or a non-finite place take no part, as do rows with a null id. Shorter vectors
count as if zeros followed. Equal scores rank by the smaller id. A query never finds rows of its own id; if an id asks with several
vectors, the smallest of them asks. Every query meets every row by definition, so the work is their product; no cell's result
exceeds k rows per query, however many vectors are equal.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.session import cut_lineage

SLICES = 4
ROWS_PER_BLOCK, QUERIES_PER_BLOCK = 8192, 4096
STEP = 256  # queries multiplied at a time
EXACT = float(1 << 53)
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return rows.filter(F.col("id").isNotNull() & _usable(F.col("v")))


def _matrix(column: pa.ChunkedArray, width: int, scale: float) -> np.ndarray:
    arrays = column.combine_chunks()
    lengths = arrays.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(arrays), width))
    out[np.repeat(np.arange(len(arrays)), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = (
        arrays.flatten().to_numpy(zero_copy_only=False)
    )
    return np.floor(out * scale)


class _Cell:
    """Queries and rows of one cell as matrices of whole numbers."""

    def __init__(self, queries: pa.Table, rows: pa.Table, scale: float) -> None:
        width = max([1, *(int(m) for t in (queries, rows) if (m := pc.max(pc.list_value_length(t["v"])).as_py()))])
        self.q, self.r = _matrix(queries["v"], width, scale), _matrix(rows["v"], width, scale)
        self.query_ids = queries["id"].to_numpy()
        self.ids = rows["id"].to_numpy()
        top = lambda m: float(np.abs(m).max()) if m.size else 0.0
        if not width * top(self.q) * top(self.r) < EXACT:
            as_int = np.vectorize(int, otypes=[object])
            self.q, self.r = as_int(self.q), as_int(self.r)
        self.cuts = [slice(width * i // SLICES, width * (i + 1) // SLICES) for i in range(SLICES)]

    def steps(self):
        for at in range(0, len(self.q), STEP):
            q = self.q[at : at + STEP]
            partial = np.stack([q[:, c] @ self.r[:, c].T for c in self.cuts])
            yield at, partial, self.query_ids[at : at + STEP, None] == self.ids[None, :]


def _first_lists(cell: _Cell, k: int):
    """Whole scores of the k best of each list, k per query at most."""
    most = min(k + 1, len(cell.ids))
    for at, partial, own in cell.steps():
        chosen = np.zeros(own.shape, bool)
        for scores in partial:
            best = np.argpartition(-scores, most - 1, axis=1)[:, :most] if most < len(cell.ids) else np.arange(most)[None, :]
            np.put_along_axis(chosen, np.broadcast_to(best, (len(scores), most)), True, axis=1)
        chosen &= ~own
        total = partial.sum(axis=0)
        for i in range(len(total)):
            yield int(cell.query_ids[at + i]), np.sort(total[i][chosen[i]])[::-1][:k]


def _collected(cell: _Cell, cutoffs: np.ndarray, k: int):
    """(query, ids, scores) that reach the cutoff, k per query at most, best first."""
    for at, partial, own in cell.steps():
        cutoff = cutoffs[at : at + STEP]
        enough = (partial * SLICES >= cutoff[None, :, None]).any(axis=0) & ~own
        for i in np.flatnonzero(enough.any(axis=1)):
            places = np.flatnonzero(enough[i])
            score = partial[:, i, places].sum(axis=0)
            good = score >= cutoff[i]
            places, score = places[good], score[good]
            order = np.lexsort((cell.ids[places], -score))[:k]
            yield int(cell.query_ids[at + i]), cell.ids[places[order]], score[order]


def _long(x) -> int:
    return max(LEAST, min(MOST, int(x)))


def _blocks(queries: DataFrame, rows: DataFrame) -> tuple[int, int]:
    return max(1, math.ceil(queries.count() / QUERIES_PER_BLOCK)), max(1, math.ceil(rows.count() / ROWS_PER_BLOCK))


def _cells(queries: DataFrame, rows: DataFrame, columns: list[str], blocks: tuple[int, int]):
    """Both sides copied to the cells of their blocks."""
    query_blocks, row_blocks = blocks
    block = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    left = queries.withColumn("qb", block(query_blocks)).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    right = rows.withColumn("rb", block(row_blocks)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    # Fresh columns on either side: both may come from one table.
    sides = [d.select(*[F.col(c).alias(c) for c in ("qb", "rb", *names)]) for d, names in ((left, columns), (right, ["id", "v"]))]
    return sides[0].groupBy("qb", "rb").cogroup(sides[1].groupBy("qb", "rb"))


def cutoffs(queries: DataFrame, rows: DataFrame, k: int, scale: float, blocks: tuple[int, int]) -> DataFrame:
    """(id, cutoff): a score that at least k rows reach; none where there are fewer rows."""

    def first(left: pa.Table, right: pa.Table) -> pa.Table:
        found = list(_first_lists(_Cell(left, right, scale), k)) if left.num_rows and right.num_rows else []
        flat = [(q, _long(s)) for q, scores in found for s in scores]
        return pa.table({"id": pa.array([f[0] for f in flat], pa.int64()), "score": pa.array([f[1] for f in flat], pa.int64())})

    lists = _cells(queries, rows, ["id", "v"], blocks).applyInArrow(first, "id bigint, score bigint")
    ranked = lists.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score")))).filter(F.col("rank") <= k)
    return ranked.filter(F.col("rank") == k).select("id", F.col("score").alias("cutoff"))


def top_k(queries: DataFrame, rows: DataFrame, k: int = 20, scale: float = 64.0) -> DataFrame:
    """(query_id, rank, vec_id, score) for (id, v) tables of usable vectors; places become floor(scale * x)."""
    asked = queries.groupBy("id").agg(F.min("v").alias("v"))

    def resolve(left: pa.Table, right: pa.Table) -> pa.Table:
        flat = []
        if left.num_rows and right.num_rows:
            limits = np.array([-math.inf if c is None else float(c) for c in left["cutoff"].to_pylist()])
            for q, ids, scores in _collected(_Cell(left, right, scale), np.nextafter(limits, -math.inf), k):
                flat += [(q, int(i), _long(s)) for i, s in zip(ids, scores, strict=True)]
        kinds = zip(("query_id", "vec_id", "score"), range(3), strict=True)
        return pa.table({name: pa.array([f[i] for f in flat], pa.int64()) for name, i in kinds})

    blocks = _blocks(asked, rows)
    limits = cut_lineage(cutoffs(asked, rows, k, scale, blocks), "cutoffs")
    limited = asked.join(limits, "id", "left")
    found = _cells(limited, rows, ["id", "v", "cutoff"], blocks).applyInArrow(resolve, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
