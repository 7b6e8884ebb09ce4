"""Exact nearest neighbours by blocked matrix products.

Queries and corpus are each cut into blocks by id hash, and every pair of blocks is one cell: a task that holds two
bounded matrices, multiplies them piece by piece, and passes on k rows per query. Neither side is broadcast or gathered,
and a cell never grows with the tables: more rows give more cells.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpuskit.functions import vectors as vec
from corpuskit.operators import rows
from corpuskit.session import cut_lineage

BLOCK_BYTES = 64 << 20  # of float64 vectors on one side of a cell
SMALL_BLOCK = 2048  # rows below which cutting further only adds copies
GROUP_BLOCK = 4096  # rows of a group in one block
QUERY_STEP, CORPUS_STEP = 256, 16384  # rows multiplied at a time inside a cell
OWN_STEP = 8192  # rows of a block met at a time by `QUERY_STEP` rows, when a table is met with itself
SCORE_STEP = 8192  # pairs scored one by one at a time
FEW_NUMBERS = 1 << 20  # of all vectors of a table that goes to each task as one array: 8 MB
DIGITS = 9  # scores equal to this many digits tie, whichever block computed them


#: Scores of two vectors side by side, rounded as those of a cell.
ROW_SCORES = {
    "dot": lambda a, b: F.round(vec.dot(a, b), DIGITS),
    "cosine": lambda a, b: F.round(vec.cosine(a, b), DIGITS),
    "euclidean": lambda a, b: F.round(-F.sqrt(vec.squared_distance(a, b)), DIGITS),
}


def grid(n_queries: int, n_corpus: int, dim: int, tasks: int) -> tuple[int, int]:
    """Blocks per side: small enough for memory, and enough cells for the tasks of the cluster."""
    largest = max(1, BLOCK_BYTES // (8 * max(1, dim)))
    qs, cs = max(1, -(-n_queries // largest)), max(1, -(-n_corpus // largest))
    while qs * cs < tasks and max(n_queries / qs, n_corpus / cs) > SMALL_BLOCK:
        if n_queries / qs >= n_corpus / cs:
            qs += 1
        else:
            cs += 1
    return qs, cs


def _matrix(table: pa.Table, column: str, metric: str) -> np.ndarray:
    vectors = table.column(column).combine_chunks()
    lengths = vectors.value_lengths()
    if pc.min(lengths).as_py() != pc.max(lengths).as_py():
        raise ValueError("vectors of different lengths")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    matrix = flat.reshape(len(vectors), -1)
    if metric == "cosine":
        matrix = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
    return matrix


def _scores(q: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    product = q @ c.T
    if metric == "euclidean":
        squares = (q * q).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2.0 * product
        product = -np.sqrt(np.maximum(squares, 0.0))
    return np.round(product, DIGITS)


def _candidates(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of every score that is not below its row's k-th best: ties at the edge included."""
    if scores.shape[1] > k:
        edge = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        return np.nonzero((scores >= edge) & (scores > -np.inf))
    return np.nonzero(scores > -np.inf)


def _cell_top(k: int, metric: str, skip_same: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        q_ids, c_ids = _ids(left, "query"), _ids(right, "id")
        # Ids compare by rank, so that texts and numbers are told apart and ordered alike.
        order = np.argsort(c_ids, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        out_q, out_c, out_score = [], [], []
        if left.num_rows and right.num_rows:
            q, c = _matrix(left, "qv", metric), _matrix(right, "cv", metric)
            for at in range(0, len(q), QUERY_STEP):
                block = q[at : at + QUERY_STEP]
                kept = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
                for start in range(0, len(c), CORPUS_STEP):
                    scores = _scores(block, c[start : start + CORPUS_STEP], metric)
                    if skip_same:
                        scores[q_ids[at : at + QUERY_STEP, None] == c_ids[None, start : start + CORPUS_STEP]] = -np.inf
                    row, place = _candidates(scores, k)
                    both = [np.concatenate(x) for x in zip(kept, (row, place + start, scores[row, place]), strict=True)]
                    sort = np.lexsort((rank[both[1]], -both[2], both[0]))
                    row = both[0][sort]
                    nth = np.arange(len(row)) - np.searchsorted(row, row)
                    kept = tuple(x[sort][nth < k] for x in both)
                out_q.append(q_ids[at + kept[0]])
                out_c.append(c_ids[kept[1]])
                out_score.append(kept[2])
        if not out_q:
            return pa.table({"query": left.column("query")[:0], "id": right.column("id")[:0], "score": pa.array([], pa.float64())})
        joined = [np.concatenate(x) for x in (out_q, out_c, out_score)]
        kinds = (left.schema.field("query").type, right.schema.field("id").type, pa.float64())
        return pa.table({n: pa.array(x.tolist(), t) for n, x, t in zip(("query", "id", "score"), joined, kinds, strict=True)})

    return run


def _cell_all(metric: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        q_ids, c_ids = _ids(left, "query"), _ids(right, "id")
        if left.num_rows and right.num_rows:
            scores = _scores(_matrix(left, "qv", metric), _matrix(right, "cv", metric), metric).ravel()
        else:
            scores = np.empty(0)
        return pa.table(
            {
                "query": pa.array(np.repeat(q_ids, len(c_ids) if len(scores) else 0).tolist(), left.schema.field("query").type),
                "id": pa.array(np.tile(c_ids, len(q_ids) if len(scores) else 0).tolist(), right.schema.field("id").type),
                "score": pa.array(scores, pa.float64()),
            }
        )

    return run


def _id_type(df: DataFrame, column: str) -> str:
    return "string" if isinstance(df.schema[column].dataType, StringType) else "bigint"


def _ids(table: pa.Table, column: str) -> np.ndarray:
    """Numbers, or texts as fixed-width characters, which sort as Spark sorts them."""
    found = table.column(column).to_numpy()
    return found.astype(str) if found.dtype == object else found


def _cells(queries: DataFrame, corpus: DataFrame, fn: Callable, cells: tuple[int, int] | None) -> DataFrame:
    """`queries` has (query, vector), `corpus` (id, vector); ids are whole numbers or texts.

    Rows whose vector is null or holds a null take no part. Vectors of different lengths end the job.
    """
    queries, corpus = (d.where(F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull())) for d in (queries, corpus))
    kinds = [_id_type(queries, "query"), _id_type(corpus, "id")]
    if cells is None:
        sizes = queries.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
        n_corpus = corpus.count()
        cells = grid(sizes[0], n_corpus, sizes[1] or 1, rows.slice_count(queries))
    qs, cs = cells
    left = queries.select(
        F.col("query").cast(kinds[0]),
        F.col("vector").cast("array<double>").alias("qv"),
        F.pmod(F.xxhash64("query"), F.lit(qs)).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.lit(cs - 1))).alias("cb"),
    )
    right = corpus.select(
        F.col("id").cast(kinds[1]),
        F.col("vector").cast("array<double>").alias("cv"),
        F.explode(F.sequence(F.lit(0), F.lit(qs - 1))).alias("qb"),
        F.pmod(F.xxhash64("id"), F.lit(cs)).cast("int").alias("cb"),
    )
    return left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(fn, f"query {kinds[0]}, id {kinds[1]}, score double")


def top_k(
    queries: DataFrame, corpus: DataFrame, k: int, metric: str = "dot", skip_same: bool = False, cells: tuple[int, int] | None = None
) -> DataFrame:
    """(query, id, score, rank): the k best corpus rows per query, higher score first, then smaller id.

    Metrics: dot, cosine, euclidean (score is the negative distance). `skip_same` leaves out a row's own id.
    """
    found = _cells(queries, corpus, _cell_top(k, metric, skip_same), cells)
    return rows.top_per_key(found, ["query"], "score", "id", k)


def similarity(queries: DataFrame, corpus: DataFrame, metric: str = "dot", cells: tuple[int, int] | None = None) -> DataFrame:
    """(query, id, score) for every pair, in long form: for two sides whose product is the wanted result.

    A small corpus is one array beside each query, and no query is shuffled.
    """
    held = few(corpus) if cells is None and metric in ROW_SCORES else None
    if held is not None:
        each = _beside(queries, held).select("query", "vector", F.explode("__rows").alias("r"))
        return each.select("query", F.col("r.id").alias("id"), ROW_SCORES[metric](F.col("vector"), F.col("r.vector")).alias("score"))
    return _cells(queries, corpus, _cell_all(metric), cells)


class _Best:
    """The k best partners of each row of a block so far: by score, then by the rank of the id."""

    def __init__(self, n: int, k: int):
        self.score, self.rank, self.place = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max), np.zeros((n, k), np.int64)
        self.least = np.full(n, -np.inf, np.float32)  # a product in float32 below this is none of them

    def take(self, row: np.ndarray, place: np.ndarray, score: np.ndarray, rank: np.ndarray, margin: float) -> None:
        if not len(row):
            return
        k = self.score.shape[1]
        sort = np.lexsort((rank, -score, row))
        row, place, score, rank = row[sort], place[sort], score[sort], rank[sort]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        row, place, score, rank, nth = (x[nth < k] for x in (row, place, score, rank, nth))
        some, at = np.unique(row, return_inverse=True)
        fresh = [np.full((len(some), k), fill, kind) for fill, kind in ((-np.inf, float), (np.iinfo(np.int64).max, np.int64), (0, np.int64))]
        for into, values in zip(fresh, (score, rank, place), strict=True):
            into[at, nth] = values
        both = [np.concatenate([old[some], new], axis=1) for old, new in zip((self.score, self.rank, self.place), fresh, strict=True)]
        best = np.lexsort((both[1], -both[0]), axis=-1)[:, :k]
        self.score[some], self.rank[some], self.place[some] = (np.take_along_axis(x, best, axis=1) for x in both)
        self.least[some] = np.maximum(self.least[some], (self.score[some, -1] - margin).astype(np.float32))


def _pair_scores(matrix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a))
    for at in range(0, len(a), SCORE_STEP):
        part = slice(at, at + SCORE_STEP)
        out[part] = np.einsum("ij,ij->i", matrix[a[part]], matrix[b[part]])
    return np.round(out, DIGITS)


def _own_top(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(query, id, score): the k best partners of each row of two blocks in the other one, or in its own if there is one block.

    Every pair is met once, for both of its rows. Products are made in float32, and each pair that could be among the k best by them, as far as they
    can be wrong, is scored in float64; only those scores count. `margin` is twice the largest error of a product of unit vectors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in _by_cell(batches):
            names = _ids(table, "id")
            matrix = _matrix(table, "v", "cosine")
            side = table.column("side").to_numpy()
            kind = table.schema.field("id").type
            del table
            order = np.argsort(names, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            same = np.unique(names, return_inverse=True)[1]
            alone, one, two = not side.max(), np.flatnonzero(side < 2), np.flatnonzero(side == 2)
            if alone:
                two = one
            margin = 2 * (matrix.shape[1] + 4) * 2.0**-24 + 2 * 10.0**-DIGITS
            rough = bool(np.isfinite(matrix).all())
            width = -len(two) % 8  # zero rows, so that eight answers are read as one number
            left = matrix[one].astype(np.float32) if rough else None
            right = np.concatenate([matrix[two].astype(np.float32), np.zeros((width, matrix.shape[1]), np.float32)]) if rough else None
            mine, theirs = _Best(len(one), k), _Best(len(two), k)
            for at in range(0, len(one), QUERY_STEP):
                rows_ = one[at : at + QUERY_STEP]
                for start in range(0, len(two), OWN_STEP):
                    cols = two[start : start + OWN_STEP]
                    if rough:
                        product = left[at : at + QUERY_STEP] @ right[start : start + OWN_STEP].T
                        product[:, len(cols) :] = -np.inf
                    else:
                        product = np.round(matrix[rows_] @ matrix[cols].T, DIGITS)
                        product = np.pad(product, ((0, 0), (0, -len(cols) % 8)), constant_values=-np.inf)
                    if alone:
                        product[:, : len(cols)][same[rows_, None] == same[None, cols]] = -np.inf
                    low = mine.least[at : at + QUERY_STEP]
                    if start == 0 and rough and len(cols) > 2 * k:
                        first = product[:, : min(len(cols), 1024)]
                        if first.shape[1] > k:
                            np.maximum(low, np.partition(first, -k, axis=1)[:, -k] - np.float32(margin), out=low)
                    chosen = product >= low[:, None]
                    if not alone:
                        high = theirs.least[start : start + OWN_STEP]
                        if at == 0 and rough and len(rows_) > k:
                            np.maximum(high, np.partition(product[:, : len(cols)], -k, axis=0)[-k] - np.float32(margin), out=high)
                        chosen[:, : len(cols)] |= product[:, : len(cols)] >= high
                    eights = np.flatnonzero(chosen.reshape(-1).view(np.uint64))
                    flat = (eights[:, None] * 8 + np.arange(8)).ravel()
                    flat = flat[chosen.reshape(-1)[flat]]
                    r, c = np.divmod(flat, chosen.shape[1])
                    value = product[r, c]
                    known = value > -np.inf
                    r, c, value = r[known], c[known], value[known]
                    if not rough:
                        score = value
                    elif len(r) * 16 > chosen.size:
                        score = np.round(matrix[rows_] @ matrix[cols].T, DIGITS)[r, c]
                    else:
                        score = _pair_scores(matrix, rows_[r], cols[c])
                    near = value >= low[r]
                    mine.take(at + r[near], cols[c[near]], score[near], rank[cols[c[near]]], margin)
                    if not alone:
                        near = value >= high[c]
                        theirs.take(start + c[near], rows_[r[near]], score[near], rank[rows_[r[near]]], margin)
            for block, best in ((one, mine), (two, theirs))[: 1 if alone else 2]:
                row, nth = np.nonzero(best.score > -np.inf)
                found = [names[block[row]], names[best.place[row, nth]], best.score[row, nth]]
                kinds = (kind, kind, pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), t) for x, t in zip(found, kinds, strict=True)], ["query", "id", "score"])

    return run


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of each cell that came to a task, mostly of one."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held)
    del held
    cells = pc.unique(table.column("cell")).to_pylist()
    for cell in cells:
        yield cell, table if len(cells) == 1 else table.filter(pc.equal(table.column("cell"), cell))


def _own_cells(vectors: DataFrame, k: int, blocks: int | None) -> DataFrame:
    """(query, id, score): candidates of the k nearest other rows by cosine. A table is cut into blocks, and each two of them, or one alone, are a task."""
    kind = _id_type(vectors, "id")
    known = vectors.where(F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull()))
    if blocks is None:
        n, dim = known.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
        tasks, blocks = rows.slice_count(known), max(1, -(-n // max(1, BLOCK_BYTES // (8 * max(1, dim or 1)))))
        while blocks * (blocks + 1) // 2 < tasks and n / blocks > SMALL_BLOCK:
            blocks += 1
    own, each = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    placed = known.select(F.col("id").cast(kind).alias("id"), F.col("vector").cast("array<double>").alias("v"), own.alias("b"), each.alias("j"))
    low, high = F.least("b", "j"), F.greatest("b", "j")
    cell = (low * blocks - F.floor(low * (low - 1) / 2).cast("int") + high - low).alias("cell")
    side = F.when(F.col("b") == F.col("j"), 0).when(F.col("b") < F.col("j"), 1).otherwise(2).alias("side")
    dealt = placed.select(cell, side, "id", "v").repartitionById(blocks * (blocks + 1) // 2, F.col("cell"))
    return dealt.mapInArrow(_own_top(k), f"query {kind}, id {kind}, score double")


def knn_graph(vectors: DataFrame, k: int, metric: str = "cosine", blocks: int | None = None) -> DataFrame:
    """Edges (src, dst, score, rank) to the k nearest other rows. Own ids are left out by id, so copies of a row stay."""
    if metric == "cosine":
        found = rows.top_per_key(_own_cells(vectors, k, blocks), ["query"], "score", "id", k)
    else:
        found = top_k(vectors.withColumnRenamed("id", "query"), vectors, k, metric, skip_same=True)
    return found.withColumnsRenamed({"query": "src", "id": "dst"})


def knn_graph_by(vectors: DataFrame, by: str, k: int, metric: str = "cosine") -> DataFrame:
    """(by, src, dst, score, rank): the k nearest other rows of the same group.

    A group is one cell while it is small; a larger one is cut into blocks and every pair of its blocks is a cell, so that a hot
    group is many tasks. Rows without a group or a vector take no part.
    """
    kind = _id_type(vectors, "id")
    known = vectors.where(F.col(by).isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull()))
    sized = known.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / GROUP_BLOCK).cast("int").alias("__n"))
    slim = known.select(by, F.col("id").cast(kind).alias("id"), F.col("vector").cast("array<double>").alias("v")).join(sized, by)
    own, other = F.pmod(F.xxhash64("id"), F.col("__n")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("__n") - 1))
    left = slim.select(F.col(by).alias("__g"), F.col("id").alias("query"), F.col("v").alias("qv"), own.alias("qb"), other.alias("cb"))
    right = slim.select(F.col(by).alias("__g"), F.col("id").alias("id"), F.col("v").alias("cv"), other.alias("qb"), own.alias("cb"))
    cells = left.groupBy("__g", "qb", "cb").cogroup(right.groupBy("__g", "qb", "cb"))
    top = _cell_top(k, metric, skip_same=True)

    def run(key: tuple, one: pa.Table, two: pa.Table) -> pa.Table:
        found = top(one, two)
        return found.add_column(0, "group", pa.array([key[0].as_py()] * found.num_rows, key[0].type))

    group_kind = vectors.schema[by].dataType.simpleString()
    found = cells.applyInArrow(run, f"group {group_kind}, query {kind}, id {kind}, score double")
    ranked = rows.top_per_key(found, ["group", "query"], "score", "id", k)
    return ranked.withColumnsRenamed({"group": by, "query": "src", "id": "dst"})


def knn_classes(queries: DataFrame, corpus: DataFrame, k: int, metric: str = "cosine") -> DataFrame:
    """(query, predicted): most frequent label of the k nearest rows, the smallest label on ties. `corpus` has a label."""
    found = top_k(queries, corpus.select("id", "vector"), k, metric)
    labelled = found.join(corpus.select("id", "label"), "id")
    return labelled.groupBy("query").agg(F.mode("label", True).alias("predicted"))


def few(corpus: DataFrame) -> Column | None:
    """The rows (id, vector) of a small table as one sorted array, a value for every task; None above `FEW_NUMBERS` numbers.

    Rows whose vector is null or holds a null are left out.
    """
    known = corpus.where(F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull()))
    if (known.agg(F.sum(F.size("vector"))).first()[0] or 0) > FEW_NUMBERS:
        return None
    row = F.struct("id", F.col("vector").cast("array<double>").alias("vector"))
    return known.agg(F.sort_array(F.collect_list(row)).alias("rows")).scalar()


def _beside(vectors: DataFrame, rows_: Column) -> DataFrame:
    """Whole vectors with an array of rows beside each."""
    return vectors.where(F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull())).withColumn("__rows", rows_)


def nearest_of(vector: Column, rows_: Column) -> Column:
    """(distance, id) of the nearest of an array of rows; of equal distances, to nine digits, the smallest id."""
    away = F.transform(rows_, lambda r: F.struct((-ROW_SCORES["euclidean"](r["vector"], vector)).alias("distance"), r["id"].alias("id")))
    return F.array_min(away)


def assigned(vectors: DataFrame, centroids: DataFrame) -> DataFrame:
    """(id, cluster): nearest centroid by distance. `centroids` has (id, vector).

    Few centroids are one array and vectors stay where they are; more of them are met in cells, as any corpus is.
    """
    held = few(centroids)
    if held is None:
        nearest = top_k(vectors.withColumnRenamed("id", "query"), centroids, 1, "euclidean")
        return nearest.select(F.col("query").alias("id"), F.col("id").alias("cluster"))
    known = _beside(vectors, held)
    return known.select("id", nearest_of(F.col("vector"), F.col("__rows"))["id"].alias("cluster")).where(F.col("cluster").isNotNull())


def lloyd_step(vectors: DataFrame, centroids: DataFrame) -> DataFrame:
    """New centroids (id, vector) after one assignment; a centroid without members stays where it was.

    With few centroids a vector is assigned in place and only sums and counts per cluster leave a task.
    """
    from corpuskit.operators.votes import as_vectors, mean_vectors

    held = few(centroids)
    if held is None:
        members = vectors.join(assigned(vectors, centroids), "id")
        moved = as_vectors(mean_vectors(members, "cluster", "vector"), "cluster", name="__v")
    else:
        size = centroids.select(F.max(F.size("vector"))).first()[0] or 0
        own = nearest_of(F.col("vector"), F.col("__rows"))["id"]
        placed = _beside(vectors, held).select(own.alias("cluster"), F.col("vector").cast("array<double>").alias("vector"))
        sums = [F.avg(F.col("vector")[i]).alias(f"x{i}") for i in range(size)]
        moved = placed.groupBy("cluster").agg(*sums).select("cluster", F.array(*[f"x{i}" for i in range(size)]).alias("__v"))
    kept = centroids.join(moved.withColumnRenamed("cluster", "id"), "id", "left")
    return kept.select("id", F.coalesce("__v", F.col("vector").cast("array<double>")).alias("vector"))


def far_points(vectors: DataFrame, k: int) -> DataFrame:
    """(id, vector): starts for k-means, numbered from 0: the vector of the smallest id, then each time the one farthest from all before it.

    Only the chosen vectors reach the driver. Fewer distinct vectors than k give fewer starts.
    """
    spark = vectors.sparkSession
    known = vectors.select("id", F.col("vector").cast("array<double>").alias("vector"))
    known = known.where(F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull()))
    first = known.agg(F.min_by("vector", "id").alias("vector")).first()["vector"]
    chosen = [] if first is None else [first]
    while chosen and len(chosen) < k:
        held = spark.createDataFrame(list(enumerate(chosen)), "id int, vector array<double>")
        far = _beside(known, few(held)).select("id", "vector", nearest_of(F.col("vector"), F.col("__rows"))["distance"].alias("d"))
        best = far.agg(F.min_by(F.struct("vector", "d"), F.struct(-F.col("d"), F.col("id"))).alias("row")).first()["row"]
        if not best["d"]:
            break
        chosen.append(best["vector"])
    return spark.createDataFrame(list(enumerate(chosen)), "id int, vector array<double>")


def kmeans(vectors: DataFrame, k: int, steps: int) -> tuple[DataFrame, DataFrame]:
    """(centroids (id, vector), members (id, cluster)) after at most `steps` of Lloyd's steps from far points."""
    centroids = far_points(vectors, k)
    for _ in range(steps):
        moved = cut_lineage(lloyd_step(vectors, centroids), "centroids")
        still = moved.join(centroids.select("id", F.col("vector").alias("was")), "id").where(F.col("vector") != F.col("was")).isEmpty()
        centroids = moved
        if still:
            break
    return centroids, assigned(vectors, centroids)
