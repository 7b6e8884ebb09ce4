"""A Merkle manifest of a table, kept as a persistent tree: a tampered leaf makes a version that copies only its ancestors.

Rows are leaves. Within a group (a source) leaves ascend by key, every three neighbours hash to a parent, and what remains is the
group's root; the groups' roots, in the order of the groups, make the tree above them. `LEVELS` levels of a tree are one aligned block:
2187 neighbouring nodes that a task holds at a time, however large their group is. Block roots are the nodes of the next, smaller tree.

The base tree is built upwards block by block. Then each block gets the siblings on its way to the root, a few hundred bytes, and
makes its versions: the leaf and its ancestors within the block are copied, everything else is shared with the base, and the version
goes on above the block with the siblings of that way. So the upper parts of versions, too, are made where their leaves lie, and no
node near the root gathers the versions below it.

Null groups come first and are one group. Rows of equal keys are ordered by their digests; null keys come first and are never
tampered with. Repeated rows are leaves of their own. An empty table gives no rows. Only the named columns are read, so others do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.llm.frames import partitions
from corpuskit.session import cut_lineage

FANOUT = 3
LEVELS = 7

STEPS = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """`-` for null, else the length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """The digest of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above `n` leaves."""
    out = 0
    while n > 1:
        n, out = -(-n // FANOUT), out + 1
    return out


class Tree:
    """The base nodes of one block. Nothing in it ever changes; a version is the list of its own nodes, lowest first."""

    def __init__(self, digests: list[str], levels: int):
        self.levels = [digests]
        for _ in range(levels):
            below = self.levels[-1]
            self.levels.append([digest("".join(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def way(self, i: int) -> list[tuple[str, str]]:
        """The siblings on the left and on the right of node i and of its ancestors."""
        out = []
        for nodes in self.levels[:-1]:
            first = i - i % FANOUT
            out.append(("".join(nodes[first:i]), "".join(nodes[i + 1 : first + FANOUT])))
            i //= FANOUT
        return out


def copied(leaf_digest: str, way: list[tuple[str, str]]) -> list[str]:
    """The nodes that a version with another leaf copies: the leaf and its ancestors. Siblings are shared."""
    out = [leaf_digest]
    for left, right in way:
        out.append(digest(left + out[-1] + right))
    return out


def numbered(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add `rank`, the place of a row in its group from 0 on, and `n`, the size of the group.

    Rows are cut into ranges of (group, order), so that a large group is sorted by many tasks; places in a range are moved by the sizes
    of the ranges before it, of which there is one number per range and group.
    """
    ranges = df.repartitionByRange(partitions(df.sparkSession), group, *order).sortWithinPartitions(group, *order)
    placed = cut_lineage(ranges.withColumn("__at", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("__task", F.shiftright("__at", 33))
    runs = placed.groupBy(group, "__task").agg(F.min("__at").alias("__first"), F.count("*").alias("__size"))
    of = Window.partitionBy(group)
    before = F.sum("__size").over(of.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1))
    moved = (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__move")
    moves = cut_lineage(runs.select(F.col(group).alias("__group"), F.col("__task").alias("__of"), moved, F.sum("__size").over(of).alias("n")), "moves")
    met = placed.join(moves, placed[group].eqNullSafe(moves["__group"]) & (F.col("__task") == F.col("__of")))
    return met.select(*df.columns, (F.col("__at") + F.col("__move")).alias("rank"), "n")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of one (grp, block) after the other; the rows of a partition are sorted by them."""
    key, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["grp"], row["block"]) != key:
                if held:
                    yield key, held
                key, held = (row["grp"], row["block"]), []
            held.append(row)
    if held:
        yield key, held


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)


_STEP = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
_ROOTS = pa.schema([("grp", pa.string()), ("rank", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())])
_WAYS = pa.schema([("grp", pa.string()), ("rank", pa.int64()), ("steps", _STEP), ("top", pa.string())])
_FOLDED = pa.schema([("key", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]])
_NODES = pa.schema([("grp", pa.string()), ("key", pa.int64()), ("level", pa.int32()), ("place", pa.int64()), ("digest", pa.string())])


def _dealt(nodes: DataFrame) -> DataFrame:
    """The rows of a block together, in order."""
    n = partitions(nodes.sparkSession)
    return nodes.repartition(n, "grp", "block").sortWithinPartitions("grp", "block", "rank")


def _in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"rank div {FANOUT**levels}"))


def _tree(rows: list[dict], levels: int) -> Tree:
    return Tree([r["digest"].hex() for r in rows], min(levels, height(rows[0]["n"])))


def block_roots(nodes: DataFrame, levels: int) -> DataFrame:
    """(grp, rank, n, digest): one node per block of the nodes (grp, rank, n, digest); n counts the blocks of a group."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = FANOUT**levels
        made = ((grp, block, -(-rows[0]["n"] // size), bytes.fromhex(_tree(rows, levels).root)) for (grp, block), rows in _runs(batches))
        yield from _batches(made, _ROOTS)

    slim = _in_blocks(nodes.select("grp", "rank", "n", "digest"), levels)
    return _dealt(slim).mapInArrow(compute, "grp string, rank bigint, n bigint, digest binary")


def block_ways(nodes: DataFrame, levels: int) -> DataFrame:
    """(grp, block, steps, top) for each block of the nodes: the siblings on the way from the block's root to the top, and the top."""
    blocks = cut_lineage(block_roots(nodes, levels), "blocks")
    alone = blocks.filter("n = 1").select("grp", F.col("rank").alias("block"), F.expr(f"cast(array() as {STEPS})").alias("steps"), F.lower(F.hex("digest")).alias("top"))
    tall = blocks.filter("n > 1")
    if not tall.head(1):
        return alone
    return alone.unionByName(ways(tall, levels).withColumnRenamed("rank", "block"))


def ways(nodes: DataFrame, levels: int) -> DataFrame:
    """(grp, rank, steps, top) for each of the nodes (grp, rank, n, digest). The call for the blocks above has a node per block."""
    above = block_ways(nodes, levels)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            for (grp, _), (first, *rows) in _runs(batches):
                tree, upper = _tree(rows, levels), first["steps"]
                for i, row in enumerate(rows):
                    yield grp, row["rank"], [{"left": a, "right": b} for a, b in tree.way(i)] + upper, first["top"]

        yield from _batches(made(), _WAYS)

    low = _in_blocks(nodes.select("grp", "rank", "n", "digest"), levels).withColumns({"steps": F.lit(None).cast(STEPS), "top": F.lit(None).cast("string")})
    high = above.select("grp", F.lit(-1).cast("bigint").alias("rank"), F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("binary").alias("digest"), "block", "steps", "top")
    out = _dealt(low.unionByName(high)).mapInArrow(compute, f"grp string, rank bigint, steps {STEPS}, top string")
    return cut_lineage(out, "ways")


def _whole_ways(nodes: DataFrame, levels: int) -> DataFrame:
    """(grp, block, steps, subroot, root): the ways of blocks through the root of their group up to the root of all."""
    inner = cut_lineage(block_ways(nodes, levels), "inner")
    tops = inner.groupBy("grp").agg(F.min("top").alias("subroot"))
    ordered = numbered(tops.withColumn("all", F.lit("")), "all", ["grp"])
    held = cut_lineage(ordered.select("grp", "rank", "n", F.unhex("subroot").alias("digest")), "subroots")
    outer = ways(held.withColumn("grp", F.lit("")), levels).select("rank", F.col("steps").alias("more"), F.col("top").alias("root"))
    of = held.join(outer, "rank").select(F.col("grp").alias("__grp"), "more", "root")
    both = inner.join(of, inner["grp"].eqNullSafe(of["__grp"]))
    return both.select("grp", "block", F.concat("steps", "more").alias("steps"), F.col("top").alias("subroot"), "root")


def _versions(leaves: DataFrame, compute, schema: str, levels: int) -> DataFrame:
    """Run `compute` over the blocks, each with its way to the root (rank -1) before its leaves."""
    placed = cut_lineage(numbered(leaves.select("grp", "key", "digest", "bent"), "grp", ["key", "digest"]), "leaves")
    low = _in_blocks(placed, levels).withColumns({"steps": F.lit(None).cast(STEPS), "subroot": F.lit(None).cast("string"), "root": F.lit(None).cast("string")})
    high = _whole_ways(placed, levels).withColumns({"rank": F.lit(-1).cast("bigint"), "n": F.lit(0).cast("bigint"), "key": F.lit(None).cast("bigint"), "digest": F.lit(None).cast("binary"), "bent": F.lit(None).cast("binary")})
    return _dealt(low.unionByName(high)).mapInArrow(compute, schema)


def _each(batches: Iterator[pa.RecordBatch], levels: int):
    for (grp, _), (first, *rows) in _runs(batches):
        tree, upper = _tree(rows, levels), [(s["left"], s["right"]) for s in first["steps"]]
        for i, row in enumerate(rows):
            yield grp, first, row, tree.way(i) + upper


def folded(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root) for each of the leaves (grp, key, digest, bent).

    `bent` is the digest of the tampered row, or null where nobody tampered; the folded root is that of the version it makes.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            for _, first, row, way in _each(batches, levels):
                proof = digest("".join(left + right for left, right in way))
                bent = row["bent"]
                # Without a tampered leaf the version is the base itself.
                top = copied(bent.hex(), way)[-1] if bent is not None else copied(row["digest"].hex(), way)[-1]
                yield row["key"], row["digest"].hex(), first["subroot"], first["root"], proof, top

        yield from _batches(made(), _FOLDED)

    return _versions(leaves, compute, "key bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string", levels)


def copies(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(grp, key, level, place, digest): the nodes that each version has of its own, from its leaf (level 0) up to the root.

    `place` counts the nodes of a level of the group from 0 on. All other nodes of a version are those of the base.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            for grp, _, row, way in _each(batches, levels):
                if row["bent"] is not None:
                    for level, node in enumerate(copied(row["bent"].hex(), way)):
                        yield grp, row["key"], level, row["rank"] // FANOUT**level, node

        yield from _batches(made(), _NODES)

    return _versions(leaves, compute, "grp string, key bigint, level int, place bigint, digest string", levels)
