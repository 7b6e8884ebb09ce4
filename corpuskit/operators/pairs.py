"""Pairs of members that share a group, each pair once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpuskit.session import cut_lineage, partitions_for

BLOCK_MEMBERS = 2000
BROADCAST_GROUPS = 100_000  # hot groups up to this number are a few megabytes


def _pairs(df: DataFrame, group: str, member: str, block_members: int) -> tuple[DataFrame, int]:
    """The pairs, not yet made, and how many rows they are made of or give at most."""
    members = df.select(group, member).where(F.col(member).isNotNull()).distinct()
    n_rows, seen = df.count(), Observation()
    with partitions_for(df.sparkSession, n_rows):
        sizes = df.groupBy(group).agg(F.count(member).alias("__n"))
        pairs = F.sum(F.when(F.col(group).isNotNull(), F.col("__n").cast("double") * (F.col("__n") - 1) / 2)).alias("pairs")
        hot = sizes.observe(seen, pairs).where(F.col("__n") > block_members)
        hot = cut_lineage(hot.select(group, F.ceil(F.col("__n") / block_members).cast("int").alias("__n")), "hot")
    most = max(n_rows, int(seen.get["pairs"] or 0))
    n_hot = hot.count()
    if n_hot == 0:
        right = members.withColumnRenamed(member, "__r")
        joined = members.withColumnRenamed(member, "__l").join(right, group).where(F.col("__l") < F.col("__r"))
        return joined.select(group, F.col("__l").alias("a"), F.col("__r").alias("b")), most
    if n_hot <= BROADCAST_GROUPS:
        hot = F.broadcast(hot)
    sized = members.join(hot, group, "left").withColumn("__n", F.coalesce("__n", F.lit(1)))
    return _pairs_by_cell(sized, [group], member), most


def unordered_pairs(df: DataFrame, group: str, member: str, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """All pairs `a < b` of the distinct members of a group, written.

    A group with more than `block_members` rows is cut into n blocks by member hash, and its pairs into the n(n+1)/2
    cells of blocks (i, j): a hot group is spread over many tasks, and no join key matches more than about a block on
    either side. The hot groups are counted first; where there are none, a plain join on the group is enough. More rows and pairs
    give more partitions, not larger ones.
    """
    pairs, most = _pairs(df, group, member, block_members)
    with partitions_for(df.sparkSession, most):
        return cut_lineage(pairs, "pairs")


def all_pairs(df: DataFrame, member: str, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """Every pair of a table's keys once; the cells of blocks stand in for a Cartesian product."""
    members = df.select(member).where(F.col(member).isNotNull()).distinct()
    blocks = members.agg(F.ceil(F.count(F.lit(1)) / block_members).cast("int").alias("n")).scalar()
    return _pairs_by_cell(members.withColumn("__n", F.greatest(blocks, F.lit(1))), [], member)


def _pairs_by_cell(sized: DataFrame, groups: list[str], member: str) -> DataFrame:
    """`sized` has the distinct members with the number of blocks `__n` of their group."""
    placed = sized.withColumn("__m", F.pmod(F.xxhash64(member), F.col("__n")).cast("int"))
    left = placed.select(
        *groups,
        F.col("__m").alias("__i"),
        F.explode(F.sequence("__m", F.col("__n") - 1)).alias("__j"),
        F.col(member).alias("__l"),
    )
    right = placed.select(
        *groups,
        F.explode(F.sequence(F.lit(0), "__m")).alias("__i"),
        F.col("__m").alias("__j"),
        F.col(member).alias("__r"),
    )
    joined = left.join(right, [*groups, "__i", "__j"])
    once = joined.where((F.col("__i") < F.col("__j")) | (F.col("__l") < F.col("__r")))
    return once.select(*groups, F.least("__l", "__r").alias("a"), F.greatest("__l", "__r").alias("b"))


def pair_counts(df: DataFrame, group: str, member: str, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """In how many groups each pair occurs; counted in part before the shuffle, and written."""
    pairs, most = _pairs(df, group, member, block_members)
    with partitions_for(df.sparkSession, most):
        return cut_lineage(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), "counts")


def distinct_pairs(df: DataFrame, group: str, member: str, block_members: int = BLOCK_MEMBERS) -> DataFrame:
    """Each pair (a, b) once, written."""
    pairs, most = _pairs(df, group, member, block_members)
    with partitions_for(df.sparkSession, most):
        return cut_lineage(pairs.select("a", "b").distinct(), "distinct")


def flag_both_in(pairs: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """`both_in` is 1 when both ends are in the target table. Written."""
    known = targets.select(key).distinct()
    a_in = known.select(F.col(key).alias("a"), F.lit(True).alias("__a"))
    b_in = known.select(F.col(key).alias("b"), F.lit(True).alias("__b"))
    both = F.col("__a").isNotNull() & F.col("__b").isNotNull()
    joined = pairs.join(a_in, "a", "left").join(b_in, "b", "left")
    with partitions_for(pairs.sparkSession, pairs.count()):
        return cut_lineage(joined.withColumn("both_in", both.cast("int")).drop("__a", "__b"), "flagged")


def with_both_ends(pairs: DataFrame, dim: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Look up the same dimension for both ends; its columns get the suffixes _a and _b. Written."""
    out = pairs
    for end in ("a", "b"):
        side = dim.select(F.col(key).alias(end), *[F.col(v).alias(f"{v}_{end}") for v in values])
        out = out.join(side, end, "left")
    with partitions_for(pairs.sparkSession, pairs.count()):
        return cut_lineage(out, "ends")
