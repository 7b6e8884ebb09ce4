"""Fixity audit of web archives by Merkle trees.

Records of a file stand one after the other; each has a key (file, place), a range of byte offsets and a digest. Nodes of a tree hash the
digests and sizes of up to `FANOUT` children in the order of their offsets, up to one root per replica. An audit compares
the roots and goes down only where nodes differ, so that two equal replicas cost one comparison, and one damaged record costs
`FANOUT` comparisons a level. Each level is a grouped aggregation with small groups, written to the shared folder.

Nulls in an address or a body read as empty. A record that one replica lacks shows as `missing` or `extra`; a record whose bytes changed as
`changed`. Records with a null id share the files below zero, dealt by a hash. Repeated ids stand in the order of their digests; the key
numbers them. Empty replicas have no root and no finding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.session import cut_lineage

RECORDS_PER_FILE = 512
NULL_FILES = 4096
FANOUT_BITS = 3
FANOUT = 1 << FANOUT_BITS


def record(page_id: Column, url: Column, body: Column) -> Column:
    """Bytes of one record: header lines, an empty line, the body, two empty lines."""
    content = F.encode(F.coalesce(body, F.lit("")), "UTF-8")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(content).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(F.encode(head, "UTF-8"), content, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def stored(pages: DataFrame, page_id: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """(page_id, file, record) of one replica."""
    key = pages[page_id].cast("bigint")
    dealt = -1 - F.pmod(F.xxhash64(pages[url]), F.lit(NULL_FILES))
    file = F.coalesce(F.floor(key / RECORDS_PER_FILE).cast("bigint"), dealt)
    return pages.select(key.alias("page_id"), file.alias("file"), record(key, pages[url], pages[body]).alias("record"))


def leaves(replica: DataFrame) -> DataFrame:
    """(page_id, file, nth, start, end, digest): digests and ordered offset ranges. `nth` tells rows of one id apart."""
    slim = replica.select("page_id", "file", F.octet_length("record").cast("bigint").alias("size"), F.sha2("record", 256).alias("digest"))
    order = Window.partitionBy("file").orderBy("page_id", "digest")
    same = Window.partitionBy("file", "page_id").orderBy("digest")
    placed = slim.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.withColumn("nth", F.row_number().over(same) - 1)
    return placed.select("page_id", "file", "nth", (F.col("end") - F.col("size")).alias("start"), "end", "digest")


def _parents(nodes: DataFrame, key: Column) -> DataFrame:
    """Parents of (replica, key, start, end, digest).

    A parent hashes the keys, sizes and digests of its children in order. Sizes, not offsets: a record that grew moves all that
    follows it in the file, and those records are not damaged.
    """
    child = F.struct("key", "start", "end", "digest")
    grouped = nodes.groupBy("replica", key.alias("parent")).agg(F.sort_array(F.collect_list(child)).alias("c"))
    text = F.array_join(F.transform("c", lambda x: F.concat_ws(":", x.key, x.end - x.start, x.digest)), ",")
    return grouped.select("replica", F.col("parent").alias("key"), F.array_min("c.start").alias("start"), F.array_max("c.end").alias("end"), F.sha2(text, 256).alias("digest"))


def tree(both: DataFrame) -> list[DataFrame]:
    """Levels from leaves to roots, of all replicas. `both` has replica, key (bigint), start, end, digest.

    Keys are whole numbers from zero on; children of a node are neighbours, so that each level has about an eighth of the nodes of the last.
    """
    levels = [cut_lineage(both, "leaves")]
    while True:
        span = levels[-1].agg(F.min("key"), F.max("key"), F.count("*")).first()
        if not span[2] or span[0] == span[1]:
            return levels
        levels.append(cut_lineage(_parents(levels[-1], F.shiftright("key", FANOUT_BITS)), "level"))


def differing(nodes: DataFrame) -> DataFrame:
    """Keys whose nodes differ between the replicas `a` and `b`, or that one of them lacks."""
    digest = lambda r: F.max(F.when(F.col("replica") == r, F.col("digest")))
    sides = nodes.groupBy("key").agg(digest("a").alias("digest_a"), digest("b").alias("digest_b"), F.count("*").alias("n"))
    return sides.filter(~F.col("digest_a").eqNullSafe(F.col("digest_b")))


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """Damaged records of replica b: page_id, file, start and end (offsets in a; in b where a lacks it), status, both digests."""
    # The key numbers the slots of all files: a file has as many slots as ids and repeats of an id may take.
    kept = {name: cut_lineage(leaves(r).withColumn("replica", F.lit(name)), "manifest") for name, r in (("a", a), ("b", b))}
    both = kept["a"].unionByName(kept["b"])
    slots = both.select("file", "page_id", "nth").distinct()
    within = Window.partitionBy("file").orderBy("page_id", "nth")
    numbered = slots.withColumn("slot", F.row_number().over(within) - 1)
    most, least = numbered.agg(F.max("slot"), F.min("file")).first()
    width = max(1, int(most or 0).bit_length())
    # Keys count from zero: halving them then ends in one root for files below zero too.
    keyed = numbered.withColumn("key", F.shiftleft(F.col("file") - F.lit(least or 0), width) + F.col("slot"))
    same = ["file", "page_id", "nth"]
    match = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in same]
    placed = both.alias("l").join(keyed.alias("r"), match).select("l.*", "r.key")
    nodes = cut_lineage(placed, "placed")
    levels = tree(nodes.select("replica", "key", "start", "end", "digest"))
    suspects = differing(levels[-1]).select("key")
    for level in reversed(levels[:-1]):
        branch = level.join(suspects.withColumnRenamed("key", "__up"), F.shiftright("key", FANOUT_BITS) == F.col("__up"), "left_semi")
        suspects = cut_lineage(differing(branch).select("key"), "suspects")
    found = nodes.join(suspects, "key", "left_semi")
    side = lambda r, c: F.max(F.when(F.col("replica") == r, F.col(c)))
    pairs = found.groupBy("key").agg(
        F.max("page_id").alias("page_id"),
        F.max("file").alias("file"),
        F.coalesce(side("a", "start"), side("b", "start")).alias("start"),
        F.coalesce(side("a", "end"), side("b", "end")).alias("end"),
        side("a", "digest").alias("digest_a"),
        side("b", "digest").alias("digest_b"),
    )
    status = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("changed")
    return pairs.select("page_id", "file", "start", "end", status.alias("status"), "digest_a", "digest_b")
