"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

A fingerprint bit is 1 if it is set in more than half of the hashes of a text's word shingles, repeats included. To find all
pairs of fingerprints with at most `bits` differing bits, the 64 bits are cut into `pieces`; a close pair agrees on some
choice of `pieces - bits` of them, so that it shares the block of that choice. Only distinct fingerprints are blocked, so
copies cost nothing. A block with more than `BLOCK` fingerprints (near copies by the thousand) is not paired as it stands: its
members are blocked anew by finer pieces, in which a block can hold few fingerprints by construction. Every link is found at every
size, without a cap.

Null and empty texts have no words and the fingerprint zero, which links like any other. Null ids have fingerprints, but never
name a component; a component of null ids alone has a null id. Repeated rows are rows of the same component.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.components import roots
from corpuskit.llm.frames import beside, whole
from corpuskit.session import cut_lineage

SEED = 42
BLOCK = 64  # fingerprints up to which a block is paired as it stands
FINE = {1: 1, 2: 2}  # bits of a fine piece by the number of bits that may differ
FINE_ELSE = 4


def _hashes(text: str, shingle: int) -> list[int]:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return []
    digest, line = xxhash.xxh64_intdigest, b" ".join(words)
    if len(words) <= shingle:
        return [digest(line, SEED)]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.append(0, ends[: -shingle])
    return [digest(line[i:j], SEED) for i, j in zip(starts.tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)]


_SPREAD = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.uint8)


def majority(hashes: list[int]) -> int:
    """As a signed 64-bit number."""
    if not hashes:
        return 0
    total, size = np.zeros(64, np.int64), 1 << 16
    for i in range(0, len(hashes), size):
        octets = np.array(hashes[i : i + size], "<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(total * 2 > len(hashes), bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprint(texts: Column, shingle: int) -> Column:
    @F.arrow_udf(returnType="bigint")
    def compute(values: pa.Array) -> pa.Array:
        return pa.array([majority(_hashes(t, shingle)) for t in values.to_pylist()], pa.int64())

    return compute(texts)


def fingerprinted(df: DataFrame, text: str = "text", shingle: int = 3, name: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of `text` as a signed bigint."""
    return beside(df, F.struct(fingerprint(whole(df, text), shingle).alias(name)), [name])


def _masks(places: list[list[int]], free: int) -> list[int]:
    """For each choice of `free` pieces, the mask of the bits of all the others."""
    out = []
    for left_out in combinations(range(len(places)), free):
        mask = sum(1 << bit for i, piece in enumerate(places) if i not in left_out for bit in piece)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def _cut(bits: list[int], pieces: int) -> list[list[int]]:
    return [bits[len(bits) * i // pieces : len(bits) * (i + 1) // pieces] for i in range(pieces)]


def pieces_for(n: int, bits: int) -> int:
    """The least number of pieces whose blocks hold about one of n spread-out fingerprints (`bits` + 2 at least)."""
    need = math.log2(max(n, 2))
    return next((m for m in range(bits + 2, 33) if 64 * (m - bits) / m >= need), 32)


def _blocked(fingerprints: DataFrame, masks: list[int]) -> DataFrame:
    # One constant, not an expression for each mask: plans and compiled code stay small however many there are.
    listed = F.split(F.lit(",".join(map(str, masks))), ",").cast("array<bigint>")
    each = fingerprints.select("f", F.posexplode(listed).alias("choice", "mask"))
    return each.select("f", "choice", F.col("f").bitwiseAND(F.col("mask")).alias("key"))


def _pairs(blocks: DataFrame, keys: list[str], bits: int) -> DataFrame:
    left, right = blocks.select(*keys, F.col("f").alias("a")), blocks.select(*keys, F.col("f").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    return left.join(right, keys).filter((F.col("a") > F.col("b")) & close).select("a", "b")


def close_pairs(fingerprints: DataFrame, bits: int, pieces: int | None = None, block: int = BLOCK) -> DataFrame:
    """Edges (a > b) between distinct fingerprints `f` with at most `bits` differing bits. May repeat an edge."""
    n = fingerprints.count()
    masks = _masks(_cut(list(range(64)), pieces or pieces_for(n, bits)), bits)
    blocks = _blocked(fingerprints, masks)
    sizes = blocks.groupBy("choice", "key").agg(F.count("*").alias("members"))
    shared = cut_lineage(sizes.filter("members > 1"), "blocks")
    small = shared.filter(F.col("members") <= block).select("choice", "key")
    found = _pairs(blocks.join(small, ["choice", "key"]), ["choice", "key"], bits)
    if not shared.filter(F.col("members") > block).head(1):
        return found
    # Members of a large block, each once: links among them show in fine blocks over all the bits.
    large = shared.filter(F.col("members") > block).select("choice", "key")
    crowded = cut_lineage(blocks.join(large, ["choice", "key"]).select("f").distinct(), "crowded")
    return found.unionByName(_fine_pairs(crowded, bits))


def _fine_pairs(crowded: DataFrame, bits: int) -> DataFrame:
    """Links among fingerprints that crowd together, over blocks of so fine pieces that few values can share one.

    With two bits and pieces of two bits that is 496 keys a fingerprint, and a block holds 16 values at most.
    """
    places = _cut(list(range(64)), 64 // FINE.get(bits, FINE_ELSE))
    blocks = _blocked(crowded, _masks(places, bits))
    keys = ["choice", "key"]
    shared = blocks.groupBy(*keys).agg(F.collect_list("f").alias("fs")).filter(F.size("fs") > 1)
    each = shared.select("fs", F.explode("fs").alias("a"))
    return each.select("a", F.explode("fs").alias("b")).filter(
        (F.col("a") > F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)
    )


def classes(prints: DataFrame, doc_id: str, fingerprint: str, bits: int) -> DataFrame:
    """(fingerprint, component_id): for each distinct fingerprint the smallest id that links reach from it."""
    distinct = prints.groupBy(F.col(fingerprint).alias("f")).agg(F.min(doc_id).alias("least"))
    held = cut_lineage(distinct, "fingerprints")
    tree = roots(close_pairs(held.select("f"), bits))
    rooted = held.join(tree, held.f == tree.node, "left").select("f", "least", F.coalesce("root", "f").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(named, "root").select(F.col("f").alias(fingerprint), "component_id")


def components(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, bits: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of `df`."""
    slim = fingerprinted(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", shingle)
    prints = cut_lineage(slim.select("doc_id", "fingerprint"), "prints")
    return prints.join(classes(prints, "doc_id", "fingerprint", bits), "fingerprint").select("doc_id", "fingerprint", "component_id")


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, bits: int = 3) -> DataFrame:
    """The rows of `df` with one row per component: the smallest id (null last), then the smallest hash of the text.

    Only ids, fingerprints and hashes are shuffled to choose; the chosen rows are then joined to their texts. Rows that agree in id and
    text are one row.
    """
    marked = df.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("hash"), fingerprint(whole(df, text), shingle).alias("f"))
    prints = cut_lineage(marked, "prints")
    distinct = cut_lineage(prints.select("f").distinct(), "fingerprints")
    tree = roots(close_pairs(distinct, bits))
    rooted = prints.join(tree, prints.f == tree.node, "left").withColumn("root", F.coalesce("root", "f"))
    return first_rows(df, rooted, doc_id, text)


def first_rows(df: DataFrame, rooted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The row of `df` that comes first in each component of `rooted` (doc_id, hash, root)."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")
    first = rooted.groupBy("root").agg(F.min(order).alias("first"))
    chosen = first.select(F.struct("first.doc_id", "first.hash").alias("__key"))
    rows = rooted.groupBy("doc_id", "hash").agg(F.count("*").alias("n")).select(F.struct("doc_id", "hash").alias("__key"), "n")
    chosen = cut_lineage(chosen.join(rows, "__key"), "chosen")
    keyed = df.withColumn("__key", F.struct(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("hash")))
    single = keyed.join(chosen.filter("n = 1"), "__key", "left_semi").drop("__key")
    several = chosen.filter("n > 1")
    if not several.head(1):
        return single
    repeated = keyed.join(several, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
    return single.unionByName(repeated)
