"""N-gram Jaccard join: texts whose sets of word shingles have a similarity of 4/5 or more, by prefixes under several token orders.

In any order of all tokens, two sets of that similarity share a token among the first fifth and one more of either (its prefix). So a
candidate pair must share prefix tokens under each of three orders, and a set without a shared prefix token under one of them is out
at once:

1. a hashed sample of the tokens comes first, the rarest of it before the others, counted over all sets;
2. all tokens of the sets that are left, the rarest first, counted over those;
3. another sample, counted over what is left then.

A prefix token that no other set has cannot be shared, and rare tokens come first: texts with a fifth of their shingles to themselves
leave in the first order, whatever lines they share with others. Counts and prefixes are aggregations and joins; a token that very many
sets share is a skewed join, not a task.

The pairs come from the prefixes of the second order, and the prefixes of the other two must meet before sets are compared. Only
distinct sets take part. For components not all links are needed: the members of a token are first compared with two of them,
one the least peculiar; then only members that still stand in different components meet. Where few members share the token they are
paired, where many do they meet in cells of two blocks of bounded size, and a pair that shares several such tokens is compared in
the cell of the least. Every pair of a token so meets or is in one component already: no link between components is lost.

Null and empty texts have the empty set, which is linked with nothing; each is a component of its own. Null ids never name a component.
Repeated rows are rows of one component. Empty tables give no rows. Tokens are 64-bit hashes; sets are told apart by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.components import roots
from corpuskit.llm.frames import bounded_batches, partitions, whole
from corpuskit.session import cut_lineage

SAMPLES = (0.4, 0.5)  # shares of the tokens that come first in the first and the third order
FEW_MEMBERS = 64  # sets of a token up to which they are paired as they stand
CELL_TOKENS = 1 << 18  # in one block of a cell
FEW_ROWS = 500_000  # ids up to which a list of them is broadcast, about 30 MB
SLICE_BYTES = 4 << 20  # of text taken apart at a time
_SEEDS = [np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344), np.uint64(0xA4093822299F31D0)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of all texts, and where each text's words begin (and the last end)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = lists.flatten().dictionary_encode()
    held = [xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in coded.dictionary.to_pylist()]
    empty = np.array([w == "" for w in coded.dictionary.to_pylist()], bool)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    kept = ~empty[codes] if len(empty) else np.zeros(0, bool)
    counts = np.append(0, np.cumsum(kept))
    starts = counts[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    return np.array(held, np.uint64)[codes[kept]] if len(held) else np.zeros(0, np.uint64), starts


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    first, size = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if size and size + n > SLICE_BYTES:
            yield texts.slice(first, i - first)
            first, size = i, 0
        size += n
    yield texts.slice(first)


def token_sets(texts: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; with fewer words than a shingle, one hash of them all."""
    for part in _slices(texts):
        words, starts = _word_hashes(part)
        held = np.full(max(0, len(words) - shingle + 1), _SEEDS[0])
        for k in range(shingle):
            held = mixed((held ^ words[k : k + len(held)]) * _SEEDS[1] + _SEEDS[2])
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if b - a >= shingle:
                yield np.unique(held[a : b - shingle + 1])
            elif b > a:
                yield np.array([xxhash.xxh64_intdigest(words[a:b].tobytes(), b - a)], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def prefix_size(n: int) -> int:
    return n // 5 + 1


def sampled(tokens: np.ndarray, order: int) -> np.ndarray:
    """The tokens among which the prefix in the first or second sampled order lies: the sample, and at least a prefix."""
    if not len(tokens):
        return tokens
    rank = mixed(tokens ^ _SEEDS[order])
    inside = rank < np.uint64(SAMPLES[order] * 2**64)
    least = prefix_size(len(tokens))
    return tokens[inside] if inside.sum() >= least else tokens[np.argpartition(rank, least - 1)[:least]]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.append(0, np.cumsum([len(a) for a in arrays])).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate([np.zeros(0, np.uint64), *arrays]).view(np.int64))


def _marks(texts: Column, shingle: int) -> Column:
    @F.arrow_udf(returnType="struct<n int, digest binary, tokens array<bigint>>")
    def compute(values: pa.Array) -> pa.Array:
        sizes, digests, tokens = [], [], []
        for found in token_sets(values, shingle):
            sizes.append(len(found))
            digests.append(xxhash.xxh128_digest(found.tobytes()))
            tokens.append(sampled(found, 0))
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()), _lists(tokens)], ["n", "digest", "tokens"])

    return compute(texts)


def _sets(texts: Column, shingle: int) -> Column:
    @F.arrow_udf(returnType="struct<tokens array<bigint>, third array<bigint>>")
    def compute(values: pa.Array) -> pa.Array:
        found = list(token_sets(values, shingle))
        return pa.StructArray.from_arrays([_lists(found), _lists([sampled(s, 1) for s in found])], ["tokens", "third"])

    return compute(texts)


def _few(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= FEW_ROWS else table


def prefixes(sets: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(node, share, prefix) of the sets (node, n, tokens) that share a prefix token: the shared ones, and the part of the tokens that is not shared."""
    each = sets.select("node", "n", F.size(tokens).alias("size"), F.explode(tokens).alias("token"))
    often = cut_lineage(each.groupBy("token").agg(F.count("*").alias("sets")).filter("sets > 1"), "often")
    shared = each.join(often, "token").groupBy("node", "n", "size").agg(F.collect_list(F.struct("sets", "token")).alias("found"))
    left = shared.withColumn("room", F.expr("n div 5 + 1 - (size - size(found))").cast("int")).filter("room > 0")
    first = F.slice(F.sort_array("found"), F.lit(1), F.col("room"))
    return cut_lineage(left.select("node", (1 - F.size("found") / F.col("size")).alias("share"), first["token"].alias("prefix")), "prefixes")


def _alike(n: str, m: str) -> Column:
    """Sizes that leave a similarity of 4/5 possible."""
    return (F.col(n) * 5 >= F.col(m) * 4) & (F.col(m) * 5 >= F.col(n) * 4)


def _similar(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose prefixes meet under the other orders and whose sets have a similarity of 4/5 or more."""
    side = lambda end: nodes.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("first", "third", "tokens")])
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.filter(F.arrays_overlap("first_a", "first_b") & F.arrays_overlap("third_a", "third_b"))
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return both.filter(common * 9 >= (F.size("tokens_a") + F.size("tokens_b")) * 4).select("a", "b")  # c / (s + t - c) >= 4 / 5


def _common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many numbers each of the sets in a has in common with each in b."""
    flat = np.concatenate([*a, *b, np.zeros(0, np.int64)])
    _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in (*a, *b)])
    several = np.cumsum(times > 1) - 1
    kept = times[code] > 1
    code, row, total = several[code[kept]], row[kept], int((times > 1).sum())
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    out, wide = np.zeros((len(a), len(b)), np.float32), 4096
    for low in range(0, total, wide):
        here = slice(*np.searchsorted(code, [low, low + wide]))
        mark = np.zeros((len(a) + len(b), min(wide, total - low)), np.float32)
        mark[row[here], code[here] - low] = 1
        out += mark[: len(a)] @ mark[len(a) :].T
    return out


def _links(rows: list[dict]) -> Iterator[tuple[int, int]]:
    """Links between members of different components in one cell: of block i with block j, or of a block with itself."""
    token, i, j = rows[0]["token"], rows[0]["i"], rows[0]["j"]
    left = [r for r in rows if r["block"] == i]
    right = left if i == j else [r for r in rows if r["block"] == j]
    if not left or not right:
        return
    take = lambda side, c: np.array([r[c] for r in side], np.int64)
    sets = lambda side, c: [np.array(r[c], np.int64) for r in side]
    n, m = take(left, "n")[:, None], take(right, "n")[None, :]
    may = (take(left, "root")[:, None] != take(right, "root")[None, :]) & (n * 5 >= m * 4) & (m * 5 >= n * 4)
    if i == j:
        may &= take(left, "node")[:, None] < take(right, "node")[None, :]
    if not may.any():
        return
    before = lambda side: [x[x < token] for x in sets(side, "crowded")]
    may &= _common(before(left), before(right)) == 0
    for order in ("first", "third"):
        if may.any():
            may &= _common(sets(left, order), sets(right, order)) > 0
    if may.any():
        may &= _common(sets(left, "tokens"), sets(right, "tokens")) * 9 >= (n + m) * 4
    for x, y in zip(*np.nonzero(may), strict=True):
        yield left[x]["node"], right[y]["node"]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, held = None, []

    def out() -> pa.RecordBatch:
        found = list(_links(held)) if held else []
        ends = [pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)]
        return pa.RecordBatch.from_arrays(ends, ["a", "b"])

    for batch in batches:
        for row in batch.to_pylist():
            if (row["token"], row["i"], row["j"]) != key:
                yield out()
                key, held = (row["token"], row["i"], row["j"]), []
            held.append(row)
    yield out()


def _crowded_links(members: DataFrame, nodes: DataFrame, cell_tokens: int) -> DataFrame:
    """Links (a, b) between different roots among the members (token, node, n, root) of tokens that many sets share."""
    sized = members.groupBy("token").agg(F.ceil(F.sum("n") / cell_tokens).cast("int").alias("blocks"))
    placed = members.join(sized, "token").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cells = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    slim = cells.select("token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "root")
    of = members.groupBy("node").agg(F.collect_set("token").alias("crowded"))
    whole_rows = slim.join(nodes.join(of, "node"), "node").repartition(partitions(members.sparkSession), "token", "i", "j").sortWithinPartitions("token", "i", "j")
    return whole_rows.mapInArrow(_cells, "a bigint, b bigint")


def edges(nodes: DataFrame, few_members: int = FEW_MEMBERS, cell_tokens: int = CELL_TOKENS) -> DataFrame:
    """Links (a, b) that connect all that similar pairs connect, among nodes (node, n, share, first, second, third, tokens)."""
    each = nodes.select("node", "n", "share", F.explode("second").alias("token"))
    chance = F.xxhash64("node")
    ends = each.groupBy("token").agg(
        F.count("*").alias("members"),
        F.min(F.struct("share", chance.alias("chance"), "node", "n")).alias("least"),
        F.min(F.struct(chance.alias("chance"), "node", "n")).alias("any"),
    )
    shared = cut_lineage(ends.filter("members > 1").select("token", "members", F.array("least.node", "any.node").alias("hubs"), F.array("least.n", "any.n").alias("sizes")), "shared")
    members = cut_lineage(each.join(shared.select("token"), "token", "left_semi").select("token", "node", "n"), "members")
    met = members.join(shared, "token").select("node", "n", F.explode(F.arrays_zip("hubs", "sizes")).alias("hub"))
    met = met.select("node", "n", F.col("hub.hubs").alias("other"), F.col("hub.sizes").alias("m")).filter((F.col("node") != F.col("other")) & _alike("n", "m"))
    pairs = cut_lineage(met.select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b")).distinct(), "pairs")
    found = cut_lineage(_similar(pairs, nodes), "edges")
    tree = roots(found)
    rooted = members.join(tree, "node", "left").select("token", "node", "n", F.coalesce("root", "node").alias("root"))
    rooted = cut_lineage(rooted, "rooted")
    apart = rooted.groupBy("token").agg(F.count("*").alias("members"), F.min("root").alias("low"), F.max("root").alias("high"))
    apart = cut_lineage(apart.filter("low != high AND members > 2").select("token", "members"), "apart")
    open_ = cut_lineage(rooted.join(apart, "token"), "open")
    some, many = open_.filter(F.col("members") <= few_members), open_.filter(F.col("members") > few_members)
    right = some.select("token", F.col("node").alias("other"), F.col("n").alias("m"), F.col("root").alias("to"))
    across = some.join(right, "token").filter((F.col("node") > F.col("other")) & (F.col("root") != F.col("to")) & _alike("n", "m"))
    rest = cut_lineage(across.select(F.col("node").alias("a"), F.col("other").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti"), "pairs")
    out = found.unionByName(_similar(rest, nodes))
    return out.unionByName(_crowded_links(many.select("token", "node", "n", "root"), nodes, cell_tokens)) if many.head(1) else out


def components(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    few_members: int = FEW_MEMBERS,
    cell_tokens: int = CELL_TOKENS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of `df`."""
    bounded_batches(df.sparkSession)
    docs = df.select(F.col(doc_id).alias("doc_id"), whole(df, text).alias("text"))
    hashes = [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")]
    marked = docs.select("doc_id", *hashes, _marks(F.col("text"), shingle).alias("m")).select("doc_id", "h1", "h2", "m.*")
    rows = cut_lineage(marked.withColumn("id", F.monotonically_increasing_id()), "marked")
    sets = rows.filter("n > 0").groupBy("digest").agg(F.min("id").alias("node"), F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    sets = cut_lineage(sets, "sets")

    # First order: all distinct sets. Rows that repeat a set are named and left out, so that tokens stay where they are while those are few.
    again = rows.select("id", "digest").join(sets.filter("copies > 1").select("digest", "node"), "digest").filter("id != node")
    again = _few(cut_lineage(again.select(F.col("id").alias("node")), "again"))
    first = prefixes(rows.filter("n > 0").select(F.col("id").alias("node"), "n", "tokens").join(again, "node", "left_anti"))
    # The whole sets of those that are left, from one text of each.
    wanted = rows.join(first.select(F.col("node").alias("id")), "id").select(F.col("id").alias("node"), "n", "h1", "h2", F.col("doc_id").alias("of"))
    wanted = cut_lineage(wanted, "wanted")
    texts = docs.select("doc_id", "text", *hashes).join(_few(wanted), ["h1", "h2"]).filter(F.col("doc_id").eqNullSafe(F.col("of")))
    held = cut_lineage(texts.select("node", "n", _sets(F.col("text"), shingle).alias("m")).select("node", "n", "m.*"), "held")
    if held.count() > wanted.count():  # rows that repeat both id and text
        held = cut_lineage(held.dropDuplicates(["node"]), "held")
    # Second and third order, over what the order before has left.
    second = prefixes(held)
    still = held.join(second.select("node"), "node", "left_semi")
    third = prefixes(still, "third")
    nodes = still.drop("third").join(first.select("node", F.col("prefix").alias("first")), "node")
    nodes = nodes.join(second.select("node", "share", F.col("prefix").alias("second")), "node")
    nodes = cut_lineage(nodes.join(third.select("node", F.col("prefix").alias("third")), "node"), "nodes")

    tree = roots(edges(nodes, few_members, cell_tokens))
    rooted = sets.join(tree, "node", "left").select("digest", "least", F.coalesce("root", "node").alias("root"))
    rooted = cut_lineage(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    names = cut_lineage(rooted.join(named, "root").select("digest", "component_id"), "names")
    with_words = rows.filter("n > 0").select("doc_id", "n", "digest").join(names, "digest").select("doc_id", "n", "component_id")
    without = rows.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return with_words.unionByName(without).select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "component_id")
