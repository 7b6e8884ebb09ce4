"""Token ids as files of directly addressable codes, in ascending order of the document id.

Texts are encoded where they are read; each distinct word is encoded once per worker as long as it is remembered. Ids then go to the shard of
their document's range (cut points are quantiles of the ids, so a shard grows with the input over the number of shards), are sorted there and written in
segments: rows of a Parquet table that hold whole documents, their ids and lengths, and the levels of `codes`, stored
uncompressed so that a reader can address them.

Null texts are empty and have the end id alone. Null document ids come first; equal ids follow in the order of their
tokens. A document is never split, so a very long one makes a longer segment.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpuskit.llm import codes
from corpuskit.llm.bpe import ragged
from corpuskit.llm.frames import partitions, whole

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
SEGMENT_TOKENS = 1 << 18
REMEMBERED = 1_000_000  # words a worker remembers before it starts anew
REMEMBERED_PARTS = 250_000
PIECE_BYTES = 2 << 20  # of text encoded at a time
MARKS = b".,!?;:"
LONGEST = 48  # bytes of a word that is remembered

LEVELS = "array<struct<codes:binary,more:binary,ranks:binary>>"
SEGMENTS = f"shard int, segment int, first bigint, n_tokens bigint, doc_ids array<bigint>, lengths array<bigint>, levels {LEVELS}"
_LEVEL = pa.struct([("codes", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())])
_SEGMENT = pa.schema(
    [("shard", pa.int32()), ("segment", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()),
     ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("levels", pa.list_(_LEVEL))]
)


@functools.cache
def tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Tokenizer.from_file(path)


class Memory:
    """Words that a worker met twice in one piece: their ids lie one after the other. `parts` holds the ids of parts.

    Each piece builds a lookup of all remembered words, so words that are met once are not worth their place.
    """

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.words, self.parts = pa.array([], pa.string()), {}
        self.ids, self.lengths = np.zeros(0, "<u4"), np.zeros(0, np.int64)


@functools.cache
def _memory(path: str) -> Memory:
    return Memory()


def _as_bytes(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def parts_of(word: bytes) -> tuple[bytes, bytes]:
    """A word as two that the tokenizer would keep apart anyway: its core, and the marks that end it.

    Marks after a letter or digit start a pre-token of their own. A core of ASCII letters becomes lower-case, as the tokenizer makes it;
    other cores stay as they are, since composed characters and special tokens depend on case.
    """
    core = word.rstrip(MARKS)
    if not core[-1:].isalnum():
        return word, b""
    return core.lower() if core.isalpha() else core, word[len(core) :]


@functools.cache
def _word_ends(path: str) -> np.ndarray:
    """For each id, whether its token ends a pre-token."""
    vocab = tokenizer(path).get_vocab()
    out = np.zeros(max(vocab.values()) + 1, bool)
    out[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
    return out


def _encoded_parts(engine: Tokenizer, path: str, parts: list[bytes]) -> dict[bytes, bytes]:
    """Ids of each part. Parts of letters alone are one pre-token each: they are encoded in one text and told apart by the ends of
    pre-tokens. If their number is not that of the parts, and for all other parts, each is a text of its own."""
    texts = [p.decode("utf-8", "surrogatepass") for p in parts]
    letters = [i for i, t in enumerate(texts) if t.isalpha()]
    ids = np.array(engine.encode_batch_fast([" ".join([texts[i] for i in letters])], add_special_tokens=False)[0].ids, "<u4")
    ends = (np.flatnonzero(_word_ends(path)[ids]) + 1) * 4
    out = {}
    if len(ends) == len(letters):
        raw, at = ids.tobytes(), [0, *ends.tolist()]
        out = {parts[i]: raw[a:b] for i, a, b in zip(letters, at, at[1:], strict=False)}
    alone = [i for i, p in enumerate(parts) if p not in out]
    coded = engine.encode_batch_fast([texts[i] for i in alone], add_special_tokens=False)
    return out | {parts[i]: _as_bytes(e.ids) for i, e in zip(alone, coded, strict=True)}


def _coded(engine: Tokenizer, path: str, words: list[bytes], known: dict[bytes, bytes]) -> list[bytes]:
    """Ids of each word, put together from its parts; `known` remembers parts."""
    pairs = [parts_of(w) for w in words]
    new = [p for p in {p for pair in pairs for p in pair} if p not in known]
    known.update(_encoded_parts(engine, path, new))
    out = [known[core] + known[marks] for core, marks in pairs]
    for p in new:
        if len(p) > LONGEST:
            del known[p]
    return out


def encode_all(texts: pa.Array, path: str, end_id: int) -> list[bytes]:
    """Ids of each text as little-endian numbers of four bytes. The tokenizer drops white space and never joins what it separates,
    so words that ASCII blanks separate are encoded by themselves, and of each word its parts.

    Arrow cuts the texts, numbers their words and finds those that are remembered; only new words are handled one by one, and ids are
    put together by number.
    """
    memory = _memory(path)
    if len(memory.words) > REMEMBERED:
        memory.clear()
    if len(memory.parts) > REMEMBERED_PARTS:
        memory.parts.clear()
    lists = pc.ascii_split_whitespace(texts)
    numbered = lists.flatten().dictionary_encode()
    place = pc.index_in(numbered.dictionary, value_set=memory.words)
    fresh = numbered.dictionary.filter(pc.is_null(place))
    coded = _coded(tokenizer(path), path, fresh.cast(pa.binary()).to_pylist(), memory.parts)
    new_ids, new_lengths = np.frombuffer(b"".join(coded), "<u4"), np.array([len(c) // 4 for c in coded], np.int64)
    # Remembered words, new ones, and the end of a text as one more word.
    ids = np.concatenate([memory.ids, new_ids, np.array([end_id], "<u4")])
    lengths = np.concatenate([memory.lengths, new_lengths, [1]])
    starts = np.cumsum(lengths) - lengths
    at = place.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    at[at < 0] = len(memory.words) + np.arange(len(fresh))
    bounds = lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
    order = np.insert(at[numbered.indices.to_numpy(zero_copy_only=False)], bounds, len(lengths) - 1)
    raw = ragged(ids, starts[order], lengths[order]).tobytes()
    ends = 4 * np.cumsum(lengths[order])[bounds + np.arange(len(bounds))]
    often = np.bincount(numbered.indices.to_numpy(zero_copy_only=False), minlength=len(place))[pc.is_null(place).to_numpy(zero_copy_only=False)] > 1
    kept = often & pc.less_equal(pc.binary_length(fresh), LONGEST).to_numpy(zero_copy_only=False)
    own = starts[len(memory.words) : -1]
    memory.ids = np.concatenate([memory.ids, ragged(ids, own[kept], new_lengths[kept])])
    memory.lengths = np.concatenate([memory.lengths, new_lengths[kept]])
    memory.words = pa.concat_arrays([memory.words, fresh.filter(pa.array(kept))])
    return [raw[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]


def _pieces(texts: pa.Array, size: int = PIECE_BYTES) -> Iterator[pa.Array]:
    first, held = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        held += n
        if held >= size:
            yield texts.slice(first, i + 1 - first)
            first, held = i + 1, 0
    if first < len(texts):
        yield texts.slice(first)


def encoded(df: DataFrame, doc_id: str, text: str, path: str, end_id: int) -> DataFrame:
    """(doc_id, tokens): ids as little-endian numbers of four bytes."""

    @F.arrow_udf(returnType="binary")
    def encode(texts: pa.Array) -> pa.Array:
        return pa.array([ids for piece in _pieces(texts) for ids in encode_all(piece, path, end_id)], pa.binary())

    return df.select(F.col(doc_id).cast("bigint").alias("doc_id"), encode(whole(df, text)).alias("tokens"))


def sharded(df: DataFrame, source: DataFrame, doc_id: str, shards: int) -> DataFrame:
    """Add the shard of each row: ranges of the id, nulls in the first. Cut points come from the id column alone."""
    cuts = source.select(F.col(doc_id).cast("double").alias("k")).stat.approxQuantile("k", [i / shards for i in range(1, shards)], 0.2 / shards)
    inner = sorted(set(cuts))
    if not inner:
        return df.withColumn("shard", F.lit(0))
    bucketizer = Bucketizer(splits=[float("-inf"), *inner, float("inf")], inputCol="__k", outputCol="__shard", handleInvalid="keep")
    cut = bucketizer.transform(df.withColumn("__k", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))))
    return cut.withColumn("shard", F.col("__shard").cast("int")).drop("__k", "__shard")


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition come ordered by shard and document."""
    shard, number, first, ids, lengths, held, size = None, 0, 0, [], [], [], 0

    def flush() -> pa.RecordBatch:
        tokens = np.frombuffer(b"".join(held), "<u4")
        levels = [dict(zip(("codes", "more", "ranks"), level, strict=True)) for level in codes.pack(tokens)]
        values = ([shard], [number], [first], [len(tokens)], [ids], [lengths], [levels])
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _SEGMENT, strict=True)], schema=_SEGMENT)

    for batch in batches:
        for own, doc, tokens in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "tokens")), strict=True):
            if held and (own != shard or size >= SEGMENT_TOKENS):
                yield flush()
                number, first = (number + 1, first + size) if own == shard else (0, 0)
                ids, lengths, held, size = [], [], [], 0
            elif own != shard:
                number, first = 0, 0
            shard = own
            ids.append(doc)
            lengths.append(len(tokens) // 4)
            held.append(tokens)
            size += len(tokens) // 4
    if held:
        yield flush()


def write(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", tokenizer_file: str = TOKENIZER, end_id: int = END_ID) -> None:
    """Encode the texts and write their segments below `path`."""
    shards = partitions(df.sparkSession)
    tokens = sharded(encoded(df, doc_id, text, tokenizer_file, end_id), df, doc_id, shards)
    ordered = tokens.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "tokens")
    ordered.mapInArrow(_segments, SEGMENTS).write.option("compression", "uncompressed").parquet(path)


def segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENTS).parquet(path)


def levels_of(row) -> list[codes.Level]:
    return [(bytes(x["codes"]), bytes(x["more"]), bytes(x["ranks"])) for x in row["levels"]]


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, tokens) of every document in the files; `start` counts the ids of all documents before it."""
    held = segments(spark, path)
    sizes = held.groupBy("shard").agg(F.sum("n_tokens").alias("size"))  # a row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))

    def docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                numbers = codes.unpack(levels_of(row)).astype("<u4")
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                tokens = [numbers[i:j].tobytes() for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * len(tokens), pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["first"]),
                     pa.array(row["lengths"], pa.int64()), pa.array(tokens, pa.binary())],
                    ["shard", "doc_id", "place", "n_tokens", "tokens"],
                )

    each = held.select("shard", "first", "doc_ids", "lengths", "levels").mapInArrow(
        docs, "shard int, doc_id bigint, place bigint, n_tokens bigint, tokens binary"
    )
    joined = each.join(F.broadcast(bases), "shard")  # as many rows as shards
    return joined.select("doc_id", (F.col("place") + F.col("base")).alias("start"), "n_tokens", "tokens")


def token_at(spark: SparkSession, path: str, position: int) -> int:
    """The id at a global position, read from one segment without decoding it."""
    held = segments(spark, path)
    for row in held.groupBy("shard").agg(F.sum("n_tokens").alias("size")).orderBy("shard").collect():  # a row per shard
        if position < row["size"]:
            own = held.filter((F.col("shard") == row["shard"]) & (F.col("first") <= position) & (F.col("first") + F.col("n_tokens") > position))
            segment = own.select("first", "levels").first()
            return codes.at(levels_of(segment), position - segment["first"])
        position -= row["size"]
    raise IndexError("beyond the last token")

