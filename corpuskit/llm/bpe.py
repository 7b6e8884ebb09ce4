"""Byte-level BPE by a global shuffle of distinct words.

Rows are gathered into chunks of bounded size. A chunk is cut into pre-tokens; it keeps one word number per position and sends
each distinct word, once, to the partition of the word's hash. There every distinct word of the whole corpus is encoded exactly
once, whichever chunks asked for it, and the ids go back to the chunk, where the word numbers put them into position. So what is
shuffled per occurrence of a word is its number (compressed), and a frequent word is a single entry per chunk: no hot key.

Encoding is a function of the word alone, so that lost tasks give the same ids again. `df` must give the same rows, in the same
order per partition, each time it is read (a table does; write a shuffled frame to a table first); chunks whose words do not match
end the job with an error instead of wrong ids. Null and empty texts have no ids. A text is cut as a whole, however long.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from corpuskit.llm.frames import partitions
from corpuskit.llm.pretokens import cut

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CHUNK_BYTES = 8 << 20  # of text in one chunk; a longer text is a chunk of its own
PIECE_BYTES = 1 << 20  # of text cut at a time within a chunk
PIECE_IDS = 1 << 18  # decoded at a time
PACKED = "chunk bigint, part int, words int, data binary, rows binary"


@functools.cache
def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@functools.cache
def encoding(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_ranks(path), special_tokens={})


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned numbers, byte plane by byte plane, compressed."""
    out = []
    for a in arrays:
        planes = np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T)
        out += [len(a).to_bytes(8, "little"), planes.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unsqueeze(data: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        n = int.from_bytes(raw[at : at + 8], "little")
        planes = np.frombuffer(raw, np.uint8, 4 * n, at + 8).reshape(4, n)
        out.append(np.ascontiguousarray(planes.T).view("<u4").ravel())
        at += 8 + 4 * n
    return out


def ragged(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[s : s + n] for all pairs of start and length, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


class _Chunk:
    """Rows of one chunk: what the rows carry, the word number of each position, and the words."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = {}
        self.numbers: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.carried: list[pa.RecordBatch] = []
        self.size = 0

    def add(self, texts: list[str], carried: pa.RecordBatch) -> None:
        raw, bounds, counts = cut(texts)
        at = bounds.tolist()
        tokens = [raw[i:j] for i, j in zip(at, at[1:], strict=False)]
        for word in dict.fromkeys(tokens):
            self.words.setdefault(word, len(self.words))
        self.numbers.append(np.fromiter(map(self.words.__getitem__, tokens), np.uint32, len(tokens)))
        self.counts.append(counts)
        self.carried.append(carried)
        self.size += len(raw)

    def places(self, parts: int) -> np.ndarray:
        """The partition of each word."""
        return np.fromiter((zlib.crc32(w) for w in self.words), np.uint32, len(self.words)) % np.uint32(parts)

    def sent_words(self, parts: int) -> Iterator[tuple]:
        place = self.places(parts)
        words = list(self.words)
        order = np.argsort(place, kind="stable")
        for part, group in zip(*_groups(place[order], order), strict=True):
            own = [words[i] for i in group.tolist()]
            lengths = squeeze(np.fromiter(map(len, own), np.uint32, len(own)))
            yield int(part), len(own), len(lengths).to_bytes(4, "little") + lengths + zstandard.compress(b"".join(own), 3), None

    def sent_rows(self, parts: int) -> tuple:
        numbers, counts = np.concatenate(self.numbers), np.concatenate(self.counts)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.carried[0].schema) as writer:
            for batch in self.carried:
                writer.write_batch(batch)
        rows = zstandard.compress(sink.getvalue().to_pybytes(), 1)
        return -1, len(self.words), squeeze(numbers, counts, self.places(parts)), rows


def _groups(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    if not len(keys):
        return keys, []
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return keys[np.append(0, cuts)], np.split(values, cuts)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, _Chunk]]:
    """Chunks with numbers that depend on the partition and the place in it alone."""
    first, n, chunk = TaskContext.get().partitionId() << 32, 0, _Chunk()
    for batch in batches:
        carried = batch.select(range(1, batch.num_columns)) if batch.num_columns > 1 else None
        sizes = np.cumsum(pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False))
        row = 0
        while row < batch.num_rows:
            base = sizes[row - 1] if row else 0
            end = max(row + 1, int(np.searchsorted(sizes, base + PIECE_BYTES, side="right")))
            chunk.add(batch.column(0).slice(row, end - row).to_pylist(), carried.slice(row, end - row))
            row = end
            if chunk.size >= CHUNK_BYTES:
                yield first + n, chunk
                n, chunk = n + 1, _Chunk()
    if chunk.carried:
        yield first + n, chunk


def _packer(parts: int, rows: bool):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in _chunks(batches):
            for sent in [chunk.sent_rows(parts)] if rows else chunk.sent_words(parts):
                yield _packed(number, *sent)

    return pack


def _packed(chunk: int, part: int, words: int, data: bytes, rows: bytes | None = None) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    values = (chunk, part, words, data, rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["chunk", "part", "words", "data", "rows"]
    )


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _encoder(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each distinct word is encoded when it first appears in its partition."""
        engine, known = encoding(path), {}
        for row in _rows_of(batches):
            data = row["data"]
            head = 4 + int.from_bytes(data[:4], "little")
            (lengths,) = unsqueeze(data[4:head])
            raw = zstandard.decompress(data[head:])
            at = [0, *np.cumsum(lengths).tolist()]
            ids: list[list[int]] = []
            for i, j in zip(at, at[1:], strict=False):
                word = raw[i:j]
                found = known.get(word)
                if found is None:
                    found = known[word] = engine._encode_single_piece(word)
                ids.append(found)
            counts = np.fromiter(map(len, ids), np.uint32, len(ids))
            flat = np.fromiter((x for y in ids for x in y), np.uint32, int(counts.sum()))
            yield _packed(row["chunk"], row["part"], row["words"], squeeze(counts, flat))

    return encode


def _assembler(schema: pa.Schema):
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come ordered by chunk, the chunk's own row first, then the ids of its words by partition."""
        own, parts = None, []
        for row in _rows_of(batches):
            if row["part"] < 0:
                if own is not None:
                    yield from _assembled(own, parts, schema)
                own, parts = row, []
            elif own is None or own["chunk"] != row["chunk"]:
                raise ValueError("ids without their chunk: the input changed between two reads")
            else:
                parts.append(row)
        if own is not None:
            yield from _assembled(own, parts, schema)

    return assemble


def _assembled(own: dict, parts: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    numbers, counts, place = unsqueeze(own["data"])
    if sum(p["words"] for p in parts) != own["words"]:
        raise ValueError("a chunk and its words do not match: the input changed between two reads")
    lengths, starts, flat, base = np.zeros(own["words"], np.int64), np.zeros(own["words"], np.int64), [], 0
    for part in parts:
        sizes, ids = unsqueeze(part["data"])
        mine = np.flatnonzero(place == part["part"])
        lengths[mine] = sizes
        starts[mine] = base + np.cumsum(sizes, dtype=np.int64) - sizes
        base += len(ids)
        flat.append(ids)
    ids = np.concatenate(flat).astype(np.int32) if flat else np.zeros(0, np.int32)
    bounds, row = np.append(0, np.cumsum(counts, dtype=np.int64)), 0
    with pa.ipc.open_stream(zstandard.decompress(own["rows"])) as reader:
        for carried in reader:
            each = numbers[bounds[row] : bounds[row + carried.num_rows]]
            size = lengths[each]
            tokens = ragged(ids, starts[each], size)
            token_bounds = np.append(0, np.cumsum(size))[bounds[row : row + carried.num_rows + 1] - bounds[row]]
            out = pa.ListArray.from_arrays(pa.array(token_bounds.astype(np.int32)), pa.array(tokens))
            yield pa.RecordBatch.from_arrays([*carried.columns, out.cast(schema.field(len(schema) - 1).type)], schema=schema)
            row += carried.num_rows


def encoded(df: DataFrame, text: str = "text", ids: str = "ids", ranks: str = RANKS) -> DataFrame:
    """The rows of `df` with the token ids of `text` in place of the text. `ranks` is a vocabulary file all executors have."""
    spark = df.sparkSession
    parts = partitions(spark)
    kept = [c for c in df.columns if c not in (text, ids)]
    slim = df.select(F.coalesce(df[text].cast("string"), F.lit("")).alias("text"), F.struct(*kept).alias("row") if kept else F.lit(0).alias("row"))
    schema = slim.select("row", F.array().cast("array<int>").alias("ids")).schema
    own = slim.mapInArrow(_packer(parts, rows=True), PACKED)
    words = slim.mapInArrow(_packer(parts, rows=False), PACKED)
    done = words.repartitionById(parts, F.col("part")).mapInArrow(_encoder(ranks), PACKED)
    joined = own.unionByName(done).repartition(parts, "chunk").sortWithinPartitions("chunk", "part")
    out = joined.mapInArrow(_assembler(to_arrow_schema(schema)), schema)
    return out.select(*[F.col(f"row.`{c}`") for c in kept], F.col("ids").alias(ids))


@functools.cache
def _table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    by_id = {i: token for token, i in _ranks(path).items()}
    tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


def decoded(ids: Column, ranks: str = RANKS) -> Column:
    """The bytes of an array of ids: a lookup in the token-byte table, whose size is that of the vocabulary."""

    @F.arrow_udf(returnType="binary")
    def decode(arrays: pa.Array) -> pa.Array:
        table, starts, lengths = _table(ranks)
        flat = arrays.flatten().to_numpy(zero_copy_only=False)
        bounds = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(arrays), 0).to_numpy(zero_copy_only=False)))
        raws, at, row = [], np.zeros(len(bounds), np.int64), 0
        while row < len(arrays):  # some rows at a time: the places of all bytes of a batch would need much room
            end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + PIECE_IDS, side="right")) - 1)
            some = flat[bounds[row] : bounds[end]]
            size = lengths[some]
            at[row + 1 : end + 1] = at[row] + np.append(0, np.cumsum(size))[bounds[row + 1 : end + 1] - bounds[row]]
            raws.append(ragged(table, starts[some], size))
            row = end
        raw = np.concatenate(raws) if raws else np.zeros(0, np.uint8)
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(arrays), [None, pa.py_buffer(at), pa.py_buffer(raw)]).cast(pa.binary())

    return decode(ids)
