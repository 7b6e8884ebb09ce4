"""Passages of `WINDOW` words or more that another row also holds, whatever blanks part the words.

Windows of words have anchors as windows of bytes have in `suffixes`: of the places where `CORE` words begin inside a window, the one whose hash
is least. Equal windows have anchors at the same offset, so only anchors whose core another row holds too can matter.

1. Anchors whose core no other row holds are left out by a grouped count.
2. The words around an anchor are those of all its windows. Where another row holds them too, all these windows are shared: one comparison.
3. The other anchors compare their windows one by one, among themselves and with one of each shared surroundings of the same core.

Hashes stand for words here: two of 64 bits, with different bases, decide that words are equal. All groups are counted in part before the
shuffle and joined back, so none is held whole. Rows get numbers as in `suffixes.repeats`, which also brings the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.llm.suffixes import PIECE_BYTES, chosen_places, numbered, text_pieces
from corpuskit.session import cut_lineage

WINDOW, CORE = 50, 10
PLACES = WINDOW - CORE + 1  # where a core can begin in a window

_BASES = (6364136223846793005, 0xD1342543DE82EF95)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def words(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first words of the texts) for texts that lie at bounds[i]:bounds[i + 1] of `raw`."""
    blank = _BLANK[raw]
    before, after = np.ones(len(raw) + 1, bool), np.ones(len(raw) + 1, bool)
    before[1:], after[:-1] = blank, blank
    before[bounds], after[bounds] = True, True
    starts = np.flatnonzero(~blank & before[:-1])
    return starts, np.flatnonzero(~blank & after[1:]) + 1, np.searchsorted(starts, bounds)


@lru_cache(8)
def _powers(base: int, size: int) -> np.ndarray:
    return np.cumprod(np.full(size, base, np.uint64))


class _Sums:
    """Hashes of runs of units from running sums of their values."""

    def __init__(self, values: np.ndarray, base: int) -> None:
        n = len(values)
        size = 1 << max(12, n.bit_length())
        self.back = _powers(pow(base, -1, 1 << 64), size)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _powers(base, size)[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64) * _MIX
        for shift in (32, 29):
            h ^= h >> np.uint64(shift)
            h *= _MIX
        return h ^ (h >> np.uint64(32))


def _word_sums(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[_Sums]:
    return [_Sums(_Sums(raw, base).of(starts, ends), base) for base in _BASES]


ANCHORS = "row bigint, place int, least int, most int, core bigint, around bigint"


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column(0).to_numpy()
        for first, raw, bounds in text_pieces(batch.column(1)):
            starts, ends, firsts = words(raw, bounds)
            one, two = _word_sums(raw, starts, ends)
            at = np.arange(max(0, len(starts) - CORE + 1))
            text, place, least, most, core = chosen_places(one.of(at, at + CORE), firsts, WINDOW, PLACES)
            a = place + firsts[text]
            around = two.of(a - most, a - least + WINDOW)
            columns = [rows[first + text], *(v.astype(np.int32) for v in (place, least, most)), core.view(np.int64), around.view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "place", "least", "most", "core", "around"])


def candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """(row, passages): anchors whose core another row holds too, in order of their places, for rows that have any.

    `shared`: another row holds the words around it; `asks`: its windows have to be compared.
    """
    found = cut_lineage(numbered(df, text).mapInArrow(_find_anchors, ANCHORS), "words")
    span = (F.min("row").alias("low"), F.max("row").alias("high"))
    cores = cut_lineage(found.groupBy("core").agg(*span).filter("low < high").select("core"), "cores")
    kept = cut_lineage(found.join(cores, "core", "left_semi"), "kept")
    key = ["core", "around", "least", "most"]
    groups = kept.groupBy(*key).agg(*span, F.min(F.struct("row", "place")).alias("first"))
    around = cut_lineage(groups.select(*key, "first", (F.col("low") < F.col("high")).alias("shared")), "around")
    open_cores = around.filter("not shared").select("core", F.lit(True).alias("open")).distinct()
    one_of_shared = F.coalesce("open", F.lit(False)) & (F.struct("row", "place") == F.col("first"))
    told = kept.join(around.join(open_cores, "core", "left"), key).select(
        "row", "place", "least", "most", "shared", (~F.col("shared") | one_of_shared).alias("asks")
    )
    lists = F.sort_array(F.collect_list(F.struct("place", "least", "most", "shared", "asks")))
    return cut_lineage(told.groupBy("row").agg(lists.alias("passages")), "candidates")


SPANS = "row bigint, start int, end int, shared boolean, one bigint, two bigint"


def _find_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Byte ranges that are shared (one range for those that overlap), and the windows to compare with their hashes."""

    def spans(rows: np.ndarray, texts: list[bytes], counts: np.ndarray, fields: list[np.ndarray]) -> pa.RecordBatch:
        place, least, most, shared, asks = fields
        raw = np.frombuffer(b"".join(texts), np.uint8)
        bounds = np.cumsum([0, *map(len, texts)])
        starts, ends, firsts = words(raw, bounds)
        text = np.repeat(np.arange(len(texts)), counts)
        low = firsts[text] + place - most
        high = firsts[text] + place - least + WINDOW  # both grow with the place
        own, begin, end = text[shared], starts[low[shared]], ends[high[shared] - 1]
        new = np.ones(len(own), bool)
        new[1:] = (own[1:] != own[:-1]) | (begin[1:] > end[:-1])
        last = np.append(new[1:], True)[: len(new)]
        own, begin, end = own[new], begin[new], end[last]
        n = (most - least + 1)[asks]
        window = np.repeat(low[asks] - np.cumsum(n) + n, n) + np.arange(n.sum())
        asking, known = np.repeat(text[asks], n), np.repeat(shared[asks], n)
        one, two = (sums.of(window, window + WINDOW).view(np.int64) for sums in _word_sums(raw, starts, ends))
        of, none = np.append(own, asking), pa.nulls(len(own), pa.int64())
        columns = [
            pa.array(rows[of]),
            pa.array((np.append(begin, starts[window]) - bounds[of]).astype(np.int32)),
            pa.array((np.append(end, ends[window + WINDOW - 1]) - bounds[of]).astype(np.int32)),
            pa.array(np.append(np.ones(len(own), bool), known)),
            *(pa.concat_arrays([none, pa.array(h)]) for h in (one, two)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["row", "start", "end", "shared", "one", "two"])

    for batch in batches:
        rows, lists = batch.column("row").to_numpy(), batch.column("passages")
        at = lists.offsets.to_numpy()
        fields = [lists.values.field(i).to_numpy(zero_copy_only=False) for i in range(5)]
        texts, size, first = [], 0, 0
        for i, squeezed in enumerate(batch.column("text")):
            texts.append(zstandard.decompress(squeezed.as_py()))
            size += len(texts[-1])
            if size >= PIECE_BYTES or i == len(rows) - 1:
                some = slice(at[first], at[i + 1])
                yield spans(rows[first : i + 1], texts, np.diff(at[first : i + 2]), [f[some] for f in fields])
                texts, size, first = [], 0, i + 1


def shared_bytes(texts: DataFrame) -> DataFrame:
    """(row, n_passage_bytes) for rows that hold such passages: their bytes, from the first word to the last. `texts` are
    (row, text, passages), compressed, of `suffixes.repeats` beside the `candidates`."""
    asked = texts.filter("passages is not null").select("row", "text", "passages")
    spans = cut_lineage(asked.mapInArrow(_find_spans, SPANS), "spans")
    windows = spans.filter("one is not null")
    groups = windows.groupBy("one", "two").agg(F.min("row").alias("low"), F.max("row").alias("high"), F.max("shared").alias("known"))
    equal = groups.filter("known or low < high").select("one", "two")
    hit = windows.filter("not shared").join(equal, ["one", "two"], "left_semi")
    held = spans.filter("one is null").unionByName(hit).select("row", "start", "end")
    earlier = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    own = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    return held.select("row", F.greatest(own, F.lit(0)).alias("own")).groupBy("row").agg(F.sum("own").alias("n_passage_bytes"))
