"""Benchmark decontamination: one Aho-Corasick automaton over the normalised windows of test items, one scan per text.

A-Z are lower-cased and every other ASCII character outside 0-9 and a-z separates words. An item gives its runs of `window`
consecutive words, a shorter one itself. A text is normalised to words with single spaces, the automaton reads it once, and hits
are mapped back to word numbers and to the original code points.

Items are gathered for the automaton: they are a test suite, not the corpus. Their number may still be large, so one automaton
holds at most `windows_per_automaton` of them; more windows make several automata that read the texts one after the other, in the
same narrow pass. Nothing is shuffled but the windows. Null texts and texts without a word have no hits; items without
a word or text have no window; an item with a null id marks words but is not listed; repeated items count once.
"""

from __future__ import annotations

import re
import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.frames import beside, whole

WINDOW = 10
WINDOWS_PER_AUTOMATON = 50_000

#: Byte by byte: letters lower-cased, other ASCII to blanks; bytes of longer characters belong to words.
_FOLD = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()


def fold(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def item_windows(text: str, window: int) -> set[bytes]:
    words = fold(text)
    if not words:
        return set()
    return {b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))}


def windows_of(items: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """(window, items): each distinct window with the ids that hold it."""

    @F.arrow_udf(returnType="array<binary>")
    def cut(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(item_windows(t, window)) for t in texts.to_pylist()], pa.list_(pa.binary()))

    each = items.select(items[item].cast("string").alias("item"), F.explode(cut(whole(items, text))).alias("window"))
    return each.groupBy("window").agg(F.collect_set("item").alias("items"))


def automaton(windows: list[tuple[bytes, list[str]]]) -> ahocorasick.Automaton:
    """Windows with a blank on either side, so that words match whole; bytes stand as Latin-1 characters."""
    built = ahocorasick.Automaton()
    for window, items in windows:
        built.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, items))
    built.make_automaton()
    return built


_BUILT: dict[str, ahocorasick.Automaton] = {}


class Part:
    """Windows of one automaton, sent to the executors once and built once in each worker process."""

    def __init__(self, windows) -> None:
        self.name, self.windows = uuid.uuid4().hex, windows

    def built(self) -> ahocorasick.Automaton:
        if self.name not in _BUILT:
            _BUILT[self.name] = automaton(self.windows.value)
        return _BUILT[self.name]


def scan(built: ahocorasick.Automaton, words: list[bytes]) -> list[tuple[int, int, list[str]]]:
    """(first word, last word, items) of every occurrence."""
    if not words or not len(built):
        return []
    line = b" ".join([b"", *words, b""]).decode("latin-1")
    hits = list(built.iter(line))
    if not hits:
        return []
    ends = np.cumsum([len(w) + 1 for w in words])  # where the blank after each word stands
    last = np.searchsorted(ends, [end for end, _ in hits])
    return [(int(k) - n + 1, int(k), items) for k, (_, (n, items)) in zip(last, hits, strict=True)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def parts_of(items: DataFrame, item: str, text: str, window: int, windows_per_automaton: int) -> list[Part]:
    spark = items.sparkSession
    windows = windows_of(items, item, text, window).cache()
    count = max(1, -(-windows.count() // windows_per_automaton))
    numbered = windows.withColumn("part", F.pmod(F.xxhash64("window"), F.lit(count)))
    parts = []
    for number in range(count):
        rows = numbered.filter(F.col("part") == number).select("window", "items").collect()
        packed = [(bytes(r["window"]), sorted(r["items"])) for r in rows]
        parts.append(Part(spark.sparkContext.broadcast(packed)))
    windows.unpersist()
    return parts


def contamination(
    df: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    windows_per_automaton: int = WINDOWS_PER_AUTOMATON,
) -> DataFrame:
    """Add n_words, n_hit (words inside an occurrence), hit_items (sorted as strings), hit_spans (maximal runs of hit words, as
    code points of the original text, end exclusive)."""
    parts = parts_of(items, item, item_text, window, windows_per_automaton)

    @F.arrow_udf(
        returnType="struct<n_words:bigint,n_hit:bigint,hit_items:array<string>,hit_spans:array<struct<start:int,end:int>>>"
    )
    def find(texts: pa.Array) -> pa.Array:
        automata = [p.built() for p in parts]
        n_words, n_hit, names, places = [], [], [], []
        for value in texts.to_pylist():
            words = fold(value)
            hits = [h for built in automata for h in scan(built, words)]
            runs = merged([h[:2] for h in hits])
            n_words.append(len(words))
            n_hit.append(sum(last - first + 1 for first, last in runs))
            names.append(sorted({i for h in hits for i in h[2]}))
            places.append(_original(value, runs) if runs else [])
        return pa.StructArray.from_arrays(
            [
                pa.array(n_words, pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array(names, pa.list_(pa.string())),
                pa.array(places, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ],
            ["n_words", "n_hit", "hit_items", "hit_spans"],
        )

    return beside(df, find(whole(df, text)), ["n_words", "n_hit", "hit_items", "hit_spans"])


def _original(text: str, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Word numbers as code points: words keep their order and their places in the folded bytes."""
    raw = text.encode("utf-8", "surrogatepass")
    bounds = [m.span() for m in re.finditer(rb"[^\x20]+", raw.translate(_FOLD))]
    lead = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [{"start": int(lead[bounds[a][0]]), "end": int(lead[bounds[b][1]])} for a, b in runs]
