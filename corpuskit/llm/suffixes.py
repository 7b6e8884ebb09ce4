"""Exact removal of long repeated strings by a distributed merge sort of suffixes.

Every window of `WINDOW` bytes has an anchor: of the places where `CORE` bytes begin inside it, the one whose hash is least (the last
of equals). It depends on the window's bytes alone, so equal windows anywhere have anchors at the same offset, and it is enough to sort the
suffixes at anchors, about one place in 137, to both sides. Windows o of an anchor a (o bytes before it) repeat if another anchor b
shares at least o bytes to the left and WINDOW - o to the right.

1. Anchors whose core occurs once in the corpus cannot repeat and are left out by a grouped count. The others are joined to their texts.
2. Each task sorts its suffixes, folds equal ones (copies in one task are settled there), cuts the run at the range splitters and sends the
   pieces front-coded. Two orders go out: core, rest to the right, left side; and core, left side, rest to the right.
3. A range merges its runs with a loser tree that keeps common prefixes (`frontcode.merge`). The common prefixes of neighbours give how far
   each pair agrees in the order's first direction; the second is compared. Up to `REACH` neighbours on either side are looked at, further ones
   only where they may still decide something: all that share a core with such an anchor are sorted again, with a longer reach in
   longer ranges, until none is open.
4. Ranges hand their first and last suffixes to the boundary between them, so that neighbours are met across ranges, and a group of any
   size may lie on many ranges.

A task holds one range, a piece of a run and the boundary lists, never a whole group. Offsets are of UTF-8 bytes. Null texts are empty; texts
shorter than a window have nothing to remove. Matches never cross texts. `df` must give the same rows in the same partitions each
time it is read, as a table does; rows get numbers from that.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from corpuskit.llm import frontcode
from corpuskit.llm.frames import partitions, whole
from corpuskit.session import cut_lineage

WINDOW, CORE = 400, 128
PLACES = WINDOW - CORE + 1  # where a core can begin in a window
LEFT = PLACES - 1
WIDTH = WINDOW + LEFT  # bytes of a suffix key
PAD = b"\xff"  # no byte of UTF-8
REACH = 16
RUN_KEYS = 12_000  # anchors sorted at a time in a task
PIECE_BYTES = 1 << 20
SAMPLE_ANCHORS = 20_000  # anchors that choose the splitters, wherever they are
RIGHT_FIRST, LEFT_FIRST = 0, 1

_BASE = 6364136223846793005
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, base, np.uint64))


def core_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the CORE bytes from each place."""
    n = len(raw)
    if n < CORE:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n))])
        h = (sums[CORE:] - sums[:-CORE]) * _powers(pow(_BASE, -1, 1 << 64), n - CORE + 1)
        h ^= h >> np.uint64(32)
        h *= _MIX
        return h ^ (h >> np.uint64(29))


def anchors(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, place, least offset, most offset, core hash) for texts that lie at bounds[i]:bounds[i + 1] of `raw`."""
    return chosen_places(core_hashes(raw), bounds, WINDOW, PLACES)


def chosen_places(h: np.ndarray, bounds: np.ndarray, window: int, places: int) -> tuple[np.ndarray, ...]:
    """Anchors of windows of `window` units from the hashes of the cores, of which a window holds `places`."""
    none = np.zeros(0, np.int64)
    if len(h) < places:
        return none, none, none, none, none.astype(np.uint64)
    least = (h & ~_LOW) | (_LOW - np.arange(len(h), dtype=np.uint64))
    width = 1
    while 2 * width <= places:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (places - width)], least[places - width :])
    lengths = np.diff(bounds)
    windows = np.maximum(lengths - window + 1, 0)
    text = np.repeat(np.arange(len(lengths)), windows)
    place = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = place + bounds[text]
    chosen = (_LOW - (least[starts] & _LOW)).astype(np.int64)
    if not len(chosen):
        return none, none, none, none, none.astype(np.uint64)
    cut = np.flatnonzero((chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])) + 1
    first, last = np.append(0, cut), np.append(cut, len(chosen)) - 1
    a = chosen[first]
    return text[first], a - bounds[text[first]], a - starts[last], a - starts[first], h[a]


def text_pieces(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, bounds) of pieces of an Arrow column of texts or bytes."""
    whole_column = column.cast(pa.large_binary())
    _, offsets, data = whole_column.buffers()
    at = np.frombuffer(offsets, np.int64)[whole_column.offset : whole_column.offset + len(whole_column) + 1]
    raw, row = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), 0
    while row < len(whole_column):
        end = max(row + 1, int(np.searchsorted(at, at[row] + PIECE_BYTES, side="right")) - 1)
        yield row, raw[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


ANCHORS = "row bigint, place int, least int, most int, core bigint"


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column(0).to_numpy()
        for first, raw, bounds in text_pieces(batch.column(1)):
            text, place, least, most, core = anchors(raw, bounds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[first + text]), pa.array(place.astype(np.int32)), pa.array(least.astype(np.int32)),
                 pa.array(most.astype(np.int32)), pa.array(core.view(np.int64))],
                ["row", "place", "least", "most", "core"],
            )


def _keys(raw: bytes, place: int) -> tuple[bytes, bytes, int, int]:
    """The two keys of an anchor, and how many bytes of text stand to its right and left."""
    right = raw[place : place + WINDOW]
    left = raw[max(0, place - LEFT) : place][::-1]
    r, s = right.ljust(WINDOW, PAD), left.ljust(LEFT, PAD)
    return r + s, r[:CORE] + s + r[CORE:], len(right), len(left)


META = np.dtype([("row", "<i8"), ("place", "<i4"), ("least", "<u2"), ("most", "<u2"), ("right", "<u2"), ("left", "<u2"), ("asks", "u1")])
SENT = "kind int, part int, row bigint, data binary"
RUN, FOUND, EDGE = 0, 1, 2
_SENT = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("row", pa.int64()), ("data", pa.binary())])
#: Decided offsets of an anchor, low to high, and how far an anchor not looked at may still agree (0: all were looked at).
ANSWER = np.dtype([("row", "<i8"), ("place", "<i4"), ("least", "<u2"), ("most", "<u2"), ("low", "<i2"), ("high", "<i2"), ("order", "u1"), ("open", "<u2")])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_SENT)], schema=_SENT)


def _sent_run(keys: list[bytes], metas: np.ndarray, kept_shared: list[int] | None = None) -> bytes:
    head = frontcode.encode(keys, kept_shared or frontcode.prefixes(keys))
    return len(head).to_bytes(4, "little") + head + zstandard.compress(metas.tobytes(), 1)


def _opened(data: bytes) -> tuple[bytes, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    return data[4 : 4 + n], np.frombuffer(zstandard.decompress(data[4 + n :]), META)


class _Runs:
    """Sorts the suffixes of a task, run by run."""

    def __init__(self, splitters: list[list[bytes]], parts: int) -> None:
        self.splitters, self.parts = splitters, parts
        self.keys: tuple[list[bytes], list[bytes]] = ([], [])
        self.metas: list[tuple] = []

    def add(self, row: int, raw: bytes, places, leasts, mosts) -> None:
        for place, least, most in zip(places, leasts, mosts, strict=True):
            one, two, right, left = _keys(raw, place)
            self.keys[0].append(one)
            self.keys[1].append(two)
            self.metas.append((row, place, least, most, right, left, 1))

    def flush(self) -> list[tuple]:
        out, metas = [], np.array(self.metas, META)
        for order, keys in enumerate(self.keys):
            ranked = sorted(range(len(keys)), key=keys.__getitem__)
            folded, settled = [], []
            for i in ranked:
                if folded and keys[folded[-1]] == keys[i]:
                    settled += [folded[-1], i]
                else:
                    folded.append(i)
            # Copies that met here repeat as a whole; one of them goes on as a partner for others.
            metas["asks"] = 1
            metas["asks"][settled] = 0
            if order == RIGHT_FIRST and settled:
                own = np.unique(settled)
                answers = np.zeros(len(own), ANSWER)
                for name in ("row", "place", "least", "most"):
                    answers[name] = metas[name][own]
                answers["low"], answers["high"] = answers["least"], answers["most"]
                out.append((FOUND, int(metas["row"][own[0]] % self.parts), 0, zstandard.compress(answers.tobytes(), 1)))
            at = 0
            sorted_keys = [keys[i] for i in folded]
            for part, splitter in enumerate([*self.splitters[order], None]):
                end = bisect_right(sorted_keys, splitter, at) if splitter is not None else len(folded)
                if end > at:
                    out.append((RUN, order * self.parts + part, 0, _sent_run(sorted_keys[at:end], metas[folded[at:end]])))
                at = end
        self.keys, self.metas = ([], []), []
        return out


def _sorter(splitters: list[list[bytes]], parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs(splitters, parts)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("row", "text", "places", "leasts", "mosts")]
            for row, text, places, leasts, mosts in zip(*columns, strict=True):
                raw = zstandard.decompress(text)
                for at in range(0, len(places), RUN_KEYS):
                    some = slice(at, at + RUN_KEYS)
                    runs.add(row, raw, places[some], leasts[some], mosts[some])
                    if len(runs.metas) >= RUN_KEYS:
                        yield _batch(runs.flush())
        if runs.metas:
            yield _batch(runs.flush())

    return run


def _agree(order: int, shared: int, a: bytes, b: bytes, x, y) -> tuple[int, int]:
    """(left, right) bytes that two anchors share, from what their keys share."""
    if order == RIGHT_FIRST:
        right = min(shared, WINDOW)
        left = shared - WINDOW if shared >= WINDOW else frontcode.common(a[WINDOW:], b[WINDOW:])
    else:
        left = min(shared - CORE, LEFT)
        right = CORE + (shared - CORE - LEFT if shared >= CORE + LEFT else frontcode.common(a[CORE + LEFT :], b[CORE + LEFT :]))
    return min(left, x["left"], y["left"]), min(right, x["right"], y["right"])


class _Scan:
    """Neighbours in one order and what they decide."""

    def __init__(self, order: int, keys: list[bytes], shared: list[int], metas: list[dict], reach: int) -> None:
        self.order, self.keys, self.shared, self.metas, self.reach = order, keys, shared, metas, reach
        self.found: list[set[tuple[int, int]]] = [set() for _ in keys]
        self.open = [0] * len(keys)

    def pairs(self, crossing: int | None = None) -> None:
        """Meet all neighbours within reach, or only those on different sides of a place."""
        low_end = 0 if crossing is None else crossing
        for i in range(max(1, low_end), len(self.keys)):
            run = WIDTH
            if crossing is not None and i - crossing >= self.reach:
                break
            for j in range(i - 1, max(-1, i - self.reach - 1), -1):
                run = min(run, self.shared[j + 1])
                if run < CORE:
                    break
                if crossing is not None and j >= crossing:
                    continue
                x, y = self.metas[i], self.metas[j]
                if not (x["asks"] or y["asks"]):
                    continue
                left, right = _agree(self.order, run, self.keys[i], self.keys[j], x, y)
                for n, m in ((i, x), (j, y)):
                    low, high = max(m["least"], WINDOW - right), min(m["most"], left)
                    if m["asks"] and low <= high:
                        self.found[n].add((low, high))

    def limits(self, first: bool, last: bool) -> tuple[list[int], list[int]]:
        """Mark how far anchors beyond reach may agree. Returns the places whose reach ends at the start and at the end of the list
        instead; where the list begins or ends the whole order, nothing lies beyond."""
        n, before, after = len(self.keys), [], []
        padded = np.array(self.shared + [0], np.int64)
        for i in range(n):
            lo = i - self.reach
            run = int(padded[max(lo, 1) : i + 1].min()) if i else WIDTH
            if run >= CORE:
                if lo >= 1:
                    self._mark(i, run)
                elif not first:
                    before.append(i)
            hi = i + self.reach + 1
            run = int(padded[i + 1 : min(hi, n - 1) + 1].min()) if i < n - 1 else WIDTH
            if run >= CORE:
                if hi <= n - 1:
                    self._mark(i, run)
                elif not last:
                    after.append(i)
        return before, after

    def _mark(self, i: int, run: int) -> None:
        far = min(run, WINDOW) if self.order == RIGHT_FIRST else min(run - CORE, LEFT) + 1
        self.open[i] = max(self.open[i], far)

    def answers(self) -> bytes | None:
        rows = []
        for m, found, far in zip(self.metas, self.found, self.open, strict=True):
            if m["asks"]:
                own = (m["row"], m["place"], m["least"], m["most"])
                rows += [(*own, low, high, self.order, far) for low, high in _joined(sorted(found))] or ([(*own, 1, 0, self.order, far)] if far else [])
        return zstandard.compress(np.array(rows, ANSWER).tobytes(), 1) if rows else None


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in spans:
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _dicts(metas: np.ndarray) -> list[dict]:
    columns = [metas[n].tolist() for n in META.names]
    return [dict(zip(META.names, values, strict=True)) for values in zip(*columns, strict=True)]


def _merger(parts: int, reach: int):
    """A partition is one range of one order. Other rows pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[tuple[bytes, np.ndarray]] = []
        part = None
        for batch in batches:
            others = []
            for row in batch.to_pylist():
                if row["kind"] == RUN:
                    part = row["part"]
                    runs.append(_opened(row["data"]))
                else:
                    others.append((row["kind"], row["part"], row["row"], row["data"]))
            if others:
                yield _batch(others)
        if runs:
            yield _batch(_merged(part, runs, parts, reach))

    return run


def _merged(part: int, runs: list[tuple[bytes, np.ndarray]], parts: int, reach: int) -> list[tuple]:
    order, number = divmod(part, parts)
    places = [iter(_dicts(m)) for _, m in runs]
    keys, shared, metas = [], [], []
    for s, key, run in frontcode.merge([frontcode.decode(data, WIDTH) for data, _ in runs]):
        keys.append(key)
        shared.append(s)
        metas.append(next(places[run]))
    shared[0] = 0
    scan = _Scan(order, keys, shared, metas, reach)
    scan.pairs()
    scan.limits(number == 0, number == parts - 1)
    out, answers = [], scan.answers()
    if answers:
        out.append((FOUND, part, 0, answers))
    n = len(keys)
    for boundary, side, some in ((part, 0, range(max(0, n - reach - 1), n)), (part - 1, 1, range(min(n, reach + 1)))):
        if 0 <= boundary - order * parts < parts - 1:
            own = np.array([tuple(metas[i][name] for name in META.names) for i in some], META)
            out.append((EDGE, boundary, side, _sent_run([keys[i] for i in some], own)))
    return out


def _stitcher(parts: int, reach: int):
    """Both sides of a boundary, as rows ordered by boundary and side."""

    def close(sides: dict[int, bytes], boundary: int) -> list[tuple]:
        order, number = divmod(boundary, parts)
        keys, metas, crossing = [], [], 0
        for side in (0, 1):
            if side in sides:
                data, own = _opened(sides[side])
                keys += [k for _, k in frontcode.decode(data, WIDTH)]
                metas += _dicts(own)
            if side == 0:
                crossing = len(keys)
        scan = _Scan(order, keys, frontcode.prefixes(keys), metas, reach)
        scan.pairs(crossing)
        # Reach that ended at the range's edge ends here, or at the list's: a short or missing side leaves it open.
        before, after = scan.limits(False, False)
        last_range, first_range = number + 1 == parts - 1, number == 0
        full_right, full_left = len(keys) - crossing > reach, crossing > reach
        for i in after:
            if i < crossing and not full_right and not (last_range and crossing < len(keys)):
                scan._mark(i, min([WIDTH, *scan.shared[i + 1 :]]))
        for i in before:
            if i >= crossing and not full_left and not (first_range and crossing):
                scan._mark(i, min([WIDTH, *scan.shared[1 : i + 1]]))
        answers = scan.answers()
        return [(FOUND, boundary, 0, answers)] if answers else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides = None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if now is not None and row["part"] != now:
                    if out := close(sides, now):
                        yield _batch(out)
                    sides = {}
                now = row["part"]
                sides[row["row"]] = row["data"]
        if now is not None and (out := close(sides, now)):
            yield _batch(out)

    return run


DECIDED = "row bigint, starts array<int>, ends array<int>, open_places array<int>"


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers of a row, ordered by row: removed byte ranges, and anchors with windows that are still open."""

    def close(row: int, answers: list[tuple]) -> tuple:
        by_place: dict[int, list[tuple]] = {}
        for a in answers:
            by_place.setdefault(a[0], []).append(a)
        spans, still = [], []
        for place, own in by_place.items():
            _, least, most, *_ = own[0]
            decided = _joined(sorted((low, high) for _, _, _, low, high, _, _ in own if low <= high))
            spans += [(place - high, place - low + WINDOW) for low, high in decided]
            far = [max([far for *_, order, far in own if order == o], default=0) for o in (RIGHT_FIRST, LEFT_FIRST)]
            if all(far):
                low, high = max(least, WINDOW - far[RIGHT_FIRST]), min(most, far[LEFT_FIRST] - 1)
                for a, b in decided:
                    if low >= a:
                        low = max(low, b + 1)
                    if high <= b:
                        high = min(high, a - 1)
                if low <= high:
                    still.append(place)
        spans = [(a, b + 1) for a, b in _joined([(a, b - 1) for a, b in sorted(spans)])]
        return row, [a for a, _ in spans], [b for _, b in spans], sorted(still)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), *[pa.list_(pa.int32())] * 3]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["row", "starts", "ends", "open_places"])

    now, held, done = None, [], []
    for batch in batches:
        for values in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
            if now is not None and values[0] != now:
                done.append(close(now, held))
                held = []
            now = values[0]
            held.append(values[1:])
        if done:
            yield out(done)
            done = []
    if now is not None:
        yield out([close(now, held)])


def _split_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0).to_pylist():
            a = np.frombuffer(zstandard.decompress(data), ANSWER)
            kinds = {"row": np.int64}
            yield pa.RecordBatch.from_arrays([pa.array(a[n].astype(kinds.get(n, np.int32))) for n in ANSWER.names], list(ANSWER.names))


ANSWERS = "row bigint, place int, least int, most int, low int, high int, order int, open int"


@F.arrow_udf(returnType=BinaryType())
def _squeezed(texts: pa.Array) -> pa.Array:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    return pa.array([squeeze(t) for t in texts.cast(pa.large_binary()).to_pylist()], pa.binary())


def _ranges(n_anchors: int, reach: int, parts: int) -> int:
    """Ranges of one order: as many as the session has partitions, but each much longer than the reach."""
    return max(1, min(parts, n_anchors // (8 * (reach + 1))))


def _splitters(joined: DataFrame, n_anchors: int, parts: int) -> list[list[bytes]]:
    """Range ends of both orders from a sample of about SAMPLE_ANCHORS anchors. They decide where suffixes are sorted, never which."""
    share = int(min(1.0, SAMPLE_ANCHORS / max(1, n_anchors)) * 1_000_000) + 1

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = []
            for text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = zstandard.decompress(text)
                pairs += [_keys(raw, p)[:2] for p in places]
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], ["a", "b"])

    drawn = joined.filter(F.pmod(F.xxhash64("row"), F.lit(1_000_000)) < share).select("text", "places")
    found = drawn.mapInArrow(keys, "a binary, b binary").collect()
    out = []
    for column in ("a", "b"):
        ordered = sorted(bytes(r[column]) for r in found)
        out.append([ordered[len(ordered) * i // parts] for i in range(1, parts)] if ordered else [PAD * WIDTH] * (parts - 1))
    return out


def numbered(df: DataFrame, text: str = "text") -> DataFrame:
    """(row, text): whole texts under the numbers of their rows."""
    return df.select(F.monotonically_increasing_id().alias("row"), whole(df, text).alias("text"))


def _with_texts(texts: DataFrame, kept: DataFrame, beside: DataFrame | None = None) -> DataFrame:
    """(row, text, places, leasts, mosts): texts beside their anchors. A row has as many as its text is long.
    The rows and columns of `beside` are there too; places are null where a row has no anchors."""
    lists = kept.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "least", "most"))).alias("a"))
    lists = lists.select("row", *[F.col(f"a.{c}").alias(f"{c}s") for c in ("place", "least", "most")])
    if beside is not None:
        lists = lists.join(beside, "row", "full")
    return texts.join(lists, "row")


def _passed(joined: DataFrame, n_anchors: int, reach: int) -> DataFrame:
    """One sort of anchors beside their texts: rows of kind FOUND."""
    spark = joined.sparkSession
    parts = _ranges(n_anchors, reach, partitions(spark))
    sent = joined.mapInArrow(_sorter(_splitters(joined, n_anchors, parts), parts), SENT)
    merged = cut_lineage(sent.repartitionById(2 * parts, F.col("part")).mapInArrow(_merger(parts, reach), SENT), "merged")
    edges = merged.filter(F.col("kind") == EDGE).repartition(2 * parts, "part").sortWithinPartitions("part", "row")
    return merged.filter(F.col("kind") == FOUND).unionByName(edges.mapInArrow(_stitcher(parts, reach), SENT))


def _answers(found: DataFrame) -> DataFrame:
    return found.filter(F.col("kind") == FOUND).select("data").mapInArrow(_split_answers, ANSWERS)


def _decided(answers: DataFrame, parts: int) -> DataFrame:
    ordered = answers.repartition(parts, "row").sortWithinPartitions("row")
    return ordered.select("row", "place", "least", "most", "low", "high", "order", "open").mapInArrow(_decide, DECIDED)


def repeats(df: DataFrame, text: str = "text", reach: int = REACH, beside: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, spans, texts): the rows of `df` with a number `row`; (row, starts, ends) of the bytes to remove, for rows that have any;
    (row, text) of rows that may have any, compressed. `texts` also has the rows and columns of `beside` (row, ...), so that they need no join of their own."""
    spark = df.sparkSession
    parts = partitions(spark)
    rows = df.withColumn("row", F.monotonically_increasing_id())
    texts = numbered(df, text)
    found = cut_lineage(texts.mapInArrow(_find_anchors, ANCHORS), "anchors")
    # Written before it is joined: a join of two plain shuffles is one whose large partitions Spark can split.
    cores = cut_lineage(found.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1").select("core"), "cores")
    kept = cut_lineage(found.join(cores, "core", "left_semi"), "kept")
    held = cut_lineage(_with_texts(texts.select("row", _squeezed("text").alias("text")), kept, beside), "held")
    anchored = held.filter("places is not null").select("row", "text", "places", "leasts", "mosts")
    done = cut_lineage(_passed(anchored, kept.count(), reach), "found")
    # Written once: the rounds below read the answers several times.
    answers = cut_lineage(_answers(done), "answers")
    decided = cut_lineage(_decided(answers, parts), "decided")
    while decided.filter(F.size("open_places") > 0).head(1):
        # Some anchors have more neighbours than were met. All that share a core with one are sorted again, with a longer reach.
        reach *= 16
        open_places = decided.select("row", F.explode("open_places").alias("place"))
        again = kept.join(open_places, ["row", "place"]).select("core").distinct()
        some = cut_lineage(kept.join(again, "core", "left_semi").drop("core"), "again")
        more = cut_lineage(_passed(_with_texts(held.select("row", "text"), some), some.count(), reach), "found")
        # What was decided stays; how far others may agree is told anew.
        asked = answers.join(some.select("row", "place", F.lit(True).alias("asked")), ["row", "place"], "left")
        rest = asked.withColumn("open", F.when(F.col("asked"), F.lit(0)).otherwise(F.col("open"))).drop("asked")
        answers = cut_lineage(rest.unionByName(_answers(more)), "answers")
        decided = cut_lineage(_decided(answers, parts), "decided")
    return rows, decided.filter(F.size("starts") > 0).select("row", "starts", "ends"), held.drop("places", "leasts", "mosts")


def cut_out(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(row, kept, n_removed, n_spans): what is left of the texts that lose bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("row", "text", "starts", "ends")]
            rows, kept, removed, number = [], [], [], []
            for row, text, starts, ends in zip(*columns, strict=True):
                raw = zstandard.decompress(text)
                rows.append(row)
                kept.append(b"".join(raw[i:j] for i, j in zip([0, *ends], [*starts, len(raw)], strict=True)))
                removed.append(sum(ends) - sum(starts))
                number.append(len(starts))
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip((rows, kept, removed, number), kinds, strict=True)], ["row", "kept", "n_removed", "n_spans"]
            )

    return texts.select("row", "text").join(spans, "row").mapInArrow(cut, "row bigint, kept binary, n_removed bigint, n_spans bigint")
