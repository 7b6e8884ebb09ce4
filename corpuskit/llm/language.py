"""Language identification by fusing evidence: text likelihood, declared language, address suffix and host.

The text likelihood is a naive Bayes model over hashed byte 4-grams, fitted on a bounded sample of labelled rows (`FIT_ROWS`,
the only bounded thing here). All other statistics cover every row: the languages that texts point to are counted by declared
language, by address suffix and by host in partially aggregated groups. Host priors are smoothed towards the prior of the suffix, and that
towards the prior of all rows, so a host with few pages borrows strength and one with many speaks for itself. The posterior
is the normalised product of text likelihood, P(declared | language) and host prior.

A text is rejected (`und`) if it has no letters, if no language explains it better than a uniform guess over
n-grams would, or if the posterior is below `CONFIDENCE`. Null texts count as empty; a null host, suffix or declared language
is a value of its own ("" - it adds no vote for a language by itself). A text is read whole. Ties go to the language listed first.
Host priors are broadcast only if their number was counted and is at most `BROADCAST_HOSTS`; else they are joined by a shuffle.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.frames import beside, whole
from corpuskit.session import cut_lineage

LANGUAGES = ("en", "fr", "de", "es")
FIT_ROWS = 20_000
BUCKET_BITS = 15
TEMPER = 0.1  # neighbouring n-grams are not independent: each counts as a tenth of one
MOST_GRAMS = 400  # texts beyond this many n-grams are as sure as one of this many
SMOOTH = 0.05
HOST_WEIGHT, SUFFIX_WEIGHT, DECLARED_WEIGHT = 20.0, 50.0, 5.0  # rows that a parent's prior counts for
CONFIDENCE = 0.5
BROADCAST_HOSTS = 50_000
PIECE_BYTES = 1 << 20

_LETTERS = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256)).lower()
_UNLIKE = math.log(1 << BUCKET_BITS)


@dataclass
class Model:
    languages: tuple[str, ...]
    logs: np.ndarray  # one row per language, one column per bucket
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each 4-gram, where each text's begin, letters of each text). Blanks stand around each text."""
    raw = [t.encode("utf-8", "surrogatepass").translate(_LETTERS) for t in texts]
    letters = np.array([len(r) - r.count(b" ") for r in raw], np.int64)
    padded = [b" " + b" ".join(r.split()) + b"   " for r in raw]
    flat = np.frombuffer(b"".join(padded), np.uint8).astype(np.uint32)
    four = flat[:-3] | (flat[1:-2] << 8) | (flat[2:-1] << 16) | (flat[3:] << 24)
    starts = np.cumsum([0, *map(len, padded)])[:-1]
    return (four * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS), starts, letters


def _pieces(texts: list[str]):
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= PIECE_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def fit(df: DataFrame, text: str, label: str, languages: Sequence[str] = LANGUAGES, rows: int = FIT_ROWS) -> Model:
    """A model from about `rows` labelled rows, drawn by a hash of the text. Without rows, every language is equally likely."""
    known = df.filter(df[label].isin(*languages) & df[text].isNotNull()).select(F.col(label).alias("label"), F.col(text).alias("text"))
    share = min(1.0, rows / max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(share * 1_000_000))
    size = 1 << BUCKET_BITS

    def count(batches):
        totals = np.zeros((len(languages), size), np.int64)
        for batch in batches:
            labels = batch.column(0).to_pylist()
            for i, language in enumerate(languages):
                own = [t for t, kind in zip(batch.column(1).to_pylist(), labels, strict=True) if kind == language]
                for piece in _pieces(own):
                    totals[i] += np.bincount(_grams(piece)[0], minlength=size)
        place = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(totals.ravel()[place], pa.int64())], ["place", "n"])

    counted = drawn.mapInArrow(count, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    totals = np.zeros(len(languages) * size, np.float64)
    for row in counted.collect():  # languages x buckets at most
        totals[row["place"]] = row["n"]
    totals = totals.reshape(len(languages), size) + SMOOTH
    return Model(tuple(languages), np.log(totals / totals.sum(axis=1, keepdims=True)).astype(np.float32))


_HELD: dict[str, np.ndarray] = {}


def likelihoods(df: DataFrame, model: Model, text: str = "text") -> Column:
    """A struct: `logs` (tempered log likelihood by language), `letters`, `gain` (best mean log likelihood over a uniform guess)."""
    held, name = df.sparkSession.sparkContext.broadcast(model.logs), model.name
    kind = "struct<logs:array<double>,letters:bigint,gain:double>"

    @F.arrow_udf(returnType=kind)
    def score(texts: pa.Array) -> pa.Array:
        logs = _HELD.setdefault(name, held.value)
        out, letters, gain = [], [], []
        for piece in _pieces(texts.to_pylist()):
            buckets, starts, own = _grams(piece)
            sizes = np.maximum(np.diff(np.append(starts, len(buckets))), 1)
            sums = np.stack([np.add.reduceat(row[buckets], starts, dtype=np.float64) for row in logs], axis=1)
            mean = sums / sizes[:, None]
            out.append(mean * (np.minimum(sizes, MOST_GRAMS) * TEMPER)[:, None])
            letters.append(own)
            gain.append(mean.max(axis=1) + _UNLIKE)
        flat = np.concatenate(out) if out else np.zeros((0, len(logs)))
        arrays = pa.ListArray.from_arrays(
            pa.array(np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]), pa.array(flat.ravel(), pa.float64())
        )
        return pa.StructArray.from_arrays(
            [arrays, pa.array(_joined(letters, np.int64)), pa.array(_joined(gain, np.float64))], ["logs", "letters", "gain"]
        )

    return score(whole(df, text))


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)


def _declared(column: Column, languages: Sequence[str]) -> Column:
    """The primary subtag of a declared language: a known one, "other", or "" if there is none."""
    tag = F.lower(F.trim(F.element_at(F.split(F.coalesce(column.cast("string"), F.lit("")), "[-_]"), 1)))
    return F.when(tag.isin("", *languages), tag).otherwise("other")


def _vote(logs: Column, languages: Sequence[str]) -> Column:
    """1 at the language that the text points to, 0 elsewhere."""
    return F.array_position(logs, F.array_max(logs)).cast("int")


def _counts(languages: Sequence[str]) -> list[Column]:
    return [F.sum((F.col("vote") == i + 1).cast("double")).alias(f"n{i}") for i in range(len(languages))]


def _smoothed(own: list[str], parent: list[Column], weight: float) -> Column:
    total = sum((F.col(c) for c in own), F.lit(0.0))
    return F.array(*[(F.col(c) + F.lit(weight) * p) / (total + weight) for c, p in zip(own, parent, strict=True)])


def priors(scored: DataFrame, languages: Sequence[str]) -> tuple[DataFrame, dict[str, list[float]]]:
    """(host, suffix, prior) over all rows, and the log of P(declared | language) for each declared value.

    `scored` has host, suffix, declared (never null) and vote (1-based language; null if the text has no letters).
    """
    n, names = len(languages), [f"n{i}" for i in range(len(languages))]
    hosts = scored.groupBy("suffix", "host").agg(*_counts(languages)).na.fill(0.0, names)
    suffixes = hosts.groupBy("suffix").agg(*[F.sum(c).alias(c) for c in names])
    total = hosts.agg(*[F.sum(c).alias(c) for c in names])
    # One row of numbers: it is collected and stands in the plan as constants.
    row = total.first()
    sums = [row[c] or 0.0 for c in names]
    root = [F.lit((x + 1.0 / n) / (sum(sums) + 1.0)) for x in sums]
    of_suffix = suffixes.select("suffix", _smoothed(names, root, SUFFIX_WEIGHT).alias("parent"))
    of_host = hosts.join(of_suffix, "suffix").select(
        "host", "suffix", _smoothed(names, [F.col("parent")[i] for i in range(n)], HOST_WEIGHT).alias("prior")
    )
    values = ["", "other", *languages]
    seen = {r["declared"]: [r[c] or 0.0 for c in names] for r in scored.groupBy("declared").agg(*_counts(languages)).collect()}
    columns = [sum(seen.get(v, [0.0] * n)[i] for v in values) for i in range(n)]
    logs = {
        v: [math.log((seen.get(v, [0.0] * n)[i] + DECLARED_WEIGHT / len(values)) / (columns[i] + DECLARED_WEIGHT)) for i in range(n)]
        for v in values
    }
    return of_host, logs


def evidence(df: DataFrame, model: Model, text: str, declared: Column, host: Column, suffix: Column) -> DataFrame:
    """Add the struct `__e` with what the fusion needs."""
    scored = beside(df.withColumns({"__d": declared, "__h": host, "__s": suffix}), F.struct(likelihoods(df, model, text).alias("__l")), ["__l"])
    own = F.struct(
        F.col("__l.logs").alias("logs"),
        F.col("__l.letters").alias("letters"),
        F.col("__l.gain").alias("gain"),
        F.when(F.col("__l.letters") > 0, _vote(F.col("__l.logs"), model.languages)).alias("vote"),
        _declared(F.col("__d"), model.languages).alias("declared"),
        F.coalesce(F.lower("__h"), F.lit("")).alias("host"),
        F.coalesce(F.lower("__s"), F.lit("")).alias("suffix"),
    )
    return scored.withColumn("__e", own).drop("__d", "__h", "__s", "__l")


def fused(df: DataFrame, evidences: DataFrame, languages: Sequence[str] = LANGUAGES, most_broadcast: int = BROADCAST_HOSTS) -> DataFrame:
    """Add language, confidence and accepted to rows with `__e`; `evidences` has the `__e` of all rows."""
    of_host, declared_logs = priors(evidences.select("__e.*"), languages)
    n = len(languages)
    small = of_host.limit(most_broadcast + 1).count() <= most_broadcast
    table = of_host.select(F.struct("suffix", "host").alias("__key"), F.col("prior").alias("__prior"))
    keyed = df.withColumn("__key", F.struct("__e.suffix", "__e.host"))
    joined = keyed.join(F.broadcast(table) if small else table, "__key", "left")
    by_declared = F.coalesce(
        *[F.when(F.col("__e.declared") == v, F.array(*map(F.lit, logs))) for v, logs in declared_logs.items()]
    )
    joined = joined.withColumn("__declared", by_declared)
    parts = [F.col("__e.logs")[i] + F.col("__declared")[i] + F.log(F.col("__prior")[i]) for i in range(n)]
    joined = joined.withColumn("__total", F.array(*parts)).withColumn("__best", F.array_max("__total"))
    weight = sum((F.exp(F.col("__total")[i] - F.col("__best")) for i in range(n)), F.lit(0.0))
    joined = joined.withColumn("confidence", 1.0 / weight)
    found = F.element_at(F.array(*map(F.lit, languages)), F.array_position("__total", F.col("__best")).cast("int"))
    good = (F.col("__e.letters") > 0) & (F.col("__e.gain") > 0) & (F.col("confidence") >= CONFIDENCE)
    out = joined.withColumn("accepted", F.coalesce(good, F.lit(False)))
    out = out.withColumn("language", F.when(F.col("accepted"), found).otherwise("und"))
    return out.drop("__e", "__key", "__prior", "__declared", "__total", "__best")


def kept(df: DataFrame) -> DataFrame:
    """The evidence written to the shared folder, so that texts are scored once for the counts and the fusion."""
    return cut_lineage(df, "evidence")
