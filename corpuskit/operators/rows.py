"""Row numbers, chunks, splits and caps that no single task has to hold.

A plain `row_number()` over a whole table, or over one hot group, sorts everything in one task. Here the order
is cut into slices first: a row's position is its position in its slice plus the size of the slices before it. Slice
sizes come from a partially aggregated count, and only (groups x slices) of them exist.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpuskit.functions.hashing import draw_hex, draw_int

SLICE, GROUP = "__slice", "__group"
FIRST = -1.0  # the slice of rows without a key
TEXT_SAMPLE = 50  # sampled texts per slice that choose the cut points of a text key
DRAW_DIGITS = 32
CUT_DIGITS = 3  # of the draw, counted at a time
CUT_ROWS = 1000  # rows among which a cut is looked for one by one
DIRECT_CAP = 100  # up to this rank a hot group receives few rows per task even from very many tasks


def slice_count(df: DataFrame) -> int:
    """As many slices as the session has shuffle partitions, so that slices grow with the cluster."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def _text_cuts(df: DataFrame, key: str, n: int) -> list[str]:
    """About `n` cut points of a text key: weighted quantiles of the distinct keys in a hashed sample."""
    total = df.count()
    share = int(min(1.0, TEXT_SAMPLE * n / max(1, total)) * 1_000_000) + 1
    drawn = df.where(F.col(key).isNotNull() & (F.pmod(F.xxhash64(key), F.lit(1_000_000)) < share))
    weighed = sorted((r[0].encode(), r[1]) for r in drawn.groupBy(key).count().collect())
    whole, before, cuts = sum(w for _, w in weighed), 0, []
    for text, weight in weighed:
        if before * n // max(1, whole) != (before + weight) * n // max(1, whole):
            cuts.append(text.decode())
        before += weight
    return cuts


def _text_slice(key: Column, cuts: Sequence[str], first: int = 0) -> Column:
    """How many cuts are at or below a text: a binary search as nested conditions."""
    if not cuts:
        return F.lit(float(first))
    middle = len(cuts) // 2
    below, above = _text_slice(key, cuts[:middle], first), _text_slice(key, cuts[middle + 1 :], first + middle + 1)
    return F.when(key < cuts[middle], below).otherwise(above)


def sliced_by_value(df: DataFrame, key: str, slices: int | None = None) -> DataFrame:
    """Add the slice of a number, time or text key. The cut points are quantiles: a number per slice, or `TEXT_SAMPLE` texts per
    slice, reach the driver. Rows without a key share the first slice, as Spark sorts them first."""
    n = slices or slice_count(df)
    if isinstance(df.schema[key].dataType, StringType):
        cut = _text_slice(F.col(key), _text_cuts(df, key, n))
        return df.withColumn(SLICE, F.when(F.col(key).isNull(), FIRST).otherwise(cut))
    as_double = df.withColumn("__key", F.col(key).cast("double"))
    cuts = as_double.stat.approxQuantile("__key", [i / n for i in range(1, n)], 0.25 / n)
    inner = sorted(set(cuts))
    if not inner:
        return df.withColumn(SLICE, F.when(F.col(key).isNull(), FIRST).otherwise(0.0))
    splits = [float("-inf"), *inner, float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol="__key", outputCol=SLICE, handleInvalid="keep")
    return bucketizer.transform(as_double).drop("__key").withColumn(SLICE, F.coalesce(SLICE, F.lit(FIRST)))


def sliced_by_draw(df: DataFrame, draw: str, slices: int | None = None) -> DataFrame:
    """Add the slice of a hex draw. Draws are uniform, so equal ranges of them are equal slices."""
    n = slices or slice_count(df)
    prefix = F.conv(F.substring(F.col(draw), 1, 6), 16, 10).cast("bigint")
    return df.withColumn(SLICE, F.floor(prefix * n / F.lit(16**6)))


def _slice_offsets(grouped: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """(keys, __offset): total of the earlier slices of the same group."""
    sized = grouped.groupBy(*keys).agg(F.sum(value).alias("__part"))
    before = Window.partitionBy(*keys[:-1]).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return sized.select(*keys, F.coalesce(F.sum("__part").over(before), F.lit(0)).alias("__offset"))


def running_total(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], value: Column, name: str) -> DataFrame:
    """Sum of `value` over the earlier rows of the group (this row not counted).

    `df` carries a slice column that never decreases along `order`, and `order` is unique within a group.
    """
    # One struct holds the group, so that null groups match by plain equality and all steps share one partitioning.
    group = [F.struct(*by).alias(GROUP)] if by else []
    keys = [GROUP, SLICE] if by else [SLICE]
    grouped = df.select("*", *group)
    offsets = _slice_offsets(grouped, keys, value)
    if not by:
        offsets = F.broadcast(offsets)  # one row per slice, so at most the number of slices
    here = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = grouped.withColumn("__local", F.coalesce(F.sum(value).over(here), F.lit(0)))
    joined = local.join(offsets, keys).withColumn(name, F.col("__local") + F.col("__offset"))
    return joined.select(*df.drop(SLICE).columns, name)


def index_by_key(
    df: DataFrame, key: str, by: Sequence[str] = (), name: str = "idx", slices: int | None = None
) -> DataFrame:
    """0-based position in the order of a unique key, within the group. Rows without a key come first, in no fixed order."""
    return running_total(sliced_by_value(df, key, slices), by, [key], F.lit(1).cast("bigint"), name)


def index_by_draw(
    df: DataFrame,
    seed: str,
    key: str,
    by: Sequence[str] = (),
    name: str = "idx",
    keep_draw: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """0-based position in a seeded shuffle of the rows, within the group. `key` is unique."""
    drawn = df.withColumn("__draw", draw_hex(seed, key))
    out = running_total(sliced_by_draw(drawn, "__draw", slices), by, ["__draw", key], F.lit(1).cast("bigint"), name)
    return out if keep_draw else out.drop("__draw")


def string_ids(df: DataFrame, key: str, name: str = "id") -> DataFrame:
    return index_by_key(df, key, name=name).withColumn(name, F.col(name).cast("string"))


def chunked(df: DataFrame, key: str, size: int, by: Sequence[str] = (), name: str = "chunk") -> DataFrame:
    """Number of the fixed-size block a row falls into, counting in key order."""
    return index_by_key(df, key, by, name="__idx").withColumn(name, F.floor(F.col("__idx") / size)).drop("__idx")


def round_robin(df: DataFrame, key: str, n: int, name: str = "endpoint") -> DataFrame:
    return index_by_key(df, key, name="__idx").withColumn(name, F.pmod("__idx", F.lit(n))).drop("__idx")


def call_slots(df: DataFrame, key: str, endpoints: int, per_second: int) -> DataFrame:
    """Endpoint by turns, and the second in which the call may start."""
    turn = F.floor(F.col("__idx") / endpoints)
    return (
        index_by_key(df, key, name="__idx")
        .withColumn("endpoint", F.pmod("__idx", F.lit(endpoints)))
        .withColumn("second", F.floor(turn / per_second))
        .drop("__idx")
    )


def daily_quota(df: DataFrame, key: str, quota: int, name: str = "day") -> DataFrame:
    """Day on which a row is due when each day takes `quota` rows; null when nothing may ever run."""
    if quota <= 0:
        return df.withColumn(name, F.lit(None).cast("bigint"))
    return chunked(df, key, quota, name=name)


def within_error_budget(df: DataFrame, by: Sequence[str], key: str, failed: Column, budget: int) -> DataFrame:
    """Add the failures seen before each row and whether the row is still attempted."""
    marked = sliced_by_value(df.withColumn("__failed", failed.cast("bigint")), key)
    out = running_total(marked, by, [key], F.col("__failed"), "failures_before")
    return out.drop("__failed").withColumn("attempted", F.col("failures_before") < budget)


def sampled_per_group(df: DataFrame, by: Sequence[str], seed: str, key: str, cap: int) -> DataFrame:
    """At most `cap` rows of each group, drawn by hash.

    Small caps are one ranked window, of which Spark keeps `cap` rows per group and task before the shuffle. For larger ones
    only the slices that begin below the cap are ranked; the other rows are dropped by a join on the slice counts.
    """
    if cap <= DIRECT_CAP:
        w = Window.partitionBy(*by).orderBy(draw_hex(seed, key), key)
        return df.withColumn("__idx", F.row_number().over(w)).where(F.col("__idx") <= cap).drop("__idx")
    drawn = sliced_by_draw(df.withColumn("__draw", draw_hex(seed, key)), "__draw").withColumn(GROUP, F.struct(*by))
    keys = [GROUP, SLICE]
    begun = _slice_offsets(drawn, keys, F.lit(1).cast("bigint")).where(F.col("__offset") < cap)
    near = drawn.join(begun, keys)
    w = Window.partitionBy(*keys).orderBy("__draw", key)
    ranked = near.withColumn("__idx", F.row_number().over(w) + F.col("__offset")).where(F.col("__idx") <= cap)
    return ranked.select(*df.columns)


def draw_cut(df: DataFrame, seed: str, key: str, n: int) -> tuple[str, object, int] | None:
    """(draw, key, extra): the n-th row of a seeded shuffle, and how many rows equal to it belong to the first n. None if there are fewer rows.

    Rows are counted by the first digits of their draws; the digits that hold the n-th row are counted by their next ones, until few
    rows are left. What reaches the driver are `4096` counts a step, and then those few keys.
    """
    drawn, prefix, left = df.select(draw_hex(seed, key).alias("d"), F.col(key).alias("k")), "", n
    while True:
        inside = drawn.where(F.col("d").startswith(prefix)) if prefix else drawn
        digits = F.substring("d", len(prefix) + 1, CUT_DIGITS).alias("digits")
        counts = sorted((r["digits"], r["count"]) for r in inside.groupBy(digits).count().collect())
        for found, count in counts:
            if left <= count:
                break
            left -= count
        else:
            return None
        prefix += found
        if count <= CUT_ROWS or len(prefix) >= DRAW_DIGITS:
            break
    # Rows of one key are one entry, however many there are.
    last = drawn.where(F.col("d").startswith(prefix)).groupBy("d", "k").count().collect()
    for draw, value, count in sorted(last, key=lambda r: (r["d"], r["k"] is not None, r["k"])):
        if left <= count:
            return draw, value, left if left < count else 0
        left -= count
    raise AssertionError("the counts of draws do not add up")


def shuffled_head(df: DataFrame, seed: str, key: str, n: int) -> DataFrame:
    """The first `n` rows of a seeded shuffle, for any n: the cut is found by counting, and every task keeps its rows before it.

    Rows of one key are equal in the shuffle; if the cut falls among them, any of them fill the sample up.
    """
    cut = draw_cut(df, seed, key, n) if n > 0 else ("", None, 0)
    if cut is None:
        return df
    draw, value, extra = cut
    own, drawn = F.col(key), draw_hex(seed, key)
    same = (drawn == draw) & own.eqNullSafe(F.lit(value))
    before = (drawn < draw) | ((drawn == draw) & F.coalesce(own < F.lit(value), own.isNull() & F.lit(value is not None)))
    if not extra:
        return df.where(before | same)
    return df.where(before).unionByName(df.where(same).limit(extra))


def nested_samples(df: DataFrame, seed: str, key: str, sizes: Sequence[int]) -> DataFrame:
    """Samples of several sizes from one shuffle, as (size, row): each holds the smaller ones. `key` is unique."""
    cuts = [(size, draw_cut(df, seed, key, size)) for size in sorted(sizes) if size > 0]
    drawn = draw_hex(seed, key)
    inside = [F.when(F.lit(True) if cut is None else (drawn < cut[0]) | ((drawn == cut[0]) & (F.col(key) <= F.lit(cut[1]))), F.lit(size)) for size, cut in cuts]
    return df.withColumn("size", F.explode(F.array_compact(F.array(*inside))))


def split_by_ratio(df: DataFrame, seed: str, key: str, test_percent: int) -> DataFrame:
    """Row-wise split: no shuffle, and a row keeps its side when others come or go."""
    side = F.when(draw_int(seed, key) % 100 < test_percent, "test").otherwise("train")
    return df.withColumn("split", side)


def split_by_count(df: DataFrame, seed: str, key: str, test_rows: int) -> DataFrame:
    side = F.when(F.col("__idx") < test_rows, "test").otherwise("train")
    return index_by_draw(df, seed, key, name="__idx").withColumn("split", side).drop("__idx")


def same_source_batches(df: DataFrame, by: str, key: str, size: int) -> DataFrame:
    """Batch id such that a batch never mixes sources."""
    numbered = chunked(df, key, size, by=[by], name="__n")
    return numbered.withColumn("batch", F.concat_ws("-", F.col(by), F.col("__n").cast("string"))).drop("__n")


def top_per_key(df: DataFrame, by: Sequence[str], score: str, tie: str, k: int, name: str = "rank") -> DataFrame:
    """Best `k` rows per key; Catalyst keeps only `k` per key and task before the shuffle."""
    w = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(tie))
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
