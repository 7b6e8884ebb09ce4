"""Calls to an outside service, made inside tasks by a function the user supplies.

Python runs here only because the call itself is Python. Everything around it (dedupe, cache lookup, quota, order of
work, resume) is DataFrame work and happens before or after.
"""

from __future__ import annotations

import functools
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpuskit.operators import rows
from corpuskit.session import cut_lineage, scratch_path
from corpuskit.sources import files, keyed

RESULT = "result string, status string, attempts int, error string"
WAVE_BYTES = 64 << 20  # of an endpoint's texts that one task takes


@dataclass(frozen=True)
class CallPolicy:
    """How one task calls: threads at once, calls per second (None: no limit), tries per row.

    Only errors of the types `retry_on` are tried again, after `wait` seconds and twice as long each time; others fail at once.
    """

    concurrency: int = 4
    per_second: float | None = None
    tries: int = 3
    retry_on: tuple[type[Exception], ...] = (Exception,)
    wait: float = 0.0


def _attempt(call: Callable[[], str], policy: CallPolicy) -> tuple[str | None, str, int, str | None]:
    error, attempt = None, 0
    while attempt < policy.tries:
        if attempt and policy.wait:
            time.sleep(policy.wait * 2 ** (attempt - 1))
        attempt += 1
        try:
            return call(), "ok", attempt, None
        except Exception as e:  # the error text is data: it goes into the result row
            error = f"{type(e).__name__}: {e}"
            if not isinstance(e, policy.retry_on):
                break
    return None, "failed", attempt, error


def call_rows(
    df: DataFrame,
    key: str,
    text: str,
    fn: Callable[..., str],
    policy: CallPolicy = CallPolicy(),
    endpoint: str | None = None,
    second: str | None = None,
    wave_bytes: int = WAVE_BYTES,
) -> DataFrame:
    """(key, result, status, attempts, error) for every row. A failing call is a row, not a failed job.

    The rate holds per task, so the total rate is `per_second` times the tasks that run at once: set the number of
    partitions to the concurrency the service allows. With an `endpoint` column, `fn` gets the text and the endpoint, all rows of an
    endpoint are one task, and the rate holds per endpoint on the whole cluster. With a column `second` (as of `rows.call_slots`) rows are
    taken in its order, and a call waits until that many seconds after its task began. Evaluate the result once: write it before using it twice.

    Where an endpoint has more than `wave_bytes` of text, its rows are taken in waves, one after the other, each a job with one task per
    endpoint whose results are written: the rate and the order hold, and no task reads more than a few times that.
    """
    asked = df.select(*dict.fromkeys(c for c in (key, text, endpoint, second) if c is not None))
    if endpoint is None:
        return _called(asked, key, text, fn, policy, None, second)
    waves = _waves(asked, text, endpoint, second, wave_bytes)
    if (waves.agg(F.max(F.col("__wave") + F.col("__parts"))).first()[0] or 1) <= 1:
        return _called(asked, key, text, fn, policy, endpoint, second)
    place = [F.col(endpoint).eqNullSafe(F.col("__endpoint"))]
    if second is None:
        waves = F.broadcast(waves)  # a row per endpoint
    else:
        place.append(F.col(second).eqNullSafe(F.col("__second")))
    part = F.pmod(F.xxhash64(key, text), F.col("__parts"))
    path = scratch_path(df.sparkSession, "waves")
    asked.join(waves, place).select(*asked.columns, (F.col("__wave") + part).alias("__wave")).write.partitionBy("__wave").parquet(path)
    written = df.sparkSession.read.schema(StructType([*asked.schema.fields, StructField("__wave", LongType())])).parquet(path)
    first = F.min(F.lit(None).cast("bigint") if second is None else F.col(second)).alias("base")
    origin, out = 0.0, None
    for row in written.groupBy("__wave").agg(first).orderBy("__wave").collect():
        base, began = row["base"] or 0, time.time()
        wave = written.where(F.col("__wave") == row["__wave"]).drop("__wave")
        done = cut_lineage(_called(wave, key, text, fn, policy, endpoint, second, (origin, base)), "called")
        origin = max(origin, began - base)
        out = done if out is None else out.unionByName(done)
    return out


def _waves(asked: DataFrame, text: str, endpoint: str, second: str | None, wave_bytes: int) -> DataFrame:
    """(__endpoint, __second, __wave, __parts): the first wave of a second's rows, and into how many they are cut by hash. Later seconds have no earlier waves."""
    at = F.lit(None).cast("bigint") if second is None else F.col(second)
    size = F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 16).alias("__bytes")
    sizes = cut_lineage(asked.groupBy(F.col(endpoint).alias("__endpoint"), at.alias("__second")).agg(size), "sizes")
    before = F.sum("__bytes").over(Window.partitionBy("__endpoint").orderBy("__second").rowsBetween(Window.unboundedPreceding, -1))
    wave = F.floor(F.coalesce(before, F.lit(0)) / wave_bytes).alias("__wave")
    return cut_lineage(sizes.select("__endpoint", "__second", wave, F.ceil(F.col("__bytes") / wave_bytes).alias("__parts")), "plan")


def _called(
    asked: DataFrame,
    key: str,
    text: str,
    fn: Callable[..., str],
    policy: CallPolicy,
    endpoint: str | None,
    second: str | None,
    wave: tuple[float, int] | None = None,
) -> DataFrame:
    """The calls of one wave, one task per endpoint. `wave` has the time at which second 0 was, at the earliest, and the wave's first second."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(policy.concurrency) as pool:
            due: dict = {}  # when an endpoint may be called next
            began = time.monotonic()
            rest = 0.0  # the wave before ended with a call
            if wave is not None:
                began += max(wave[0] - time.time(), -wave[1])
                rest = time.monotonic() + 1.0 / policy.per_second if policy.per_second else 0.0
            for batch in batches:
                futures, nothing = [], [None] * len(batch)
                asked = zip(batch[text], batch[endpoint] if endpoint else nothing, batch[second] if second else nothing, strict=True)
                for value, place, slot in asked:
                    if slot is not None:
                        time.sleep(max(0.0, began + slot - time.monotonic()))
                    if policy.per_second:
                        time.sleep(max(0.0, due.get(place, rest) - time.monotonic()))
                        due[place] = max(due.get(place, rest), time.monotonic()) + 1.0 / policy.per_second
                    arguments = (value,) if endpoint is None else (value, place)
                    futures.append(pool.submit(_attempt, functools.partial(fn, *arguments), policy))
                out = pd.DataFrame([f.result() for f in futures], columns=["result", "status", "attempts", "error"])
                out.insert(0, key, batch[key].to_numpy())
                yield out

    key_type = asked.schema[key].dataType.simpleString()
    if endpoint is not None:
        asked = asked.repartition(endpoint)
    if second is not None:
        asked = asked.sortWithinPartitions(second)
    return asked.mapInPandas(run, f"{key} {key_type}, {RESULT}")


def _existing(df: DataFrame, path: str) -> DataFrame | None:
    """The table, or None if nothing was ever written there; any other fault of the table is raised."""
    try:
        return df.sparkSession.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def run_in_blocks(
    df: DataFrame, key: str, block_rows: int, path: str, work: Callable[[DataFrame], DataFrame], max_blocks: int | None = None
) -> DataFrame:
    """Run `work` over blocks of rows in key order, keep each finished block, and skip finished blocks on the next run.

    The numbering is written once below `path`, so a resumed run cuts the same blocks. A block counts as finished when
    its ledger row exists; an unfinished one is overwritten. `block_rows` should be what a cluster does in minutes: the
    driver loops over blocks, never over rows.
    """
    spark = df.sparkSession
    out_path, ledger_path = f"{path}/out", f"{path}/done"
    plan = files.saved_or_built(rows.chunked(df, key, block_rows, name="block"), f"{path}/plan", by="block")
    last = plan.agg(F.max("block")).first()[0]
    done = _existing(df, ledger_path)
    finished = {row["block"] for row in done.collect()} if done is not None else set()
    todo = [b for b in range(0, (last if last is not None else -1) + 1) if b not in finished]
    for block in todo[:max_blocks]:
        part = plan.where(F.col("block") == block).drop("block")
        work(part).write.mode("overwrite").parquet(f"{out_path}/block={block}")
        spark.createDataFrame([(block,)], "block bigint").write.mode("append").parquet(ledger_path)
    return spark.read.parquet(out_path)


def cached_calls(
    df: DataFrame,
    text: str,
    cache_path: str,
    fn: Callable[[str], str],
    min_length: int = 5,
    quota: int | None = None,
    store: str = "all",
    tasks: int = 4,
    policy: CallPolicy = CallPolicy(),
) -> DataFrame:
    """Look texts up in a cache table, call for those it lacks, and join the answers back to the rows.

    Before any call: nulls and texts of `min_length` or fewer characters go, repeats merge, cached texts go, and the first
    `quota` in text order remain (None: all). `store` is "all" (failures are cached too) or "success". The calls are written to
    the cache before they are read, so each is made once. Rows that were not asked have the status `too_short` or `over_quota`;
    with "success", `failed` stands for calls of this run that were not stored.
    """
    if store not in ("all", "success"):
        raise ValueError(f"unknown store policy {store}")
    spark = df.sparkSession
    cache = _existing(df, cache_path)
    wanted = df.where(F.length(text) > min_length).select(text).distinct()
    todo = wanted if cache is None else wanted.join(cache.select(text), text, "left_anti")
    chosen = todo if quota is None else todo.orderBy(text).limit(quota)
    due = cut_lineage(chosen, "due")  # what this run asks for is fixed before it is asked
    called = call_rows(due.repartition(tasks, text).withColumn("__text", F.col(text)), text, "__text", fn, policy)
    if store == "success":
        called = called.where(F.col("status") == "ok")
    called.withColumn("called_at", F.current_timestamp()).write.mode("append").parquet(cache_path)
    answers = keyed.latest_per_key(spark.read.parquet(cache_path), [text], F.struct("called_at", "attempts")).drop("called_at")
    joined = df.join(answers, text, "left").join(due.withColumn("__due", F.lit(True)), text, "left")
    short = F.coalesce(F.length(text), F.lit(0)) <= min_length
    unasked = F.when(short, "too_short").when(F.col("__due"), "failed").otherwise("over_quota")
    return joined.withColumn("status", F.coalesce("status", unasked)).drop("__due")


def run_counters(df: DataFrame, text: str, cache: DataFrame, min_length: int = 5) -> DataFrame:
    """Distinct long enough texts: how many there are, are cached, and are still to do; one row."""
    wanted = df.where(F.length(text) > min_length).select(text).distinct()
    known = cache.select(text).distinct().withColumn("__cached", F.lit(1))
    marked = wanted.join(known, text, "left")
    return marked.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("__cached").alias("cached"),
        F.count_if(F.col("__cached").isNull()).alias("todo"),
    )


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Batches of rows through a pandas function, for what no Column expression can say."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, schema)
