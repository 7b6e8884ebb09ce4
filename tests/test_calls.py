from __future__ import annotations

import sys
import time
from collections import Counter

import pytest
from pyspark import TaskContext, cloudpickle
from pyspark.sql import functions as F

from corpuskit.operators import calls, rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # Python workers cannot import test modules


def shout(text: str) -> str:
    if text.startswith("bad"):
        raise ValueError("no")
    return text.upper()


def test_failures_are_rows(spark):
    df = spark.createDataFrame([(1, "good one"), (2, "bad one")], "id int, t string")
    out = {r["id"]: (r["result"], r["status"], r["attempts"], r["error"]) for r in calls.call_rows(df, "id", "t", shout).collect()}
    assert out == {1: ("GOOD ONE", "ok", 1, None), 2: (None, "failed", 3, "ValueError: no")}


def test_chosen_errors_are_tried_again(spark):
    def fn(text: str) -> str:
        raise KeyError("gone") if text.startswith("gone") else TimeoutError("slow")

    df = spark.createDataFrame([(1, "gone for good"), (2, "slow one")], "id int, t string")
    policy = calls.CallPolicy(tries=3, retry_on=(TimeoutError,), wait=0.2)
    start = time.monotonic()
    out = {r["id"]: (r["status"], r["attempts"]) for r in calls.call_rows(df, "id", "t", fn, policy).collect()}
    assert out == {1: ("failed", 1), 2: ("failed", 3)} and time.monotonic() - start >= 0.6


def test_rate_per_endpoint(spark):
    def fn(text: str, endpoint: int) -> str:
        return f"{endpoint} {time.time()}"

    df = spark.range(12).select("id", F.lit("some text").alias("t"), (F.col("id") % 2).alias("endpoint")).repartition(6)
    policy = calls.CallPolicy(per_second=5, concurrency=1)
    results = [r["result"].split() for r in calls.call_rows(df, "id", "t", fn, policy, endpoint="endpoint").collect()]
    for endpoint in ("0", "1"):
        times = sorted(float(t) for e, t in results if e == endpoint)
        assert len(times) == 6 and all(b - a >= 0.15 for a, b in zip(times, times[1:], strict=False))


def test_calls_wait_for_their_second(spark):
    def fn(text: str, endpoint: int) -> str:
        return str(time.time())

    slots = rows.call_slots(spark.range(12), "id", endpoints=2, per_second=3).withColumn("t", F.lit("some text")).repartition(5)
    called = calls.call_rows(slots, "id", "t", fn, calls.CallPolicy(tries=1), endpoint="endpoint", second="second").collect()
    at = {r["id"]: float(r["result"]) for r in called}
    assert len(at) == 12
    for endpoint in (0, 1):
        early, late = [at[i] for i in range(6) if i % 2 == endpoint], [at[i] for i in range(6, 12) if i % 2 == endpoint]
        assert max(early) - min(early) < 0.9 <= min(late) - min(early)


def test_an_endpoint_is_called_in_waves(spark):
    """More text than a wave holds: smaller tasks one after the other, every row once, seconds and rate kept."""

    def fn(text: str, endpoint: int) -> str:
        task = TaskContext.get()
        return f"{time.time()} {task.stageId()} {task.partitionId()}"

    slots = rows.call_slots(spark.range(48), "id", endpoints=2, per_second=8).withColumn("t", F.repeat(F.lit("x"), 84))
    called = calls.call_rows(slots, "id", "t", fn, calls.CallPolicy(tries=1, per_second=50), endpoint="endpoint", second="second", wave_bytes=500).collect()
    assert sorted(r["id"] for r in called) == list(range(48)) and {r["status"] for r in called} == {"ok"}
    tasks = Counter(tuple(r["result"].split()[1:]) for r in called)
    assert len(tasks) >= 3 and max(tasks.values()) < 24, "no task has all rows of an endpoint"
    at = {r["id"]: float(r["result"].split()[0]) for r in called}
    for endpoint in (0, 1):
        seconds = [[at[i] for i in range(endpoint, 48, 2) if i // 2 // 8 == s] for s in range(3)]
        assert all(max(a) <= min(b) and min(b) - min(a) >= 0.9 for a, b in zip(seconds, seconds[1:], strict=False))
        times = sorted(t for s in seconds for t in s)
        assert all(b - a >= 0.015 for a, b in zip(times, times[1:], strict=False))
    plain = calls.call_rows(slots, "id", "t", fn, calls.CallPolicy(), endpoint="endpoint", wave_bytes=500).collect()
    assert sorted(r["id"] for r in plain) == list(range(48))


def test_rate_per_task(spark):
    df = spark.range(6).select("id", F.lit("some text").alias("t")).coalesce(1)
    calls.call_rows(df.limit(1), "id", "t", shout).collect()
    start = time.monotonic()
    assert len(calls.call_rows(df, "id", "t", shout, calls.CallPolicy(per_second=10)).collect()) == 6
    assert time.monotonic() - start >= 0.5


def _log(path):
    def fn(text: str) -> str:
        with open(path, "a", encoding="utf-8") as f:
            f.write(text + "\n")
        return shout(text)

    return fn


def _lines(path):
    try:
        return sorted(path.read_text(encoding="utf-8").split("\n")[:-1])
    except FileNotFoundError:
        return []


def test_cached_calls_ask_once(spark, tmp_path):
    log, cache = tmp_path / "log", str(tmp_path / "cache")
    texts = [(1, "alpha road"), (2, "alpha road"), (3, "short"), (4, None), (5, "bad street"), (6, "zeta road")]
    df = spark.createDataFrame(texts, "id int, t string")
    policy = calls.CallPolicy(tries=2)
    out = calls.cached_calls(df, "t", cache, _log(str(log)), quota=2, policy=policy)
    assert _lines(log) == ["alpha road", "bad street", "bad street"]
    got = {r["id"]: (r["result"], r["status"]) for r in out.collect()}
    assert got[1] == got[2] == ("ALPHA ROAD", "ok") and got[5] == (None, "failed")
    assert got[3] == got[4] == (None, "too_short") and got[6] == (None, "over_quota")
    assert _lines(log) == ["alpha road", "bad street", "bad street"], "reading the answers calls nothing"
    again = calls.cached_calls(df, "t", cache, _log(str(log)), quota=2, policy=policy)
    assert {r["id"]: r["result"] for r in again.collect()}[6] == "ZETA ROAD"
    assert _lines(log) == ["alpha road", "bad street", "bad street", "zeta road"]
    calls.cached_calls(df, "t", cache, _log(str(log)), policy=policy).collect()
    assert len(_lines(log)) == 4, "a full cache means no call"


def test_success_store_asks_failures_again(spark, tmp_path):
    log, cache = tmp_path / "log", str(tmp_path / "cache")
    df = spark.createDataFrame([(1, "bad street"), (2, "alpha road")], "id int, t string")
    for _ in range(2):
        calls.cached_calls(df, "t", cache, _log(str(log)), store="success", policy=calls.CallPolicy(tries=1)).collect()
    assert _lines(log) == ["alpha road", "bad street", "bad street"]


def test_quota_zero(spark, tmp_path):
    df = spark.createDataFrame([(1, "alpha road")], "id int, t string")
    out = calls.cached_calls(df, "t", str(tmp_path / "cache"), shout, quota=0)
    assert [r["result"] for r in out.collect()] == [None]


def test_blocks_resume_where_they_stopped(spark, tmp_path):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    seen = []

    def work(part):
        ids = sorted(r["id"] for r in part.collect())
        seen.append((ids[0], ids[-1]))
        if len(seen) == 3:
            raise RuntimeError("stopped")
        return part

    path = str(tmp_path / "run")
    with pytest.raises(RuntimeError):
        calls.run_in_blocks(df, "id", 30, path, work)
    out = calls.run_in_blocks(df, "id", 30, path, work)
    assert seen == [(0, 29), (30, 59), (60, 89), (60, 89), (90, 99)]
    assert sorted(r["v"] for r in out.collect()) == [2 * i for i in range(100)]


def test_counters(spark):
    df = spark.createDataFrame([("alpha road",), ("alpha road",), ("beta road",), ("x",), (None,)], "t string")
    cache = spark.createDataFrame([("beta road",)], "t string")
    assert tuple(calls.run_counters(df, "t", cache).first()) == (2, 1, 1)
