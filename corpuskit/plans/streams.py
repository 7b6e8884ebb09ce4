"""Incremental runs (T*). The given tables are written as a few files, then worked through as a stream."""

from __future__ import annotations

import time

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from corpuskit.plans.registry import query, table
from corpuskit.plans.storage import MERGED_SQL, customer_changes
from corpuskit.session import scratch_path
from corpuskit.sources import keyed
from corpuskit.streaming import streams

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def _arrivals(df, key, path, n=3):
    """Write the table as n batches of files, one after the other in key order."""
    cuts = df.stat.approxQuantile(key, [i / n for i in range(1, n)], 0.01)
    bounds = [None, *cuts, None]
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        part = df
        if lo is not None:
            part = part.where(F.col(key) > lo)
        if hi is not None:
            part = part.where(F.col(key) <= hi)
        part.write.mode("append").parquet(path)


def _events(spark, sf, root):
    _arrivals(table(spark, sf, "events"), "event_id", f"{root}/in")
    return streams.file_stream(spark, f"{root}/in", EVENTS, files_per_batch=1)


@query("t1_new_files_only", "SELECT event_id, user_id, event_type FROM events")
def _(spark, sf):
    root = scratch_path(spark, "newfiles")
    half = table(spark, sf, "events").stat.approxQuantile("event_id", [0.5], 0.01)[0]
    for part in (F.col("event_id") <= half, F.col("event_id") > half):
        table(spark, sf, "events").where(part).write.mode("append").parquet(f"{root}/in")
        stream = streams.file_stream(spark, f"{root}/in", EVENTS).select("event_id", "user_id", "event_type")
        streams.append_new_files(stream, f"{root}/out", f"{root}/check")
    return spark.read.parquet(f"{root}/out")


@query(
    "t2_insert_if_absent",
    "SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1",
)
def _(spark, sf):
    root = scratch_path(spark, "absent")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    # Files hold rows of all ages: the first row of a user may arrive in any batch.
    events.repartition(4, F.md5(F.col("event_id").cast("string"))).write.parquet(f"{root}/in")
    stream = streams.file_stream(spark, f"{root}/in", "event_id bigint, user_id bigint, event_type string", files_per_batch=1)
    streams.insert_if_absent(stream, "user_id", "event_id", f"{root}/out", f"{root}/check")
    return streams.first_rows(spark, f"{root}/out", "user_id").select("event_id", "user_id", "event_type")


@query("t3_merge_fields", MERGED_SQL)
def _(spark, sf):
    root = scratch_path(spark, "merge")
    changes = customer_changes(table(spark, sf, "orders"))
    _arrivals(changes, "last_order", f"{root}/in")
    stream = streams.file_stream(spark, f"{root}/in", "c_custkey bigint, last_order bigint, c_acctbal double", files_per_batch=1)
    streams.append_changes(stream, f"{root}/log", f"{root}/check")
    base = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    merged = streams.merged_view(base, streams.stored_batches(spark, f"{root}/log"), "c_custkey")
    return merged.fillna({"c_name": "none", "c_acctbal": -1.0, "last_order": -1})


@query("t4_restart_after_failure", "SELECT event_id, user_id FROM events")
def _(spark, sf):
    root = scratch_path(spark, "restart")
    stream = _events(spark, sf, root).select("event_id", "user_id")
    write = streams.batch_sink(f"{root}/out")

    def fails_once(batch, batch_id):
        if batch_id == 1:
            raise RuntimeError("stopped on purpose")
        write(batch, batch_id)

    try:
        streams.run_batches(stream, fails_once, f"{root}/check")
    except StreamingQueryException:
        pass  # the run was stopped half way; the second one goes on from the checkpoint
    streams.run_batches(stream, write, f"{root}/check")
    return streams.stored_batches(spark, f"{root}/out").drop("batch")


@query(
    "t5_rate_audit",
    "SELECT epoch(date_trunc('hour', ts))::BIGINT AS start, count(*) AS calls FROM events GROUP BY 1 HAVING count(*) > 15",
)
def _(spark, sf):
    root = scratch_path(spark, "audit")
    audit = streams.rate_audit(_events(spark, sf, root), "ts", "1 hour")
    streams.run_batches(audit, streams.batch_sink(f"{root}/out"), f"{root}/check", mode="update")
    updates = streams.stored_batches(spark, f"{root}/out")
    last = keyed.latest_per_key(updates, ["start"], F.col("batch")).where(F.col("calls") > 15)
    return last.select(F.unix_timestamp("start").alias("start"), "calls")


@query(
    "t6_conversation_state",
    """SELECT conv_id, count(*) AS turns, CAST(sum(length(text)) AS BIGINT) AS characters, max(turn) AS last_turn
    FROM conversations GROUP BY conv_id""",
)
def _(spark, sf):
    root = scratch_path(spark, "threads")
    _arrivals(table(spark, sf, "conversations"), "turn", f"{root}/in")
    stream = streams.file_stream(spark, f"{root}/in", "conv_id bigint, turn bigint, role string, text string", files_per_batch=1)
    streams.run_batches(streams.conversation_state(stream), streams.batch_sink(f"{root}/out"), f"{root}/check", mode="update")
    updates = streams.stored_batches(spark, f"{root}/out")
    return keyed.latest_per_key(updates, ["conv_id"], F.col("batch")).drop("batch")


@query(
    "t7_progress_counters",
    "SELECT count(*) AS rows, count(*) FILTER (WHERE event_type = 'error') AS errors FROM events",
)
def _(spark, sf):
    root = scratch_path(spark, "progress")
    counters = streams.ProgressTotals("counters", ["rows", "errors"])
    observed = _events(spark, sf, root).observe(
        "counters", F.count(F.lit(1)).alias("rows"), F.count_if(F.col("event_type") == "error").alias("errors")
    )
    spark.streams.addListener(counters)
    try:
        streams.run_batches(observed, streams.batch_sink(f"{root}/out"), f"{root}/check")
        waited = 0.0
        while not counters.ended and waited < 30:  # events arrive on another thread
            time.sleep(0.1)
            waited += 0.1
        if not counters.ended:
            raise TimeoutError("the stream's last progress did not arrive")
    finally:
        spark.streams.removeListener(counters)
    totals = (counters.totals["rows"], counters.totals["errors"])
    return spark.createDataFrame([totals], "rows bigint, errors bigint")


