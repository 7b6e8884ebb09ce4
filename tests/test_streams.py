from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from corpuskit.operators import lookups
from corpuskit.streaming import streams

SCHEMA = "k bigint, n bigint, v string"


def _put(spark, path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_only_new_files(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for batch in ([(1, 1, "a")], [(2, 2, "b"), (3, 3, "c")], []):
        if batch:
            _put(spark, source, batch)
        streams.append_new_files(streams.file_stream(spark, source, SCHEMA), out, check)
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_first_row_per_key_over_batches(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    _put(spark, source, [(1, 2, "b"), (1, 1, "a"), (2, 3, "c")])
    _put(spark, source, [(1, 0, "late"), (3, 4, "d"), (None, 5, "e")])
    stream = streams.file_stream(spark, source, SCHEMA, files_per_batch=1)
    streams.insert_if_absent(stream, "k", "n", out, check)
    assert {(r["k"], r["v"]) for r in streams.first_rows(spark, out, "k").collect()} == {(1, "late"), (2, "c"), (3, "d")}
    _put(spark, source, [(2, 1, "first"), (3, 9, "x"), (4, None, "no order"), (4, 7, "y")])
    streams.insert_if_absent(streams.file_stream(spark, source, SCHEMA), "k", "n", out, check)
    assert {(r["k"], r["v"]) for r in streams.first_rows(spark, out, "k").collect()} == {(1, "late"), (2, "first"), (3, "d"), (4, "y")}
    last = streams.stored_batches(spark, out)
    newest = last.agg({"batch": "max"}).first()[0]
    assert {r["k"] for r in last.where(f"batch = {newest}").collect()} == {2, 3, 4}, "a batch writes the keys it has seen and no others"
    assert streams.first_rows(spark, str(tmp_path / "none"), "k") is None


def test_broken_tables_are_errors(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        streams.stored_batches(spark, str(tmp_path / "broken"))
    base = spark.createDataFrame([(1, "x")], "k int, v string")
    assert streams.merged_view(base, None, "k").collect() == base.collect()


def test_merged_view_equals_step_by_step_upserts(spark, tmp_path):
    base = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], "k bigint, v string, w double")
    batches = [[(1, None, 5.0)], [(2, "z", None), (3, "new", None)], [(1, "q", None)]]
    source, log, check = (str(tmp_path / n) for n in ("in", "log", "check"))
    expected = base
    for rows in batches:
        _put(spark, source, rows, base.schema)
        expected = lookups.merged_fields(expected, spark.createDataFrame(rows, base.schema), "k").select("k", "v", "w")
    streams.append_changes(streams.file_stream(spark, source, "k bigint, v string, w double", files_per_batch=1), log, check)
    merged = streams.merged_view(base, streams.stored_batches(spark, log), "k")
    assert {tuple(r) for r in merged.select("k", "v", "w").collect()} == {tuple(r) for r in expected.collect()}


def test_killed_run_goes_on_without_loss_or_repeats(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for i in range(3):
        _put(spark, source, [(i, i, "v")])
    write = streams.batch_sink(out)

    def dies_after_writing(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("stopped after the write, before the commit")

    stream = streams.file_stream(spark, source, SCHEMA, files_per_batch=1)
    with pytest.raises(StreamingQueryException):
        streams.run_batches(stream, dies_after_writing, check)
    streams.run_batches(stream, write, check)
    assert sorted(r["k"] for r in streams.stored_batches(spark, out).collect()) == [0, 1, 2]


def test_state_equals_one_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = "conv_id bigint, turn bigint, role string, text string"
    rows = [(c, t, "user", "x" * (c + t)) for t in range(4) for c in range(3)]
    for t in range(4):
        _put(spark, source, [r for r in rows if r[1] == t], schema)
    results = []
    for files in (1, 10):
        out, check = str(tmp_path / f"out{files}"), str(tmp_path / f"check{files}")
        stream = streams.file_stream(spark, source, schema, files_per_batch=files)
        streams.run_batches(streams.conversation_state(stream), streams.batch_sink(out), check, mode="update")
        last = streams.stored_batches(spark, out).groupBy("conv_id").agg(F.max_by("turns", "batch"), F.max_by("characters", "batch"))
        results.append({tuple(r) for r in last.collect()})
    assert results[0] == results[1] == {(c, 4, sum(c + t for t in range(4))) for c in range(3)}


def test_rate_audit_on_a_table(spark):
    rows = [("2024-01-01 00:00:00.1",), ("2024-01-01 00:00:00.9",), ("2024-01-01 00:00:01.0",)]
    df = spark.createDataFrame(rows, "s string").select(F.to_timestamp("s").alias("ts"))
    assert sorted(r["calls"] for r in streams.rate_audit(df, "ts").collect()) == [1, 2]
