"""Incremental runs with Structured Streaming.

Each stream reads a folder of files, works through what is there (`availableNow`) and stops; the checkpoint remembers which
files are done. Sinks write one folder per micro-batch and overwrite it when a batch is repeated, so a run that was
killed and started again gives every row once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from corpuskit.sources import keyed


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(path)


def run_to_end(writer) -> None:
    """Work through all input that is there now, then stop."""
    query = writer.trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()


def append_new_files(stream: DataFrame, target: str, checkpoint: str) -> None:
    """New files only, appended to a Parquet table whose own log makes each batch count once."""
    run_to_end(stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint))


def batch_sink(target: str, transform: Callable[[DataFrame, int], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that owns the folder `batch=<id>` below the target."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if transform is None else transform(batch, batch_id)
        rows.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return write


def run_batches(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    run_to_end(stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint))


def stored_batches(spark: SparkSession, target: str) -> DataFrame | None:
    """All rows of the sink with their batch number, or None before the first batch. Other faults of the table are errors."""
    try:
        return spark.read.parquet(target)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def insert_if_absent(stream: DataFrame, key: str, order: str, target: str, checkpoint: str) -> None:
    """Keep the row of the smallest `order` of every key over all batches, whichever arrives first; rows without a key are left out.

    The row of each key is state in the stream's RocksDB store, so a batch touches its own keys and reads no stored table, however many
    batches came before. Keys whose row a batch has seen go to the folder of the batch; `first_rows` reads the latest of each key. A null
    order comes last; rows of equal order are told apart by their other columns.
    """
    others = [c for c in stream.columns if c != key]
    place = F.struct(F.col(order).isNull(), *([order] + [c for c in others if c != order]))
    kept = stream.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*others), place).alias("__row"))
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")  # read when the query starts
    try:
        run_batches(kept.select(*[F.col(key) if c == key else F.col("__row")[c].alias(c) for c in stream.columns]), batch_sink(target), checkpoint, "update")
    finally:
        conf.unset(name) if before is None else conf.set(name, before)


def first_rows(spark: SparkSession, target: str, key: str) -> DataFrame | None:
    """What `insert_if_absent` has kept: one row per key, or None before the first batch."""
    stored = stored_batches(spark, target)
    return None if stored is None else keyed.latest_per_key(stored, [key], F.col("batch")).drop("batch")


def append_changes(stream: DataFrame, log: str, checkpoint: str) -> None:
    """Append field changes to a log; `merged_view` reads base and log as one table."""
    run_batches(stream, batch_sink(log), checkpoint)


def merged_view(base: DataFrame, changes: DataFrame | None, key: str, order: str | None = None) -> DataFrame:
    """Each field's last non-null value per key: base first, then changes by batch (and by `order` inside a batch). No changes give the base.

    A merge on read needs no rewrite of the table per batch. It is one aggregation with partial results, not a join.
    """
    if changes is None:
        return base
    fields = [c for c in dict.fromkeys([*base.columns, *changes.columns]) if c not in (key, "batch", order)]
    within = F.col(order).cast("bigint") if order else F.lit(0).cast("bigint")

    def versioned(df: DataFrame, at, then) -> DataFrame:
        types = {f.name: f.dataType for side in (base, changes) for f in side.schema.fields}
        columns = [F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in fields]
        return df.select(key, F.struct(at.cast("bigint").alias("b"), then.alias("o")).alias("__at"), *columns)

    rows = versioned(base, F.lit(-1), F.lit(0).cast("bigint")).unionByName(versioned(changes, F.col("batch"), within))
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__at"))).alias(c) for c in fields]
    return rows.groupBy(key).agg(*last)


def rate_audit(df: DataFrame, ts: str, width: str = "1 second") -> DataFrame:
    """Calls per tumbling window: (start, calls). Works on a table and on a stream in update mode."""
    return df.groupBy(F.window(ts, width)).agg(F.count(F.lit(1)).alias("calls")).select(F.col("window.start").alias("start"), "calls")


def conversation_state(stream: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv_id, turns, characters, last_turn) after every batch: three running aggregates per conversation, kept by Spark."""
    return stream.groupBy(conv).agg(
        F.count(F.lit(1)).alias("turns"),
        F.coalesce(F.sum(F.length("text").cast("bigint")), F.lit(0)).cast("bigint").alias("characters"),
        F.max("turn").alias("last_turn"),
    )


class ProgressTotals(StreamingQueryListener):
    """Sums an observed row of counters over all micro-batches of the queries it sees."""

    def __init__(self, name: str, counters: Sequence[str]) -> None:
        self.name = name
        self.totals = dict.fromkeys(counters, 0)
        self.batches = 0
        self.ended = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            self.batches += 1
            for counter in self.totals:
                self.totals[counter] += row[counter] or 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended += 1
