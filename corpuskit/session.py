"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
PARTITIONS_KEY = "spark.sql.shuffle.partitions"
ADVISORY_KEY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
FREE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PARTITION_ROWS = 1_000_000  # rows of a few numbers that one task sorts or hashes: about 200 MB
PARTITION_BYTES = 16 << 20  # up to which small partitions are merged; as they are shuffled, compressed


def local_session(cpus: int | str = 8, memory: str = "12g", **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster use the session it gives you."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("corpuskit")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only on a local master."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY) or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="corpuskit-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody used before, below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a table to the shared folder and read it back: survives the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_and_free(df: DataFrame, name: str = "stage") -> DataFrame:
    """As `cut_lineage`; the shuffle files of the write go with it, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    before = spark.conf.get(FREE_KEY, None)
    spark.conf.set(FREE_KEY, "true")
    try:
        return cut_lineage(df, name)
    finally:
        if before is None:
            spark.conf.unset(FREE_KEY)
        else:
            spark.conf.set(FREE_KEY, before)


def forget(df: DataFrame) -> None:
    """Delete a table that `cut_lineage` wrote, when nothing will read it again. No other folder is touched."""
    spark = df.sparkSession
    root = checkpoint_root(spark).rstrip("/")
    jvm = spark.sparkContext._jvm
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.getParent().toUri().getPath() == jvm.org.apache.hadoop.fs.Path(root).toUri().getPath():
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def partitions_for(spark: SparkSession, n_rows: int, partition_rows: int = PARTITION_ROWS) -> Iterator[None]:
    """Jobs that run inside shuffle `n_rows` rows to so many partitions that none grows with the table; the setting is put back.

    Adaptive execution merges small ones, up to `PARTITION_BYTES`. A table is made inside only if it is written inside (`cut_lineage`).
    """
    before = {key: spark.conf.get(key, None) for key in (PARTITIONS_KEY, ADVISORY_KEY)}
    spark.conf.set(PARTITIONS_KEY, str(max(int(before[PARTITIONS_KEY] or "200"), -(-n_rows // partition_rows))))
    spark.conf.set(ADVISORY_KEY, str(PARTITION_BYTES))
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
