"""File scans and sinks. Schemas are always given, never inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Schema = StructType | str


def read_csv(spark: SparkSession, path: str, schema: Schema, columns: Sequence[str] | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with a header and doubled quotes; large files are split among tasks.

    With `multi_line`, quoted fields may hold newlines, and each file is read by one task. Without it such a field breaks its
    row, and a row with a wrong number of fields or a value of a wrong type ends the query instead of passing as data.
    """
    mode = "PERMISSIVE" if multi_line else "FAILFAST"
    df = spark.read.schema(schema).csv(path, header=True, multiLine=multi_line, escape='"', mode=mode)
    # The parser skips fields that are not asked for; a broken row must show whichever columns are read.
    return df.select(*columns) if columns else df


def read_folder(spark: SparkSession, path: str, schema: Schema, fmt: str, suffix: str) -> DataFrame:
    """All files with a suffix at any depth, with the file each row came from."""
    reader = spark.read.schema(schema).format(fmt).option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", f"*{suffix}").load(path).withColumn("file", F.col("_metadata.file_path"))


def read_jsonl(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """One object per line; a line that does not parse comes back in the column `corrupt`."""
    full = StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema.fields))
    with_corrupt = full.add("corrupt", "string")
    return spark.read.schema(with_corrupt).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="corrupt")


def read_json_arrays(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """Files that each hold one JSON array of objects."""
    return spark.read.schema(schema).json(path, multiLine=True)


def read_whole_texts(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def read_keyed_json(spark: SparkSession, path: str, value_schema: str, recency: Column | None = None) -> DataFrame:
    """Cache files of the form `{key: response}`, merged so that the later file wins.

    A file is later when its `recency` is larger: by default the modification time, then the name.
    """
    order = F.struct("modified", "file") if recency is None else F.struct(recency, "file")
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.from_json("value", f"map<string, {value_schema}>").alias("entries"),
    )
    entries = files.select("file", "modified", F.explode("entries").alias("key", "response"))
    latest = entries.groupBy("key").agg(F.max_by(F.struct("response", "file"), order).alias("r"))
    return latest.select("key", "r.response", "r.file")


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split of a table stored by split; the other splits are not listed or read."""
    return spark.read.parquet(path).where(F.col("split") == split)


def as_content(df: DataFrame, content: str) -> DataFrame:
    """A content column and all other columns as a string map."""
    others = [c for c in df.columns if c != content]
    pairs = [part for c in others for part in (F.lit(c), F.col(c).cast("string"))]
    return df.select(F.col(content).alias("content"), F.create_map(*pairs).alias("metadata"))


def write_csv(df: DataFrame, path: str, by: str | None = None) -> None:
    writer = df.write.option("header", "true").option("escape", '"')
    (writer.partitionBy(by) if by else writer).csv(path)


def write_jsonl(df: DataFrame, path: str, by: str | None = None) -> None:
    """UTF-8 lines; characters outside ASCII stay as they are."""
    (df.write.partitionBy(by) if by else df.write).json(path)


def write_instruction_records(df: DataFrame, path: str) -> None:
    df.select("instruction", "input", "output").write.json(path)


def file_list(spark: SparkSession, path: str, suffix: str) -> DataFrame:
    """Paths of the files below a folder; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", f"*{suffix}").load(path).select(F.col("path").alias("file"))


def convert_new_csv(
    spark: SparkSession, path: str, schema: Schema, target: str, checkpoint: str, suffix: str = ".csv", multi_line: bool = False
) -> int:
    """Append the rows of CSV files that no earlier run has read to a Parquet table; returns how many rows were new.

    The stream's checkpoint knows the files, and the log of the file sink, in the target itself, says which files of the table count: a
    run that is killed anywhere and started again gives each row once. Names of files stay with the source. Files are split among
    tasks unless `multi_line` asks for newlines in fields.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}")
    rows = reader.csv(path, header=True, multiLine=multi_line, escape='"', mode="FAILFAST")
    query = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return sum(progress.numInputRows for progress in query.recentProgress)


def saved_or_built(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    """Read a table if an earlier run finished writing it, else build and write it (over an unfinished one).

    A marker table beside it is written last; without the marker the table does not count.
    """
    spark, marker = df.sparkSession, f"{path.rstrip('/')}.done"
    try:
        spark.read.parquet(marker)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        writer = df.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(path)
        spark.createDataFrame([(path,)], "path string").write.mode("overwrite").parquet(marker)
    return spark.read.parquet(path)


def append_run(df: DataFrame, path: str, run: str) -> None:
    """Add metric rows of a run to an append-only table."""
    df.withColumn("run", F.lit(run)).write.mode("append").parquet(path)
