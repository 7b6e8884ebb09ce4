"""A corpus pipeline: language, near copies by SimHash, benchmark passages, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last return the columns of
`documents`. `run` writes each stage's rows as Parquet below the shared folder and reads them again as the next one's input.

Null and empty texts have no letters, so the language stage drops them; the other stages take them as the empty text. Rows without an
id take part in every stage. Rows that agree in id and text are one row after the near copies. Empty tables give empty tables.
The stages read only the columns of `documents`; names of further columns cannot clash with theirs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm import bpe, decontamination, language, pii, simhash
from corpuskit.llm.frames import bounded_batches
from corpuskit.session import cut_lineage

#: Near copies: words of a shingle, and bits in which two linked fingerprints may differ.
SHINGLE, BITS = 3, 2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence; the source stands for the host."""
    bounded_batches(spark)
    model = language.fit(docs, "text", "lang")
    weighed = language.evidence(docs, model, "text", F.col("lang"), F.col("source"), F.lit(""))
    named = language.fused(weighed, weighed, model.languages)
    return named.filter("accepted").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each component."""
    bounded_batches(spark)
    return simhash.one_of_each(docs, shingle=SHINGLE, bits=BITS)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word of a benchmark window."""
    bounded_batches(spark)
    hits = decontamination.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return hits.filter("n_hit = 0").select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every span replaced by its kind; n_chars is counted again."""
    bounded_batches(spark)
    masked = pii.masked(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of what they decode to."""
    bounded_batches(spark)
    coded = bpe.encoded(docs.select("doc_id", "text", "lang", "source"))
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2(bpe.decoded(F.col("ids")), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_benchmark_passages),
    ("personal_data", mask_personal_data),
    ("tokens", encode_tokens),
]

#: The stages hash, tokenise and score texts in ways DuckDB cannot; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
