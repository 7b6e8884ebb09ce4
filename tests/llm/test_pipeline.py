from __future__ import annotations

import hashlib

import duckdb
import pytest

import corpus_pipeline
from corpuskit.llm import bpe, pii
from tests.llm.test_decontamination import brute as brute_hits
from tests.llm.test_simhash import brute_components, brute_print

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Rows that each stage was given and rows that it kept."""
    from corpuskit.session import cut_lineage

    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        kept = cut_lineage(stage(spark, docs, sf_dir), name)
        out[name] = (docs.collect(), kept.collect(), kept.columns)
        docs = kept
    return out


def test_columns(stages):
    assert list(stages) == ["language", "near_copies", "benchmark", "personal_data", "tokens"]
    assert all(stages[n][2] == COLUMNS for n in list(stages)[:-1])


def test_language_keeps_clean_documents(stages):
    given, kept, _ = stages["language"]
    assert set(kept) <= set(given) and len(kept) >= 0.98 * len(given)


def test_near_copies_by_brute_force(stages):
    given, kept, _ = stages["near_copies"]
    prints = [(r["doc_id"], brute_print(r["text"], corpus_pipeline.SHINGLE)) for r in given]
    group = brute_components([p for _, p in prints], corpus_pipeline.BITS)
    want = {min(i for i, q in prints if q in group[p]) for _, p in prints}
    assert sorted(r["doc_id"] for r in kept) == sorted(want) and set(kept) <= set(given)


def test_benchmark_by_brute_force(stages, sf_dir):
    given, kept, _ = stages["benchmark"]
    items = duckdb.sql(f"SELECT item_id, text FROM '{sf_dir}/benchmark.parquet'").fetchall()
    short = [r for r in given if len(r["text"]) < 3000]
    clean = {r["doc_id"] for r in short if brute_hits(r["text"], items)[1] == 0}
    assert {r["doc_id"] for r in kept} & {r["doc_id"] for r in short} == clean


def test_personal_data_is_masked(stages):
    given, kept, _ = stages["personal_data"]
    before = {r["doc_id"]: r for r in given}
    assert len(kept) == len(given)
    for r in kept:
        assert r["text"] == pii.mask(before[r["doc_id"]]["text"]) and r["n_chars"] == len(r["text"])


def test_tokens(stages):
    given, kept, _ = stages["tokens"]
    engine, texts = bpe.encoding(bpe.RANKS), {r["doc_id"]: r["text"] for r in given}
    assert len(kept) == len(given)
    for r in kept:
        assert r["ids"] == engine.encode_ordinary(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_odd_tables(spark, sf_dir, tmp_path):
    from corpuskit.session import cut_lineage
    from tests.llm import cases

    for docs in (cases.frame(spark).select(*COLUMNS), cases.empty(spark).select(*COLUMNS)):
        for name, stage in corpus_pipeline.STAGES:
            docs = cut_lineage(stage(spark, docs, sf_dir), name)
