from __future__ import annotations

import random

import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

from corpuskit.llm import bpe
from corpuskit.llm.pretokens import cut
from corpuskit.session import cut_lineage
from tests.llm import cases

PATTERN = regex.compile(public_tokenizers.PATTERN)
SIGNS = " \t\n　 'sStdmrevl aé中9½٣_.-!́😀\x1c\x85"


def test_cut_is_the_pattern():
    rng = random.Random(3)
    for _ in range(3000):
        texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 14))) for _ in range(3)]
        raw, bounds, counts = cut(texts)
        want = [PATTERN.findall(t) for t in texts]
        assert [raw[i:j].decode() for i, j in zip(bounds, bounds[1:], strict=False)] == [w for own in want for w in own]
        assert list(counts) == [len(own) for own in want]


@pytest.mark.parametrize("chunk", [bpe.CHUNK_BYTES, 2000])
def test_ids_and_bytes(spark, monkeypatch, chunk):
    monkeypatch.setattr(bpe, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(bpe, "PIECE_BYTES", min(bpe.PIECE_BYTES, chunk))
    df = cut_lineage(cases.frame(spark))
    engine = bpe.encoding(bpe.RANKS)
    coded = bpe.encoded(df)
    assert coded.columns == ["doc_id", "lang", "source", "n_chars", "n_words", "spans", "ids"]
    got = [(r["doc_id"], tuple(r["ids"]), bytes(r["raw"])) for r in coded.withColumn("raw", bpe.decoded(F.col("ids"))).collect()]
    want = [(r["doc_id"], tuple(engine.encode_ordinary(r["text"] or "")), (r["text"] or "").encode()) for r in df.collect()]
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(got, key=order) == sorted(want, key=order)


def test_empty_table(spark):
    assert bpe.encoded(cases.empty(spark)).count() == 0


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [64])], "k int, ids array<int>")
    got = {r["k"]: bytes(r["raw"]) for r in rows.select("k", bpe.decoded(F.col("ids")).alias("raw")).collect()}
    assert got[1] == got[2] == b"" and len(got[3]) >= 1


def test_words_are_shuffled_once_per_chunk(spark):
    df = spark.createDataFrame([(i, "same words again") for i in range(50)], "doc_id int, text string").coalesce(1)
    parts = 4
    rows = df.select("text", F.struct("doc_id").alias("row")).mapInArrow(bpe._packer(parts, rows=False), bpe.PACKED).collect()
    assert sum(r["words"] for r in rows) == 3
