from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuskit.llm import codes, token_files
from corpuskit.session import scratch_path
from tests.llm import cases


@pytest.mark.parametrize("most", [1, 255, 256, 70_000, 2**31])
def test_codes_round_trip_and_random_access(most):
    rng = random.Random(most)
    for n in (0, 1, 511, 512, 513, 2000):
        numbers = np.array([rng.randint(0, most) if rng.random() < 0.5 else rng.randint(0, min(most, 300)) for _ in range(n)], np.uint64)
        levels = codes.pack(numbers)
        assert list(codes.unpack(levels)) == list(numbers)
        for i in rng.sample(range(n), min(n, 60)):
            assert codes.at(levels, i) == numbers[i]


def brute(rows):
    engine = token_files.tokenizer(token_files.TOKENIZER)
    coded = [(r["doc_id"], [*engine.encode(r["text"] or "", add_special_tokens=False).ids, 2]) for r in rows]
    coded = [(i, ids, np.array(ids, "<u4").tobytes()) for i, ids in coded]
    coded.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[2]))
    out, start = [], 0
    for i, ids, raw in coded:
        out.append((i, start, len(ids), zlib.crc32(raw)))
        start += len(ids)
    return out, [t for _, ids, _ in coded for t in ids]


@pytest.mark.parametrize("segment", [token_files.SEGMENT_TOKENS, 100])
def test_files(spark, monkeypatch, segment):
    monkeypatch.setattr(token_files, "SEGMENT_TOKENS", segment)
    extra = [(500, "<|endoftext|> x<|endoftext|>y", *[None] * 6), (501, "É́ ΑΣ Σ\x0bb\x0cC\x1cd\x85e", *[None] * 6), (502, "w" * 300, *[None] * 6)]
    df = cases.frame(spark).unionByName(spark.createDataFrame(extra, cases.SCHEMA))
    path = scratch_path(spark, "tokens")
    token_files.write(df, path)
    read = token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("tokens").alias("crc")).collect()
    want, flat = brute(df.collect())
    assert sorted([tuple(r) for r in read], key=lambda r: r[1]) == want
    for place in random.Random(1).sample(range(len(flat)), 5):
        assert token_files.token_at(spark, path, place) == flat[place]
    with pytest.raises(IndexError):
        token_files.token_at(spark, path, len(flat))


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 3)
    engine = token_files.tokenizer(token_files.TOKENIZER)
    for text in ("one two three four five", "six seven one", "w" * 100, ""):
        (ids,) = token_files.encode_all(pa.array([text]), token_files.TOKENIZER, 2)
        assert list(np.frombuffer(ids, "<u4")) == [*engine.encode(text, add_special_tokens=False).ids, 2]


def test_words_met_once_are_not_remembered():
    memory = token_files._memory(token_files.TOKENIZER)
    memory.clear()
    engine = token_files.tokenizer(token_files.TOKENIZER)
    for text in ("zebra quince zebra", "quince zebra lilac lilac lilac", "zebra quince"):
        (ids,) = token_files.encode_all(pa.array([text]), token_files.TOKENIZER, 2)
        assert list(np.frombuffer(ids, "<u4")) == [*engine.encode(text, add_special_tokens=False).ids, 2]
    assert memory.words.to_pylist() == ["zebra", "lilac"]
    assert memory.lengths.sum() == len(memory.ids)


def test_empty_table(spark):
    path = scratch_path(spark, "tokens")
    token_files.write(cases.empty(spark), path)
    assert token_files.read(spark, path).count() == 0
