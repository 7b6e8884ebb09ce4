"""Rows that every operator must take: nulls, empty and long texts, repeated rows and ids, columns of clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, spans string, ids string"


def texts(seed: int = 1) -> list[str | None]:
    rng = random.Random(seed)
    words = "the of stone river l'été naïve 12 3.14 x@y.org 😀 中文 don't WE'RE we're\t ++ 10.0.0.1 日本 +1 (555) 010-9999".split(" ")
    made = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    long = " ".join(rng.choice(words) for _ in range(20_000))
    odd = [None, "", " ", "\n\n  \n", "a", "'s", " 's's don't", "x" * 5000, "　 a\x1cb", "0" * 3000, "a\r\n\tb  c ", "tail   "]
    return made + odd + [long] + made[:5]


def frame(spark, seed: int = 1):
    rows = [(i, t, "en", "s", None, "clash", "clash", "clash") for i, t in enumerate(texts(seed))]
    rows += [rows[0], rows[0], (None, "null id", None, None, None, None, None, None), (rows[1][0], "same id, other text") + (None,) * 6]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
