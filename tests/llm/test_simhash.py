from __future__ import annotations

import random

import xxhash
from pyspark.sql import functions as F

from corpuskit.llm import simhash
from tests.llm import cases


def brute_print(text, k):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\x09\x0a\x0b\x0c\x0d":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [words[i : i + k] for i in range(len(words) - k + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits):
    values, group = sorted(set(prints)), {}
    for v in values:
        group[v] = {v}
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= bits and group[a] is not group[b]:
                group[a] |= group[b]
                for x in group[a]:
                    group[x] = group[a]
    return group


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_and_components(spark):
    rows = cases.frame(spark)
    got = simhash.components(rows).collect()
    prints = [(r["doc_id"], brute_print(r["text"], 3)) for r in rows.collect()]
    group = brute_components([p for _, p in prints], 2)
    want = [
        (i, signed(p), min((j for j, q in prints if q in group[p] and j is not None), default=None)) for i, p in prints
    ]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([tuple(r) for r in got], key=order) == sorted(want, key=order)
    assert simhash.components(cases.empty(spark)).count() == 0


def test_close_pairs_small_and_crowded(spark):
    rng = random.Random(2)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    values = {s ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 3))) & (2**64 - 1) for s in seeds for _ in range(60)}
    df = spark.createDataFrame([(signed(v),) for v in values], "f bigint")
    for bits in (1, 2, 3):
        want = {(max(a, b), min(a, b)) for a in map(signed, values) for b in map(signed, values) if a != b and bin((a ^ b) & (2**64 - 1)).count("1") <= bits}
        for block in (4, 1000):
            got = {(r["a"], r["b"]) for r in simhash.close_pairs(df, bits, block=block).collect()}
            assert got == want


def test_zero_prints_link_like_others(spark):
    df = spark.createDataFrame([(5, ""), (3, None), (9, " ")], "doc_id bigint, text string")
    assert {r["component_id"] for r in simhash.components(df).collect()} == {3}


def test_one_of_each(spark):
    df = cases.frame(spark)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    prints = [(r["doc_id"], brute_print(r["text"], 5)) for r in df.collect()]
    group = brute_components([p for _, p in prints], 3)
    want = {min((j for j, q in prints if q in group[p] and j is not None), default=None) for _, p in prints}
    got = [r["doc_id"] for r in kept.collect()]
    assert len(got) == len({id(group[p]) for _, p in prints}) and set(got) == want
    assert simhash.one_of_each(cases.empty(spark)).count() == 0


def test_paths_and_stars(spark):
    from corpuskit.llm.components import roots

    path = [(i, i + 1) for i in range(300)]
    star = [(1000, 1001 + i) for i in range(500)]
    loop = [(2000, 2001), (2001, 2002), (2002, 2000), (5000, 5000), (None, 7000)]
    df = spark.createDataFrame(path + star + loop, "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in roots(df).collect()}
    assert {got[i] for i in range(301)} == {0} and {got[1001 + i] for i in range(500)} == {1000} and got[2002] == 2000
    assert 7000 not in got and 5000 not in got and roots(df.filter("a > 99999")).count() == 0


def test_pieces():
    assert simhash.pieces_for(1, 2) == 4 and simhash.pieces_for(10**10, 2) == 5


def test_long_text_counts(spark):
    text = " ".join(f"w{i}" for i in range(70_000))
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert simhash.fingerprinted(df).select(F.col("fingerprint")).first()[0] == signed(brute_print(text, 3))


def test_blocks_are_small_plans(spark):
    """The masks are one constant: 496 expressions took the driver hundreds of MB to compile."""
    masks = simhash._masks(simhash._cut(list(range(64)), 32), 2)
    blocks = simhash._blocked(spark.createDataFrame([(5,), (-7,)], "f bigint"), masks)
    want = {(f, i, f & m) for f in (5, -7) for i, m in enumerate(masks)}
    assert {tuple(r) for r in blocks.collect()} == want and len(masks) == 496
    assert blocks._jdf.queryExecution().optimizedPlan().toString().count("&") < 10
