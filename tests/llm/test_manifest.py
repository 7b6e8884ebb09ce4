from __future__ import annotations

import hashlib
import zlib

import pytest

from corpuskit.llm import manifest, queries
from tests.llm import cases


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, i):
    for nodes in tree[:-1]:
        first = i // 3 * 3
        yield "".join(nodes[first:i]), "".join(nodes[i + 1 : first + 3])
        i //= 3


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    made = []
    for r in rows:
        own = sha("".join(map(field, r)))
        odd = r[0] is None or zlib.crc32(str(r[0]).encode()) % 2
        bent = own if odd or r[4] is None else sha("".join(map(field, (*r[:4], r[4].replace("\n", "")))))
        made.append((r[1], r[0], own, bent))
    groups = {}
    for g in sorted({m[0] for m in made}, key=lambda g: (g is not None, (g or "").encode())):
        own = sorted((m for m in made if m[0] == g), key=lambda m: (m[1] is not None, m[1] or 0, m[2]))
        groups[g] = (own, levels([m[2] for m in own]))
    top = levels([t[-1][0] for _, t in groups.values()])
    out = []
    for k, (own, tree) in enumerate(groups.values()):
        for i, (_, key, leaf, bent) in enumerate(own):
            way = [*siblings(tree, i), *siblings(top, k)]
            node = bent
            for left, right in way:
                node = sha(left + node + right)
            out.append((key, leaf, tree[-1][0], top[-1][0], sha("".join(a + b for a, b in way)), node, node == top[-1][0]))
    return out


def rows(n=120):
    made = [(i * 3 % n, f"s{min(i % 7, 3)}", "en", i, f"line {i}\nend" if i % 3 else None) for i in range(n)]
    odd = [(5000, None, None, None, "null source\n"), (None, "s1", None, None, "null id\n"), (5001, "é", "x", 0, ""), (5002, "", "", -1, "\n" * 9)]
    return made + odd + [made[4], made[4], (made[5][0], *made[6][1:])]


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def saved(spark, tmp_path, made, schema=SCHEMA):
    spark.createDataFrame(made, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def order(r):
    return tuple((x is not None, x if x is not None else 0) for x in r)


def test_by_brute_force(spark, tmp_path):
    got = [tuple(r) for r in queries.op11(spark, saved(spark, tmp_path, rows())).collect()]
    assert sorted(got, key=order) == sorted(brute(rows()), key=order)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_blocks_on_several_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{saved(spark, tmp_path, rows())}/documents.parquet")
    got = manifest.folded(queries.leaves_of(docs), levels=2).collect()
    assert sorted((tuple(r) for r in got), key=order) == sorted((r[:-1] for r in brute(rows())), key=order)


def test_odd_rows_and_clashing_names(spark, tmp_path):
    frame = cases.frame(spark)
    clash = frame.selectExpr("*", "doc_id AS rank", "text AS grp", "lang AS leaf", "1 AS n", "'x' AS root", "2 AS block")
    clash.write.parquet(f"{tmp_path}/documents.parquet")
    want = brute([(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in frame.collect()])
    got = [tuple(r) for r in queries.op11(spark, str(tmp_path)).collect()]
    assert sorted(got, key=order) == sorted(want, key=order)


@pytest.mark.parametrize("n", [0, 1, 4])
def test_few_rows(spark, tmp_path, n):
    few = [(i, "a", None, None, "x\n") for i in range(n)]
    got = [tuple(r) for r in queries.op11(spark, saved(spark, tmp_path, few)).collect()]
    assert sorted(got) == sorted(brute(few))


def test_versions_copy_only_their_ancestors(spark):
    leaves = [("g", i, bytes.fromhex(sha(f"leaf {i}")), bytes.fromhex(sha(f"bent {i}")) if i in (0, 40, 99) else None) for i in range(100)]
    df = spark.createDataFrame(leaves, "grp string, key bigint, digest binary, bent binary")
    nodes = manifest.copies(df, levels=2).collect()
    base = levels([d.hex() for _, _, d, _ in leaves])
    for key in (0, 40, 99):
        own = {(r["level"], r["place"]): r["digest"] for r in nodes if r["key"] == key}
        assert set(own) == {(level, key // 3**level) for level in range(6)}  # a hundred leaves have five levels above them
        # Reading the version: its own nodes where it has them, the base's elsewhere.
        seen = [[own.get((lv, i), node) for i, node in enumerate(level)] for lv, level in enumerate(base)]
        assert levels(seen[0]) == seen
    assert len(nodes) == 18
    tops = {r["key"]: r["folded_root"] for r in manifest.folded(df).collect()}
    assert {r["key"]: r["digest"] for r in nodes if r["level"] == 5} == {k: tops[k] for k in (0, 40, 99)}
