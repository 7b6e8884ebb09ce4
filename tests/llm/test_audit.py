from __future__ import annotations

import re
from itertools import permutations

from pyspark.sql import functions as F

from corpuskit.llm import audit, queries
from tests.llm import cases


def failing(rows):
    """The filters that each of the rows (doc_id, text) fails."""
    first = {}
    for i, t in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, t in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0d]+", t)
        capitals = len(re.findall("[A-Z]", t))
        tests = [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * capitals > 5 * len(t), re.search("[#$%&*|]", t), i is not None and first[t] < i]
        yield {n for n, hit in zip("ABCDE", tests, strict=True) if hit}


def brute(rows, good, toxic):
    """rows: (doc_id, source, text)"""
    found = list(zip(rows, failing([(r[0], r[2]) for r in rows]), strict=True))
    out = set()
    for part in {r[1] or "" for r in rows}:
        own = [(r[0], bad) for r, bad in found if (r[1] or "") == part]
        total, lines = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                removed = [i for i, bad in own if f in bad and not bad & before]
                total[f] += len(removed)
                kept = sum(not bad & (before | {f}) for _, bad in own)
                redundant = sum(f in bad and bool(bad & before) for _, bad in own)
                lines.append(("".join(order), k + 1, kept, len(removed), redundant, sum(bad == {f} for _, bad in own), sum(i in good for i in removed), sum(i in toxic for i in removed)))
        out |= {(part, *line, total[line[0][line[1] - 1]]) for line in lines}
    return out


def saved(spark, tmp_path, docs, labels):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int, part string").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_by_brute_force(spark, tmp_path):
    odd = [(900 + i, t, "en", s, None) for i, (t, s) in enumerate([("Z# " * 60, None), ("z " * 60, ""), ("z " * 60, "s"), ("a|b", "é"), ("Z# " * 60, "é")])]
    frame = cases.frame(spark).select("doc_id", "text", "lang", "source", "n_chars")
    docs = frame.unionByName(spark.createDataFrame(odd, frame.schema)).withColumns({"part": F.lit("clash"), "id": F.lit(1), "key": F.lit("k"), "words": F.lit(0), "digest": F.lit("d")})
    labels = [(0, 1, 0, "x"), (0, 1, 1, "x"), (1, 0, 1, None), (3, 1, 1, None), (900, 1, 1, None), (904, None, 1, None), (None, 1, 1, None)]
    got = queries.op12(spark, saved(spark, tmp_path, docs, labels))
    assert got.columns == "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    want = brute(rows, {r[0] for r in labels if r[1] == 1} - {None}, {r[0] for r in labels if r[2] == 1} - {None})
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want


def test_no_rows(spark, tmp_path):
    assert queries.op12(spark, saved(spark, tmp_path, cases.empty(spark), [])).count() == 0


def test_tables_are_shuffled_before_sets_multiply(spark, tmp_path):
    ids = spark.createDataFrame([(1, "p", 0), (2, "p", 1)], "id bigint, part string, filter int")
    plan = audit._after(ids, ids, F.sequence(F.lit(0), F.lit(3)), "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange") and plan.count("Exchange hashpartitioning") == 2
