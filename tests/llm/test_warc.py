from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from corpuskit.llm import warc

SCHEMA = "page_id bigint, url string, html string, file string"


def pages(n=1500):
    rows = [(i, f"http://h{i % 7}.org/{i}", f"<p>été {i}</p>" * (i % 5), "clash") for i in range(n)]
    return [*rows, (None, None, None, None), (None, "http://x.org", "y", None), (3, "http://h3.org/3", "again", None), (5, "u", "", None), (5, "u", "", None)]


def audited(spark, a, b):
    frames = [spark.createDataFrame(x, SCHEMA) for x in (a, b)]
    return sorted((tuple(r) for r in warc.audit(*[warc.stored(f) for f in frames]).collect()), key=str)


def test_equal_replicas_have_no_finding(spark):
    assert audited(spark, pages(), pages()) == []
    assert audited(spark, [], []) == []


def test_faults_are_located(spark):
    a = pages()
    b = [r for r in a if r[0] != 700]
    b = [(i, u, h + "!" if i in (0, 511, 1499) else h, f) if h is not None else (i, u, h, f) for i, u, h, f in b] + [(99_999, "new", "new", None)]
    got = {(r[0], r[4]): r for r in audited(spark, a, b)}
    assert set(got) == {(0, "changed"), (511, "changed"), (1499, "changed"), (700, "missing"), (99_999, "extra")}
    assert got[700, "missing"][6] is None and got[99_999, "extra"][5] is None
    record = spark.createDataFrame([a[511]], SCHEMA)
    raw = bytes(warc.stored(record).first()["record"])
    assert got[511, "changed"][5] == hashlib.sha256(raw).hexdigest() and got[511, "changed"][3] - got[511, "changed"][2] == len(raw)
    assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith("<p>été 511</p>\r\n\r\n".encode())


def test_one_replica_is_empty(spark):
    got = audited(spark, pages(20), [])
    assert len(got) == len(pages(20)) and {r[4] for r in got} == {"missing"}


def test_only_mismatching_branches_are_read(spark):
    a, b = pages(1500), pages(1500)
    b[700] = (700, "other", "text", None)
    both = [warc.leaves(warc.stored(spark.createDataFrame(x, SCHEMA).filter("page_id is not null and page_id > 9"))) for x in (a, b)]
    nodes = both[0].withColumn("replica", F.lit("a")).unionByName(both[1].withColumn("replica", F.lit("b")))
    levels = warc.tree(nodes.select("replica", F.col("page_id").alias("key"), "start", "end", "digest"))
    assert [lv.filter("replica = 'a'").count() for lv in levels][-1] == 1
    for level in levels:
        assert warc.differing(level).count() == 1
