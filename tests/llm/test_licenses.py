from __future__ import annotations

import os

import duckdb

from corpuskit.llm import licenses, queries
from corpuskit.llm.sql import OP6
from tests.llm import cases

COMMON = "/usr/share/common-licenses"


def scanned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: r for r in licenses.scan(df).collect()}


def test_whole_texts_and_spellings(spark):
    mit = dict(reversed(licenses.TEXTS))["MIT"]
    wrapped = "Copyright (c) 2020 Someone\n\n" + mit.replace(" ", "\n  ", 40).upper() + "\nAll rights reserved."
    isc = next(t for n, t in licenses.TEXTS if n == "ISC").replace("license", "licence")
    got = scanned(spark, [mit, wrapped, mit + " and more", isc, "Licenced? no", None, "", "Licensed under CC BY-NC 4.0"])
    assert [got[i]["license"] for i in range(8)] == ["MIT", "MIT", None, "ISC", None, None, None, "CC-BY-NC-4.0"]
    assert got[0]["text_digest"] == got[1]["text_digest"] and got[5]["text_digest"] == got[6]["text_digest"]


def test_notices_on_lines(spark):
    text = "Words.\nReleased under the  MIT licence!\nmore\n  LICENSED under the Apache License, version 2.0.\nlicense plates"
    assert scanned(spark, [text])[0]["notices"] == ["MIT", "Apache-2.0"]


def test_rows(spark):
    df = cases.frame(spark)
    got = licenses.scan(df)
    assert got.count() == df.count() and {"text_digest", "license", "notices"} <= set(got.columns)
    assert licenses.scan(cases.empty(spark)).count() == 0
    clash = df.withColumnRenamed("lang", "license").withColumnRenamed("source", "notices")
    assert licenses.scan(clash).columns.count("license") == 1


def test_every_notice_holds_the_cue():
    import re

    assert all(re.search(licenses.CUE, t) for _, t in licenses.NOTICES)


def test_no_python_on_executors(spark):
    plan = licenses.scan(cases.frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_wrapped_texts_have_one_digest(spark):
    import textwrap

    texts = dict(reversed(licenses.TEXTS))
    for name in ("ISC", "MIT"):
        plain = texts[name]
        notice = "Copyright (c) 2020, Someone <a@b.org>\nCopyright 2021 Another\n© Third\n(c) 2019 Fourth\nAll rights reserved.\n\n"
        wraps = [textwrap.fill(plain, width) for width in range(30, 100)] + [plain.replace(" ", "\n")]
        assert any(line.lower().startswith("copyright ") for w in wraps for line in w.split("\n"))
        got = scanned(spark, [plain, *wraps, *[notice + w for w in wraps]])
        assert {r["license"] for r in got.values()} == {name} and len({r["text_digest"] for r in got.values()}) == 1


def test_other_lines_of_copyright_stay(spark):
    lines = ["(c) You must retain, in the Source form", "copyright notice that is included", "Copyright [yyyy] [name]", "Copyright (C) <year>  <name>"]
    got = scanned(spark, ["", *lines])
    assert [got[i]["text_digest"] == got[0]["text_digest"] for i in range(1, 5)] == [False, False, True, True]


def test_published_texts(spark):
    import os

    import pytest

    folder = "/usr/share/common-licenses"
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    if not all(os.path.exists(f"{folder}/{f}") for f in names):
        pytest.skip("the published texts are not here")
    texts = [open(f"{folder}/{f}", encoding="utf-8").read() for f in names]
    filled = texts[0].replace("Copyright [yyyy] [name of copyright owner]", "Copyright 2020 Someone")
    cut = texts[0][: texts[0].index("APPENDIX")]
    # Wrapped anew and indented, but with the lines that begin a notice or a point left where they are.
    turned = [t.replace("\n", "\n   ").replace(", ", ",  ") for t in texts]
    got = scanned(spark, [*texts, *turned, filled, cut, texts[0] + "and more"])
    want = [*names.values(), *names.values(), "Apache-2.0", "Apache-2.0", None]
    assert [got[i]["license"] for i in range(len(want))] == want


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

{0} Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
{1} Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{2}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING
IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
THIRD = """{0} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_bsd_texts(spark):
    notice = "Copyright (c) 2020, Someone\nAll rights reserved.\n\n"
    two = [BSD.format("1.", "2.", ""), BSD.format("*", "*", "")]
    three = [BSD.format("1.", "2.", THIRD.format("3.")), BSD.format("*", "*", THIRD.format("*"))]
    titled = [f"BSD {n}-Clause License\n\n{notice}{t}" for n, ts in ((2, two), (3, three)) for t in ts]
    got = scanned(spark, [*two, *three, *[notice + t for t in two + three], *titled])
    assert [got[i]["license"] for i in range(12)] == ["BSD-2-Clause", "BSD-2-Clause", "BSD-3-Clause", "BSD-3-Clause"] * 3


def test_sql_knows_the_digests_too(spark, tmp_path):
    texts = [(name, open(f"{COMMON}/{name}", encoding="utf-8").read()) for name in ("Apache-2.0", "GPL-2", "BSD") if os.path.exists(f"{COMMON}/{name}")]
    rows = [(i, t) for i, (_, t) in enumerate(texts)] + [(90, None), (91, "no licence"), (92, licenses.TEXTS[0][1])]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in queries.op6(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(con.execute(OP6).fetchall()) == got
    assert {r[0] for r in got if r[2]} == {92, *range(len(texts))}
