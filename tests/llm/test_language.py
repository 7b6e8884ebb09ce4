from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.llm import language
from tests.llm import cases


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet")
    model = language.fit(docs.filter("doc_id % 2 = 0"), "text", "lang")
    held = docs.filter("doc_id % 2 = 1")
    none = F.lit(None).cast("string")
    weighed = language.evidence(held, model, "text", none, none, none)
    got = language.fused(weighed, weighed, model.languages).agg(F.avg((F.col("language") == F.col("lang")).cast("double"))).first()[0]
    assert got > 0.97


def test_evidence_outweighs_a_short_text(spark):
    english = [("the river and the stone of the old house with the garden", "en")] * 20
    french = [("la maison et le jardin de la ville avec les rues du vieux port", "fr")] * 20
    model = language.fit(spark.createDataFrame(english + french, "text string, lang string"), "text", "lang", ("en", "fr"))
    rows = [(i, french[0][0], "fr", "a.fr", "fr") for i in range(200)] + [(900, "xyz", "fr", "a.fr", "fr"), (901, "xyz", "en", "b.com", "com")]
    rows += [(902, english[0][0], "fr", "a.fr", "fr"), (903, None, None, None, None), (904, "", "fr", "a.fr", "fr")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, declared string, host string, suffix string")
    weighed = language.evidence(df, model, "text", F.col("declared"), F.col("host"), F.col("suffix"))
    for most in (100, 0):
        got = {r["doc_id"]: r for r in language.fused(weighed, weighed, ("en", "fr"), most).collect()}
        assert len(got) == len(rows)
        assert got[902]["language"] == "en" and got[0]["language"] == "fr"
        assert got[903]["language"] == got[904]["language"] == "und" and not got[903]["accepted"]
    prior, logs = language.priors(weighed.select("__e.*"), ("en", "fr"))
    of = {r["host"]: r["prior"] for r in prior.collect()}
    assert of["a.fr"][1] > 0.9 and of["b.com"][1] < of["a.fr"][1] and logs["fr"][1] > logs["fr"][0]


def test_rows(spark):
    df = cases.frame(spark)
    model = language.fit(df, "text", "lang")
    weighed = language.evidence(df, model, "text", F.col("lang"), F.col("source"), F.lit(None))
    out = language.fused(weighed, weighed, model.languages)
    assert out.count() == df.count() and {"language", "confidence", "accepted"} <= set(out.columns)
    none = cases.empty(spark)
    empty_model = language.fit(none, "text", "lang")
    weighed = language.evidence(none, empty_model, "text", F.col("lang"), F.col("source"), F.lit(None))
    assert language.fused(weighed, weighed, empty_model.languages).count() == 0
