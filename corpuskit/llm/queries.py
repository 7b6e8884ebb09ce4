"""One query per operator, over its whole table with production parameters. The digests are derived here from real outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm import audit, bpe, decontamination, jaccard, language, licenses, manifest, passages, pii, simhash, suffixes, token_files, topk, warc
from corpuskit.llm.registry import query
from corpuskit.llm.sql import OP6, OP7, OP8, OP9, OP11, OP12
from corpuskit.session import cut_lineage, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def ids_text(ids: str = "ids"):
    return F.array_join(F.col(ids).cast("array<string>"), ",")


@query("op1_repeated_strings")
def op1(spark, sf_dir):
    docs = documents(spark, sf_dir)
    rows, spans, texts = suffixes.repeats(docs, beside=passages.candidates(docs))
    cut = suffixes.cut_out(texts, spans).select("row", "n_removed", "n_spans", F.sha2("kept", 256).alias("cut_sha256"))
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    whole = rows.select("row", "doc_id", F.octet_length(raw).cast("bigint").alias("n_bytes"), F.sha2(raw, 256).alias("whole_sha256"))
    return whole.join(cut, "row", "left").join(passages.shared_bytes(texts), "row", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"),
        F.coalesce("n_passage_bytes", F.lit(0)).cast("bigint").alias("n_passage_bytes"),
    )


@query("op2_byte_bpe")
def op2(spark, sf_dir):
    coded = bpe.encoded(documents(spark, sf_dir))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids_text(), 256).alias("ids_sha256"),
        F.sha2(bpe.decoded(F.col("ids")), 256).alias("decoded_sha256"),
    )


@query("op3_personal_data")
def op3(spark, sf_dir):
    found = pii.spans(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s.kind.isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id",
        *[pii.count_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(pii.written(base), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


@query("op4_simhash")
def op4(spark, sf_dir):
    linked = simhash.components(documents(spark, sf_dir))
    return linked.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query("op8_decontamination", OP8)
def op8(spark, sf_dir):
    hits = decontamination.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: What stands between the tags of a page is markup if it is a script, a style, a comment or a tag.
MARKUP = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>|&[a-z]+;|&#[0-9]+;"


@query("op10_language_id")
def op10(spark, sf_dir):
    """Documents (host: source) and pages (host and suffix of the address, language of the markup) in one table."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, "text", "lang")
    rows = docs.select("doc_id", F.lit(None).cast("bigint").alias("page_id"), "text", F.col("lang").alias("declared"),
                       F.col("source").alias("host"), F.lit("").alias("suffix"))
    host = F.parse_url("url", F.lit("HOST"))
    pages = table(spark, sf_dir, "pages").select(
        F.lit(None).cast("bigint").alias("doc_id"),
        "page_id",
        F.regexp_replace("html", MARKUP, " ").alias("text"),
        F.regexp_extract("html", r"""(?i)<html[^>]*?\blang=["']?([A-Za-z-]+)""", 1).alias("declared"),
        host.alias("host"),
        F.element_at(F.split(host, r"\."), -1).alias("suffix"),
    )
    both = rows.unionByName(pages)
    weighed = language.evidence(both, model, "text", F.col("declared"), F.col("host"), F.col("suffix"))
    slim = language.kept(weighed.drop("text", "host", "suffix"))
    named = language.fused(slim, slim, model.languages)
    return named.select("doc_id", "page_id", "declared", "language", F.round("confidence", 6).alias("confidence"), "accepted")


@query("op5_token_files")
def op5(spark, sf_dir):
    path = scratch_path(spark, "tokens")
    token_files.write(documents(spark, sf_dir), path)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))


@query("op6_license_scan", OP6)
def op6(spark, sf_dir):
    found = licenses.scan(documents(spark, sf_dir))
    return found.select("doc_id", "text_digest", "license", F.array_join("notices", ",").alias("notices"))


def damaged(pages: DataFrame) -> DataFrame:
    """A second replica with faults at fixed ids: a changed first letter, a cut end, a lost record."""
    kept = pages.filter("page_id % 211 != 3 OR page_id IS NULL")
    html = F.when(F.col("page_id") % 50 == 7, F.concat(F.lit("#"), F.expr("substring(html, 2)")))
    html = html.when(F.col("page_id") % 83 == 5, F.expr("left(html, length(html) - 1)"))
    return kept.withColumn("html", html.otherwise(F.col("html")))


@query("op7_warc_fixity", OP7)
def op7(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.audit(warc.stored(pages), warc.stored(damaged(pages)))


@query("op9_exact_top_k", OP9)
def op9(spark, sf_dir):
    rows = topk.usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(rows.filter("id % 20 = 0"), rows)


#: What a row's leaf covers, in this order.
LEAF = ["doc_id", "source", "lang", "n_chars", "text"]


def tampered(text, doc_id):
    """Every second document (by a checksum of its id) loses its line breaks."""
    return F.when(F.crc32(doc_id.cast("string")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit("")))


def leaves_of(docs: DataFrame) -> DataFrame:
    """Leaves of documents; every second row with an id, by a checksum of it, is tampered with: its text loses the line breaks."""
    columns = [F.col(c) for c in LEAF]
    odd = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    bent = F.when(odd, manifest.leaf(*columns[:-1], F.replace("text", F.lit("\n"), F.lit(""))))
    made = docs.select(F.col("source").alias("grp"), F.col("doc_id").alias("key"), manifest.leaf(*columns).alias("digest"), bent.alias("bent"))
    return cut_lineage(made, "leaves")


@query("op11_merkle_manifest", OP11)
def op11(spark, sf_dir):
    out = manifest.folded(leaves_of(table(spark, sf_dir, "documents").select(*LEAF)))
    verified = F.col("folded_root") == F.col("root")
    return out.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", verified.alias("verified"))


#: Failing conditions of the audited filters over a whole text and its words; E, later copies, needs the other rows.
TEXT_TESTS = {
    "A": lambda text, words: F.size(words) < 50,
    "B": lambda text, words: F.size(F.array_distinct(words)) * 100 < F.size(words) * 65,
    "C": lambda text, words: F.char_length(F.regexp_replace(text, "[^A-Z]+", "")) * 100 > F.char_length(text) * 5,
    "D": lambda text, words: text.rlike("[#$%&*|]"),
}


@query("op12_filter_audit", OP12)
def op12(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("words", audit.words(F.col("text")))
    tests = {name: test(F.col("text"), F.col("words")) for name, test in TEXT_TESTS.items()}
    rows = audit.identified(docs, "doc_id", "source", tests, F.col("text"))
    tables = audit.failing_tables(rows, list(tests), copies="E")
    given = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("key"), "quality", "toxic")
    labels = {"good": given.filter("quality = 1"), "toxic": given.filter("toxic = 1")}
    return audit.steps(audit.interactions(rows, tables, labels), "ABCDE", {"good": "good_lost", "toxic": "toxic_lost"})


@query("op13_jaccard_join")
def op13(spark, sf_dir):
    return jaccard.components(documents(spark, sf_dir))
