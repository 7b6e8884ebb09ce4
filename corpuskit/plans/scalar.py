"""Projections, filters and scalar functions (P*, F*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.functions import arrays, prompts
from corpuskit.functions import text as tx
from corpuskit.functions import vectors as vec
from corpuskit.operators import cleaning, rows
from corpuskit.plans.registry import query, table

BLANK = r"[\s\x0b\p{Z}\x1c-\x1f\x{85}]"


def strip_sql(c: str) -> str:
    return rf"regexp_replace({c}, '\A{BLANK}+|{BLANK}+\z', '', 'g')"


SENTENCES = """(SELECT doc_id, lang, unnest(l) AS sentence, CAST(unnest(range(len(l))) AS INTEGER) AS pos
  FROM (SELECT doc_id, lang, string_split(translate(text, '!?', '..'), '.') AS l FROM documents))"""
WORDS = r"regexp_extract_all(lower(text), '([\p{L}\p{N}]+)', 1)"


def _sentences(spark, sf):
    docs = table(spark, sf, "documents")
    return cleaning.sentence_rows(docs, ["doc_id", "lang"], "text", extra_marks="!?", mark=".")


@query("p1_select_columns", "SELECT n_nationkey, n_name FROM nation")
def _(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", "n_name")


@query("p2_rename_columns", "SELECT doc_id AS id, text AS query, lang AS label, source, n_chars FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").withColumnsRenamed({"doc_id": "id", "text": "query", "lang": "label"})


@query("p3_drop_columns", "SELECT doc_id, lang, source FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").drop("text", "n_chars")


@query("p4_constant_column", "SELECT doc_id, 'Find passages for: ' AS prompt FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.lit("Find passages for: ").alias("prompt"))


@query(
    "p5_string_ids",
    "SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS VARCHAR) AS id FROM documents",
)
def _(spark, sf):
    return rows.string_ids(table(spark, sf, "documents").select("doc_id"), "doc_id")


@query(
    "p6_drop_null_strip",
    f"SELECT doc_id, {strip_sql('text')} AS text FROM documents WHERE text IS NOT NULL",
)
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.where(F.col("text").isNotNull()).select("doc_id", tx.strip(F.col("text")).alias("text"))


@query(
    "p7_text_or_empty",
    """SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), '') AS quality
    FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    joined = docs.join(table(spark, sf, "labels"), "doc_id", "left")
    return joined.select("doc_id", tx.text_or_empty(F.col("quality")).alias("quality"))


@query(
    "p8_contains_digit",
    rf"""SELECT doc_id, pos, sentence FROM {SENTENCES}
    WHERE regexp_matches(sentence, '{tx.DIGIT_CLASS}')""",
)
def _(spark, sf):
    return _sentences(spark, sf).where(tx.has_digit(F.col("sentence"))).select("doc_id", "pos", "sentence")


@query(
    "p9_length_range",
    f"SELECT doc_id, pos, sentence FROM {SENTENCES} WHERE length(sentence) BETWEEN 8 AND 1000",
)
def _(spark, sf):
    return _sentences(spark, sf).where(tx.length_within(F.col("sentence"))).select("doc_id", "pos", "sentence")


@query(
    "p10_drop_headings",
    rf"""WITH s AS (SELECT doc_id, pos, sentence, substring({strip_sql('sentence')}, 1, 5) AS head FROM {SENTENCES})
    SELECT doc_id, pos, sentence FROM s
    WHERE NOT (starts_with(head, 'T') AND (contains(head, 'h') OR contains(head, 'i')))""",
)
def _(spark, sf):
    keep = tx.not_heading(F.col("sentence"), prefix="T", markers="hi")
    return _sentences(spark, sf).where(keep).select("doc_id", "pos", "sentence")


@query(
    "p11_drop_titles",
    f"""SELECT doc_id, pos, sentence FROM {SENTENCES}
    WHERE NOT (length(sentence) <= 45 AND contains(sentence, 'the') AND contains(sentence, 'in'))""",
)
def _(spark, sf):
    keep = tx.not_title(F.col("sentence"), phrases=("the", "in"))
    return _sentences(spark, sf).where(keep).select("doc_id", "pos", "sentence")


def clean_sentence_report(spark, sf):
    sentence = F.col("sentence")
    filters = {
        "digit": ~tx.has_digit(sentence),
        "length": tx.length_within(sentence),
        "title": tx.not_title(sentence, phrases=("the", "in")),
    }
    return cleaning.filter_report(_sentences(spark, sf), ["lang"], filters)


query(
    "p12_filter_chain",
    rf"""WITH s AS (SELECT lang,
        regexp_matches(sentence, '{tx.DIGIT_CLASS}') AS digit,
        NOT (length(sentence) BETWEEN 8 AND 1000) AS len,
        length(sentence) <= 45 AND contains(sentence, 'the') AND contains(sentence, 'in') AS title FROM {SENTENCES})
    SELECT lang, count(*) FILTER (WHERE NOT digit AND NOT len AND NOT title) AS kept,
        count(*) FILTER (WHERE digit) AS dropped_digit,
        count(*) FILTER (WHERE NOT digit AND len) AS dropped_length,
        count(*) FILTER (WHERE NOT digit AND NOT len AND title) AS dropped_title
    FROM s GROUP BY lang""",
)(clean_sentence_report)


@query("p13_min_length", "SELECT p_partkey, p_name FROM part WHERE length(p_name) > 10")
def _(spark, sf):
    return table(spark, sf, "part").where(F.length("p_name") > 10).select("p_partkey", "p_name")


@query("p14_contains_prefilter", "SELECT doc_id, text FROM documents WHERE coalesce(contains(text, ', '), false)")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.where(tx.contains_text(F.col("text"), ", ")).select("doc_id", "text")


@query(
    "p15_known_parties",
    """WITH t AS (SELECT DISTINCT unnest(string_split(text, ', ')) AS name FROM benchmark),
    d AS (SELECT doc_id, list_filter(string_split(text, ', '), lambda x: length(x) >= 4) AS names
          FROM documents WHERE contains(text, ', ')),
    e AS (SELECT doc_id, unnest(names) AS name FROM d WHERE len(names) >= 2)
    SELECT DISTINCT doc_id FROM e WHERE name IN (SELECT name FROM t)""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    targets = table(spark, sf, "benchmark").select(F.explode(F.split("text", ", ", -1)).alias("name"))
    return cleaning.with_known_parties(docs, "doc_id", "text", targets, "name", separator=", ").select("doc_id")


@query(
    "p16_character_range",
    r"""SELECT doc_id, CAST(regexp_matches(text, '[\x{4e00}-\x{9fff}]') AS INTEGER) AS has_cjk,
    CAST(regexp_matches(text, '[\x{c0}-\x{ff}]') AS INTEGER) AS has_latin1_letter FROM documents""",
)
def _(spark, sf):
    c = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        tx.has_character_in(c).cast("int").alias("has_cjk"),
        tx.has_character_in(c, 0xC0, 0xFF).cast("int").alias("has_latin1_letter"),
    )


@query(
    "p18_conditional_address",
    """SELECT n_nationkey, CASE WHEN trim(r_name) = trim(n_name) THEN trim(n_name)
        ELSE trim(r_name) || trim(n_name) END AS address
    FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def _(spark, sf):
    places = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    outer, inner = tx.strip(F.col("r_name")), tx.strip(F.col("n_name"))
    return places.select("n_nationkey", F.when(outer == inner, inner).otherwise(F.concat(outer, inner)).alias("address"))


@query(
    "p19_table_profile",
    """SELECT count(*) AS rows, 5 AS columns, count(*) FILTER (WHERE c_name IS NOT NULL AND c_acctbal IS NOT NULL) AS valid_rows,
    count(c_custkey) AS filled_c_custkey, count(c_name) AS filled_c_name, count(c_nationkey) AS filled_c_nationkey,
    count(c_acctbal) AS filled_c_acctbal, count(c_mktsegment) AS filled_c_mktsegment FROM customer""",
)
def _(spark, sf):
    return cleaning.profile(table(spark, sf, "customer"), ["c_name", "c_acctbal"])


# Page-number lines are put between two copies of the text, since the given documents have none.
PAGED = r"""(SELECT doc_id, text || E'\n- 12 -  \n' || source || E'\n— 7 — \n' || lang || E'\nIII\n' || text || E'\n' || doc_id || E' \n' || lang AS text
  FROM documents)"""


@query(
    "f1_remove_page_numbers",
    rf"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
      '\n- \p{{Nd}}+ - *\n', '', 'g'), '\n— \p{{Nd}}+ — *\n', '', 'g'), '\n\p{{Nd}}+ *\n', '', 'g'), '\nI+ *\n', '', 'g') AS text
    FROM {PAGED}""",
)
def _(spark, sf):
    paged = F.concat(
        "text", F.lit("\n- 12 -  \n"), "source", F.lit("\n— 7 — \n"), "lang", F.lit("\nIII\n"),
        "text", F.lit("\n"), F.col("doc_id").cast("string"), F.lit(" \n"), "lang",
    )
    return table(spark, sf, "documents").select("doc_id", tx.remove_page_numbers(paged).alias("text"))


@query(
    "f2_remove_junk",
    r"""SELECT doc_id, replace(replace(translate(text || E'目\n录\n' || chr(12288) || lang,
       chr(160) || chr(9) || chr(12288) || ' ' || chr(65279) || chr(8194) || chr(8203), ''), E'目\n录\n', ''), E'\n', '') AS text
    FROM documents""",
)
def _(spark, sf):
    raw = F.concat("text", F.lit(tx.CONTENTS_HEADING), F.lit("　"), "lang")
    return table(spark, sf, "documents").select("doc_id", tx.remove_junk(raw).alias("text"))


@query("f3_cut_sentences", f"SELECT doc_id, lang, pos, sentence FROM {SENTENCES}")
def _(spark, sf):
    return _sentences(spark, sf)


@query(
    "f4_remove_parenthesised",
    "SELECT doc_id, regexp_replace(translate(text, ',.', '（）'), '（.*?）', '', 'g') AS text FROM documents",
)
def _(spark, sf):
    marked = F.translate("text", ",.", "（）")
    return table(spark, sf, "documents").select("doc_id", tx.remove_parenthesised(marked).alias("text"))


@query(
    "f5_strip",
    f"SELECT doc_id, {strip_sql('chr(12288) || chr(9) || text || chr(160) || chr(10)')} AS text FROM documents",
)
def _(spark, sf):
    wrapped = F.concat(F.lit("　\t"), "text", F.lit("\xa0\n"))
    return table(spark, sf, "documents").select("doc_id", tx.strip(wrapped).alias("text"))


@query(
    "f6_normalised_equality",
    """WITH k AS (SELECT p_partkey, translate(lower(trim(p_name)), '-:：', '') AS a,
        translate(lower(trim(' ' || upper(p_name) || ': ')), '-:：', '') AS b, translate(lower(trim(p_type)), '-:：', '') AS c FROM part)
    SELECT p_partkey, CAST(a = b AS INTEGER) AS same_name, CAST(a = c AS INTEGER) AS same_type FROM k""",
)
def _(spark, sf):
    name = tx.match_key(F.col("p_name"))
    shouted = tx.match_key(F.concat(F.lit(" "), F.upper("p_name"), F.lit(": ")))
    return table(spark, sf, "part").select(
        "p_partkey",
        (name == shouted).cast("int").alias("same_name"),
        (name == tx.match_key(F.col("p_type"))).cast("int").alias("same_type"),
    )


@query(
    "f7_zero_pad",
    """SELECT p_partkey, CASE WHEN length(CAST(p_partkey * 7 AS VARCHAR)) < 4 THEN lpad(CAST(p_partkey * 7 AS VARCHAR), 4, '0')
        ELSE CAST(p_partkey * 7 AS VARCHAR) END AS code FROM part""",
)
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", tx.zero_pad(F.col("p_partkey") * 7).alias("code"))


@query(
    "f8_slice_text",
    """SELECT doc_id, substring(text, CAST(n_chars // 3 AS INTEGER) + 1, CAST(n_chars // 2 - n_chars // 3 AS INTEGER)) AS part,
      substring(text, greatest(length(text) - 90, 0) + 1, greatest(length(text) - 5, 0) - greatest(length(text) - 90, 0)) AS tail,
      substring(text, greatest(length(text) - 90, 0) + 1, greatest(40 - greatest(length(text) - 90, 0), 0)) AS both
    FROM documents""",
)
def _(spark, sf):
    start, end = F.floor(F.col("n_chars") / 3).cast("int"), F.floor(F.col("n_chars") / 2).cast("int")
    cut = lambda a, b: tx.slice_text(F.col("text"), a, b)
    ends = [cut(start, end).alias("part"), cut(F.lit(-90), F.lit(-5)).alias("tail"), cut(F.lit(-90), F.lit(40)).alias("both")]
    return table(spark, sf, "documents").select("doc_id", *ends)


@query(
    "f9_find_text",
    """SELECT doc_id, CAST(strpos(text, lang) - 1 AS INTEGER) AS start,
        CAST(CASE WHEN strpos(text, lang) = 0 THEN -1 ELSE strpos(text, lang) - 1 + length(lang) END AS INTEGER) AS end FROM documents""",
)
def _(spark, sf):
    found = table(spark, sf, "documents").select("doc_id", tx.find_text(F.col("text"), F.col("lang")).alias("hit"))
    return found.select("doc_id", "hit.start", "hit.end")


@query(
    "f13_extract_key",
    r"SELECT page_id, coalesce(nullif(regexp_extract(url, 'page=(\d+)', 1), ''), 'none') AS page_no FROM pages",
)
def _(spark, sf):
    key = F.nullif(F.regexp_extract("url", r"page=(\d+)", 1), F.lit(""))
    return table(spark, sf, "pages").select("page_id", F.coalesce(key, F.lit("none")).alias("page_no"))


FIRM_TEMPLATE = "- Firm: {name}\n- Segment: {segment}\nAnswer as {{\"label\": ...}}."


@query(
    "f14_render_template",
    r"""SELECT c_custkey, E'- Firm: ' || coalesce(c_name, '') || E'\n- Segment: ' || coalesce(c_mktsegment, '')
      || E'\nAnswer as {"label": ...}.' AS prompt FROM customer""",
)
def _(spark, sf):
    text = prompts.render(FIRM_TEMPLATE, {"name": F.col("c_name"), "segment": F.col("c_mktsegment")})
    return table(spark, sf, "customer").select("c_custkey", text.alias("prompt"))


@query(
    "f15_partial_template",
    r"""SELECT c_custkey, E'- Firm: ' || coalesce(c_name, '') || E'\n- Segment: any {kind}'
      || E'\nAnswer as {"label": ...}.' AS prompt FROM customer""",
)
def _(spark, sf):
    bound = prompts.bind(FIRM_TEMPLATE, segment="any {kind}")
    return table(spark, sf, "customer").select("c_custkey", prompts.render(bound, {"name": F.col("c_name")}).alias("prompt"))


@query(
    "f16_few_shot_prompt",
    r"""WITH ex AS (SELECT item_id, E'Text: ' || text || E'\nId: ' || item_id AS t FROM benchmark ORDER BY item_id LIMIT 3),
    block AS (SELECT string_agg(t, E'\n\n' ORDER BY item_id) AS t FROM ex)
    SELECT doc_id, E'Number the text.\n\n' || (SELECT t FROM block) || E'\n\nText: ' || text || E'\nId:' AS prompt FROM documents""",
)
def _(spark, sf):
    examples = prompts.example_block(table(spark, sf, "benchmark"), "Text: {text}\nId: {item_id}", "item_id", k=3)
    text = prompts.few_shot("Number the text.", examples, "Text: {text}\nId:", {"text": F.col("text")})
    return table(spark, sf, "documents").select("doc_id", text.alias("prompt"))


@query("f17_escape_braces", "SELECT event_id, replace(replace(props, '{', '{{'), '}', '}}') AS props FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", prompts.escape_braces(F.col("props")).alias("props"))


@query("f18_replace_keyword", r"SELECT doc_id, replace(E'Classify:\n<text>\nLabel:', '<text>', text) AS prompt FROM documents")
def _(spark, sf):
    text = prompts.replace_keyword("Classify:\n<text>\nLabel:", "<text>", F.col("text"))
    return table(spark, sf, "documents").select("doc_id", text.alias("prompt"))


@query(
    "f20_file_stem",
    "SELECT page_id, string_split(string_split(url, '/')[-1], '.')[1] AS stem FROM pages",
)
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.file_stem(F.col("url")).alias("stem"))


@query(
    "f21_probability_flag",
    "SELECT c_custkey, CAST(c_acctbal / 1000 >= 0 AS INTEGER) AS flag FROM customer",
)
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", arrays.probability_flag(F.col("c_acctbal") / 1000).alias("flag"))


@query("f22_arg_max", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS best FROM embeddings")
def _(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", arrays.arg_max(F.col("embedding")).alias("best"))


CATALOGUE = ["the", "and", "la", "die", "el", "with"]
CATALOGUE_SQL = "['the', 'and', 'la', 'die', 'el', 'with']"


@query(
    "f23_multi_hot",
    f"""SELECT doc_id, array_to_string(list_transform({CATALOGUE_SQL}, lambda c: CAST(list_contains({WORDS}, c) AS INTEGER)), ',') AS flags
    FROM documents""",
)
def _(spark, sf):
    flags = arrays.multi_hot(F.col("words"), CATALOGUE)
    docs = table(spark, sf, "documents").select("doc_id", tx.words(F.col("text")).alias("words"))
    return docs.select("doc_id", F.array_join(flags.cast("array<string>"), ",").alias("flags"))


@query(
    "f24_last_number",
    r"""WITH t AS (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name || ' cited by ' || p_size ELSE p_name END AS line FROM part)
    SELECT p_partkey, coalesce(TRY_CAST(string_split(line, ' ')[-1] AS INTEGER), 0) AS cited_by FROM t""",
)
def _(spark, sf):
    cited = F.concat("p_name", F.lit(" cited by "), F.col("p_size").cast("string"))
    line = F.when(F.col("p_size") % 2 == 0, cited).otherwise(F.col("p_name"))
    return table(spark, sf, "part").select("p_partkey", tx.last_number(line).alias("cited_by"))


def _html_sql(pattern: str) -> str:
    bare = strip_sql(f"regexp_replace(regexp_extract(html, '{pattern}', 1), '<[^>]*>', '', 'g')")
    return f"coalesce(nullif({bare}, ''), 'N/A')"


@query(
    "f25_html_fields",
    f"""SELECT page_id, {_html_sql('(?s)<title>(.*?)</title>')} AS title, {_html_sql('<a href="([^"]*)"')} AS link,
    {_html_sql('(?s)<p>(.*?)</p>')} AS snippet FROM pages""",
)
def _(spark, sf):
    fields = tx.html_fields(F.col("html"))
    return table(spark, sf, "pages").select("page_id", *[c.alias(name) for name, c in fields.items()])


@query(
    "f26_prefix_instruction",
    """SELECT doc_id, 'query: ' || text AS query,
      array_to_string(list_transform(string_split(text, '.'), lambda p: 'passage: ' || p), '|') AS passages FROM documents""",
)
def _(spark, sf):
    passages = prompts.with_instruction_each("passage: ", F.split("text", r"\.", -1))
    return table(spark, sf, "documents").select(
        "doc_id",
        prompts.with_instruction("query: ", F.col("text")).alias("query"),
        F.array_join(passages, "|").alias("passages"),
    )


@query(
    "f27_known_labels",
    f"SELECT doc_id, array_to_string(list_filter({WORDS}, lambda w: list_contains({CATALOGUE_SQL}, w)), ' ') AS clue FROM documents",
)
def _(spark, sf):
    known = arrays.known_labels(tx.words(F.col("text")), CATALOGUE)
    return table(spark, sf, "documents").select("doc_id", F.array_join(known, " ").alias("clue"))


@query(
    "f28_next_token_labels",
    f"""WITH t AS (SELECT doc_id, list_transform({WORDS}, lambda w: length(w)) AS ids FROM documents)
    SELECT doc_id, CASE WHEN len(ids) = 0 THEN '' ELSE array_to_string(list_append(ids[2:], -100), ',') END AS labels FROM t""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.transform(tx.words(F.col("text")), F.length).alias("ids"))
    labels = arrays.next_token_labels(F.col("ids")).cast("array<string>")
    return docs.select("doc_id", F.array_join(labels, ",").alias("labels"))


@query(
    "f29_fixed_length",
    f"""WITH t AS (SELECT doc_id, list_transform({WORDS}[1:64], lambda w: length(w)) AS ids FROM documents)
    SELECT doc_id, array_to_string(list_concat(ids, list_transform(range(64 - len(ids)), lambda i: CAST(0 AS BIGINT))), ',') AS ids FROM t""",
)
def _(spark, sf):
    from corpuskit.operators import tokens

    docs = table(spark, sf, "documents").select("doc_id", F.transform(tx.words(F.col("text")), F.length).alias("ids"))
    return tokens.padded_to(docs, "ids", 64).select("doc_id", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query(
    "f29_pad_batches",
    f"""WITH t AS (SELECT doc_id, list_transform({WORDS}, lambda w: length(w)) AS ids,
        CAST((row_number() OVER (ORDER BY doc_id) - 1) // 8 AS BIGINT) AS batch FROM documents),
    m AS (SELECT *, CAST(ceil(max(len(ids)) OVER (PARTITION BY batch) / 8.0) * 8 AS INTEGER) AS width FROM t)
    SELECT doc_id, batch, width, CAST(width - len(ids) AS INTEGER) AS padding,
      array_to_string(list_concat(ids, list_transform(range(width - len(ids)), lambda i: CAST(0 AS BIGINT))), ',') AS input_ids,
      array_to_string(list_concat(ids, list_transform(range(width - len(ids)), lambda i: CAST(-100 AS BIGINT))), ',') AS labels FROM m""",
)
def _(spark, sf):
    from corpuskit.operators import tokens

    docs = table(spark, sf, "documents").select("doc_id", F.transform(tx.words(F.col("text")), F.length).alias("ids"))
    padded = tokens.padded_batches(docs, "doc_id", "ids", batch_size=8, multiple_of=8)
    return padded.select(
        "doc_id", "batch", "width", "padding",
        F.array_join(F.col("input_ids").cast("array<string>"), ",").alias("input_ids"),
        F.array_join(F.col("labels").cast("array<string>"), ",").alias("labels"),
    )


EMB = "CAST(embedding AS DOUBLE[])"


@query(
    "f30_unit_vector",
    f"""WITH t AS (SELECT vec_id, {EMB} AS v FROM embeddings),
    u AS (SELECT vec_id, v, greatest(sqrt(list_inner_product(v, v)), 1e-12) AS n FROM t)
    SELECT vec_id, CAST(unnest(range(len(v))) AS INTEGER) AS pos, round(unnest(v) / n, 6) AS x FROM u""",
)
def _(spark, sf):
    unit = table(spark, sf, "embeddings").select("vec_id", vec.unit(F.col("embedding")).alias("v"))
    return unit.select("vec_id", F.posexplode("v").alias("pos", "x")).withColumn("x", F.round("x", 6))


PAIRED = f"""(SELECT a.vec_id, {EMB.replace('embedding', 'a.embedding')} AS a, {EMB.replace('embedding', 'b.embedding')} AS b
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"""


def _neighbours(spark, sf):
    left = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("a"))
    right = table(spark, sf, "embeddings").select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return left.join(right, "vec_id")


@query(
    "f31_row_similarity",
    f"""SELECT vec_id, round(list_inner_product(a, b), 6) AS dot,
      round(list_inner_product(a, b) / (sqrt(list_inner_product(a, a)) * sqrt(list_inner_product(b, b))), 6) AS cosine FROM {PAIRED}""",
)
def _(spark, sf):
    a, b = F.col("a"), F.col("b")
    return _neighbours(spark, sf).select(
        "vec_id", F.round(vec.dot(a, b), 6).alias("dot"), F.round(vec.cosine(a, b), 6).alias("cosine")
    )


@query(
    "f32_vector_gap",
    f"SELECT vec_id, round(list_max(list_transform(range(1, len(a) + 1), lambda i: abs(a[i] - b[i]))), 6) AS gap FROM {PAIRED}",
)
def _(spark, sf):
    gap = vec.largest_gap(F.col("a"), F.col("b"))
    return _neighbours(spark, sf).select("vec_id", F.round(gap, 6).alias("gap"))
