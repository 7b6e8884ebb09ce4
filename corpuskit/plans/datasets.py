"""Dataset builders and annotation conversions (D*, J5, E6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.functions import arrays, parsing, prompts
from corpuskit.functions import text as tx
from corpuskit.operators import annotations, datasets, dialogue, lookups, rows, tokens
from corpuskit.plans.ordered import DRAW, shuffled_sql
from corpuskit.plans.registry import query, table
from corpuskit.plans.relations import EVENT_TYPES
from corpuskit.plans.scalar import CATALOGUE, CATALOGUE_SQL, WORDS

SYSTEM = "Put the text into one of these categories:\n{categories}\nAnswer with the category only."


@query(
    "d1_class_records",
    r"""SELECT doc_id, E'Put the text into one of these categories:\n"en"\n"fr"\n"de"\n"es"\n"Unknown"\nAnswer with the category only.' AS instruction,
      E'Text:\n' || text AS input, lang AS output FROM documents""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    out = datasets.class_records(docs, "text", F.col("lang"), ["en", "fr", "de", "es", "Unknown"], SYSTEM, "Text:\n{input}")
    return out.select("doc_id", "instruction", "input", "output")


@query(
    "d2_keyword_records",
    r"SELECT doc_id, E'Language of:\n' || text || E'\n?' AS instruction, '' AS input, lang AS output FROM documents",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return datasets.keyword_records(docs, "text", "lang", "Language of:\n<text>\n?", "<text>")


# Annotated spans: the first occurrence of a few words in each document.
SPAN_WORDS = [("article", "the "), ("article", "la "), ("link", " and "), ("link", " et "), ("other", "zz")]
SPANS_SQL = (
    "list_filter(["
    + ", ".join(
        f"{{'start': strpos(text, '{w}') - 1, 'end': strpos(text, '{w}') - 1 + {len(w)}, 'label': '{c}'}}" for c, w in SPAN_WORDS
    )
    + "], lambda s: s.start >= 0)"
)


def _spans(text):
    found = [
        F.struct(
            (F.position(F.lit(w), text) - 1).cast("int").alias("start"),
            (F.position(F.lit(w), text) - 1 + len(w)).cast("int").alias("end"),
            F.lit(c).alias("label"),
        )
        for c, w in SPAN_WORDS
    ]
    return F.filter(F.array(*found), lambda s: s["start"] >= 0)


SCHEMA = ["article", "link", "number"]


def _class_json(name: str) -> str:
    texts = f"list_transform(list_filter(spans, lambda s: s.label = '{name}'), lambda s: '\"' || substring(text, CAST(s.start + 1 AS INTEGER), CAST(s.end - s.start AS INTEGER)) || '\"')"
    return f"'\"{name}\":[' || coalesce(array_to_string({texts}, ','), '') || ']'"


@query(
    "d3_extraction_records",
    rf"""WITH t AS (SELECT doc_id, text, {SPANS_SQL} AS spans FROM documents)
    SELECT doc_id, 'Find article, link, number in: ' || text AS instruction, '' AS input,
      '{{' || {_class_json('article')} || ',' || {_class_json('link')} || ',' || {_class_json('number')} || '}}' AS output
    FROM t WHERE len(list_filter(spans, lambda s: s.label = 'other')) = 0""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", _spans(F.col("text")).alias("spans"))
    records, _ = annotations.extraction_records(docs, "text", "spans", SCHEMA, "Find {schema} in: {text}")
    return records


@query(
    "d3_unknown_class_rows",
    f"""WITH t AS (SELECT doc_id, {SPANS_SQL} AS spans FROM documents)
    SELECT doc_id, CAST(len(spans) AS INTEGER) AS n FROM t WHERE len(list_filter(spans, lambda s: s.label = 'other')) > 0""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", _spans(F.col("text")).alias("spans"))
    _, aside = annotations.extraction_records(docs, "text", "spans", SCHEMA, "Find {schema} in: {text}")
    return aside.select("doc_id", F.size("spans").alias("n"))


def _annotated(spark, sf):
    """Entities with ids, and a relation from each entity to the next one; the last relation points to no entity."""
    docs = table(spark, sf, "documents").select("doc_id", "text", _spans(F.col("text")).alias("spans"))
    entities = F.transform(
        "spans",
        lambda s, i: F.struct(
            (i + 1).alias("id"), s["label"].alias("label"), s["start"].alias("start_offset"), s["end"].alias("end_offset")
        ),
    )
    relations = F.transform(
        "spans",
        lambda s, i: F.struct((i + 1).alias("id"), (i + 1).alias("from_id"), (i + 2).alias("to_id"), F.lit("next").alias("type")),
    )
    return docs.select("doc_id", "text", entities.alias("entities"), relations.alias("relations"))


ENTITIES_SQL = f"""(SELECT doc_id, i, s.label AS label, substring(text, CAST(s.start + 1 AS INTEGER), CAST(s.end - s.start AS INTEGER)) AS name
  FROM (SELECT doc_id, text, unnest(range(1, len(spans) + 1)) AS i, unnest(spans) AS s FROM (SELECT doc_id, text, {SPANS_SQL} AS spans FROM documents)))"""


@query(
    "d4_entities",
    f"SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, name AS entity, label AS entity_type FROM {ENTITIES_SQL}",
)
def _(spark, sf):
    named = annotations.named_entities(F.col("text"), F.col("entities"))
    return _annotated(spark, sf).select("doc_id", F.posexplode(named).alias("pos", "e")).select("doc_id", "pos", "e.entity", "e.entity_type")


@query(
    "j5_triples",
    f"""SELECT h.doc_id, h.name AS head, h.label AS head_type, 'next' AS relation, coalesce(t.name, '?') AS tail, coalesce(t.label, '?') AS tail_type
    FROM {ENTITIES_SQL} h LEFT JOIN {ENTITIES_SQL} t ON t.doc_id = h.doc_id AND t.i = h.i + 1""",
)
def _(spark, sf):
    found = annotations.triples(F.col("text"), F.col("entities"), F.col("relations"))
    out = _annotated(spark, sf).select("doc_id", F.explode(found).alias("t")).select("doc_id", "t.*")
    return out.fillna("?", ["tail", "tail_type"])


@query(
    "d5_spans_from_predictions",
    f"""WITH p AS (SELECT doc_id, text, unnest([1, 2, 3]) AS c, unnest([['the ', 'qqq'], [' and ', ' et '], ['1']]) AS words FROM documents),
    e AS (SELECT doc_id, text, {SCHEMA}[c] AS label, unnest(words) AS w FROM p)
    SELECT doc_id, CAST(strpos(text, w) - 1 AS INTEGER) AS start, CAST(strpos(text, w) - 1 + length(w) AS INTEGER) AS end, label
    FROM e WHERE strpos(text, w) > 0""",
)
def _(spark, sf):
    words = {"article": ["the ", "qqq"], "link": [" and ", " et "], "number": ["1"]}
    predicted = F.create_map(*[c for name, w in words.items() for c in (F.lit(name), arrays.text_array(w))])
    spans = annotations.spans_from_predictions(F.col("text"), predicted, SCHEMA)
    return table(spark, sf, "documents").select("doc_id", F.explode(spans).alias("s")).select("doc_id", "s.*")


@query(
    "e6_labels_by_class",
    f"""SELECT d.doc_id, c.label AS entity_type, coalesce(string_agg(e.name, '|' ORDER BY e.i), '') AS entities
    FROM documents d CROSS JOIN (SELECT unnest({SCHEMA}) AS label) c LEFT JOIN {ENTITIES_SQL} e ON e.doc_id = d.doc_id AND e.label = c.label
    GROUP BY d.doc_id, c.label""",
)
def _(spark, sf):
    named = annotations.named_entities(F.col("text"), F.col("entities"))
    by_class = annotations.labels_by_class(named, SCHEMA)
    exploded = _annotated(spark, sf).select("doc_id", F.explode(by_class).alias("entity_type", "e"))
    return exploded.select("doc_id", "entity_type", F.array_join("e", "|").alias("entities"))


NEGATIVES_SQL = f"""(WITH p AS (SELECT doc_id, text, row_number() OVER (ORDER BY md5(concat_ws(':', 'neg', doc_id)), doc_id) - 1 AS p,
      count(*) OVER () AS n FROM documents),
  g AS (SELECT doc_id, p, n, j, 1 + j * (n - 1) // 4 + {DRAW.format(seed='neg-gap', key='doc_id, j')} %
      ((j + 1) * (n - 1) // 4 - j * (n - 1) // 4) AS gap FROM p, range(4) t(j)),
  m AS (SELECT g.doc_id, CAST(j AS INTEGER) AS j, q.doc_id AS neg, string_split(q.text, chr(10)) AS pos FROM g JOIN p q ON q.p = (g.p + gap) % g.n)
  SELECT doc_id, j, neg, pos[{DRAW.format(seed='neg-pos', key='doc_id, j')} % len(pos) + 1] AS text FROM m)"""


def _negatives(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.split("text", "\n", -1).alias("pos"))
    return datasets.random_negatives(docs, "doc_id", "pos", 4, "neg")


@query("d6_random_negatives", f"SELECT doc_id, j, neg, text FROM {NEGATIVES_SQL}")
def _(spark, sf):
    return _negatives(spark, sf)


@query(
    "d7_class_triples",
    f"""WITH m AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(concat_ws(':', 'cls', doc_id)), doc_id) - 1 AS i FROM documents),
    s AS (SELECT lang AS class, count(*) AS n FROM documents GROUP BY lang),
    a AS (SELECT doc_id, class, n, CAST(j AS INTEGER) AS j, CAST(class = lang AS INTEGER) AS is_pos,
        j * n // c + {DRAW.format(seed='cls-start', key='doc_id, class, j')} % ((j + 1) * n // c - j * n // c) AS i
      FROM (SELECT doc_id, lang, class, n, CASE WHEN class = lang THEN 1 ELSE least(3, n) END AS c FROM documents, s), range(3) t(j) WHERE j < c)
    SELECT a.doc_id, a.class, a.j, m.doc_id AS other, a.is_pos FROM a JOIN m ON m.lang = a.class AND m.i = a.i""",
)
def _(spark, sf):
    return datasets.class_triples(table(spark, sf, "documents"), "doc_id", "lang", 3, "cls")


@query(
    "d8_training_groups",
    f"""WITH n AS (SELECT doc_id, list(text ORDER BY j) AS neg FROM {NEGATIVES_SQL} GROUP BY doc_id),
    d AS (SELECT doc_id, string_split(text, chr(10)) AS pos, list_concat(neg, neg) AS neg FROM documents JOIN n USING (doc_id)),
    e AS (SELECT doc_id, unnest(range(8)) AS i, unnest(neg) AS t FROM d),
    r AS (SELECT doc_id, t, row_number() OVER (PARTITION BY doc_id ORDER BY md5(concat_ws(':', 'group', doc_id, i)), i) AS k FROM e)
    SELECT doc_id, CAST(0 AS INTEGER) AS pos, pos[{DRAW.format(seed='group-pos', key='doc_id')} % len(pos) + 1] AS text FROM d
    UNION ALL SELECT doc_id, CAST(k AS INTEGER), t FROM r WHERE k <= 6""",
)
def _(spark, sf):
    collected = F.sort_array(F.collect_list(F.struct("j", "text")))
    negatives = _negatives(spark, sf).groupBy("doc_id").agg(F.transform(collected, lambda e: e["text"]).alias("neg"))
    docs = table(spark, sf, "documents").select("doc_id", F.split("text", "\n", -1).alias("pos")).join(negatives, "doc_id")
    group = datasets.training_group(F.col("doc_id"), F.col("pos"), F.col("neg"), 7, "group")
    return docs.select("doc_id", F.posexplode(group).alias("pos", "text"))


@query("d9_pretraining_text", "SELECT conv_id, turn, role || ': ' || text || '</s>' AS text FROM conversations")
def _(spark, sf):
    text = datasets.pretraining_text([F.col("role"), F.lit(": "), F.col("text")], "</s>")
    return table(spark, sf, "conversations").select("conv_id", "turn", text.alias("text"))




def vocab_sql(name: str, first: int = 0) -> str:
    return f"""(SELECT token, row_number() OVER (ORDER BY md5(concat_ws(':', 'vocabulary', token)), token) - 1 + {first} AS id
  FROM (SELECT DISTINCT unnest({WORDS}) AS token FROM {name}))"""


PAIRS_SQL = """(SELECT a.conv_id, a.turn, a.text AS question, b.text AS answer FROM conversations a
  JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant')"""


@query(
    "d10_tuning_rows",
    f"""WITH v AS {vocab_sql('conversations', 2)},
    q AS (SELECT conv_id, turn, {WORDS.replace('text', 'question')} AS p, {WORDS.replace('text', 'answer')} AS a FROM {PAIRS_SQL}),
    e AS (SELECT conv_id, turn, len(p) AS skip, unnest(range(len(p) + len(a))) AS pos, unnest(list_concat(p, a)) AS token FROM q),
    i AS (SELECT conv_id, turn, max(skip) AS skip, list(id ORDER BY pos) AS ids FROM e JOIN v USING (token) GROUP BY conv_id, turn),
    f AS (SELECT q.conv_id, q.turn, len(p) AS skip, list_append(coalesce(ids, []), 1) AS ids FROM q LEFT JOIN i USING (conv_id, turn))
    SELECT conv_id, turn, array_to_string(ids, ',') AS input_ids,
      array_to_string(list_transform(ids, lambda x, n: CASE WHEN n <= skip THEN -100 ELSE x END), ',') AS labels FROM f""",
)
def _(spark, sf):
    turns = table(spark, sf, "conversations")
    vocab = tokens.vocabulary(tokens.distinct_tokens(turns, tx.words(F.col("text"))), first_id=2)
    pairs = datasets.question_answer_pairs(turns)
    question, answer = tx.words(F.col("question")), tx.words(F.col("answer"))
    out = datasets.tuning_rows(pairs, ["conv_id", "turn"], question, answer, vocab, end_id=1)
    joined = [F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("input_ids", "labels")]
    return out.select("conv_id", "turn", *joined)


@query(
    "d11_extended_vocabulary",
    f"""WITH k AS {vocab_sql('benchmark')},
    n AS (SELECT DISTINCT token FROM (SELECT unnest({WORDS}) AS token FROM documents) WHERE token NOT IN (SELECT token FROM k))
    SELECT token, id FROM k UNION ALL
    SELECT token, row_number() OVER (ORDER BY md5(concat_ws(':', 'vocabulary', token)), token) + (SELECT max(id) FROM k) FROM n""",
)
def _(spark, sf):
    known = tokens.vocabulary(tokens.distinct_tokens(table(spark, sf, "benchmark"), tx.words(F.col("text"))))
    fresh = tokens.distinct_tokens(table(spark, sf, "documents"), tx.words(F.col("text")))
    return tokens.extended_vocabulary(known, fresh)


@query(
    "d12_label_text",
    f"SELECT event_id, coalesce({EVENT_TYPES}[user_id % 5 + 1], 'unknown') AS label FROM events",
)
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", (F.col("user_id") % 5).cast("int").alias("id"))
    named = events.join(lookups.catalogue_frame(events, EVENT_TYPES), "id", "left")
    return named.select("event_id", F.coalesce("label", F.lit("unknown")).alias("label"))


EVAL_SQL = f"""(SELECT doc_id, string_split(text, chr(10)) AS pos FROM documents WHERE {DRAW.format(seed='eval', key='doc_id')} % 100 < 20)"""


def _test_split(spark, sf):
    split = rows.split_by_ratio(table(spark, sf, "documents"), "eval", "doc_id", 20).where(F.col("split") == "test")
    return split.select("doc_id", F.split("text", "\n", -1).alias("pos"))


@query(
    "d13_evaluation_set",
    f"""SELECT CAST(row_number() OVER (ORDER BY doc_id) - 1 AS VARCHAR) AS id, pos[1] AS query, array_to_string(pos, '|') AS pos,
      'Find the passage.' AS prompt FROM {EVAL_SQL}""",
)
def _(spark, sf):
    out = datasets.evaluation_set(_test_split(spark, sf), "doc_id", F.col("pos")[0], F.col("pos"), "Find the passage.")
    return out.withColumn("pos", F.array_join("pos", "|"))


@query("d13_corpus", f"SELECT doc_id, unnest(pos) AS text FROM {EVAL_SQL}")
def _(spark, sf):
    return datasets.corpus(_test_split(spark, sf), "doc_id", F.col("pos"))


def _arithmetic_sql() -> str:
    def n(i):
        return f"1 + {DRAW.format(seed=f'sum-n{i}', key='o_orderkey')} % 100 AS n{i}"

    def s(i):
        return f"['+', '-', 'x'][{DRAW.format(seed=f'sum-s{i}', key='o_orderkey')} % 3 + 1] AS s{i}"

    return f"""WITH t AS (SELECT o_orderkey, {n(0)}, {n(1)}, {n(2)}, {s(0)}, {s(1)} FROM orders)
    SELECT o_orderkey, concat_ws(' ', n0, s0, n1, s1, n2) AS expression, CASE
      WHEN s0 = 'x' AND s1 = 'x' THEN n0 * n1 * n2 WHEN s0 = 'x' AND s1 = '+' THEN n0 * n1 + n2 WHEN s0 = 'x' THEN n0 * n1 - n2
      WHEN s1 = 'x' AND s0 = '+' THEN n0 + n1 * n2 WHEN s1 = 'x' THEN n0 - n1 * n2
      ELSE n0 + CASE WHEN s0 = '+' THEN n1 ELSE -n1 END + CASE WHEN s1 = '+' THEN n2 ELSE -n2 END END AS result FROM t"""


@query("d14_arithmetic", _arithmetic_sql())
def _(spark, sf):
    return datasets.arithmetic(table(spark, sf, "orders"), "o_orderkey", 2, "sum")


@query(
    "d15_chat_template",
    r"""SELECT conv_id, string_agg('<|' || role || E'|>\n' || text || E'\n', '' ORDER BY turn) AS text, count(*) AS turns
    FROM conversations GROUP BY conv_id""",
)
def _(spark, sf):
    return dialogue.rendered_chat(table(spark, sf, "conversations"))


@query(
    "d16_block_prompts",
    rf"""WITH {shuffled_sql('s_suppkey, s_name', 'nation', 'n_name', 25, 'prompt')}
    SELECT s_suppkey, CAST(i // 5 AS INTEGER) AS block, 'Where does ' || s_name || E' trade?\n' || string_agg(n_name, ', ' ORDER BY i) AS instruction
    FROM r GROUP BY s_suppkey, s_name, i // 5""",
)
def _(spark, sf):
    firms = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    blocks = lookups.catalogue_blocks(firms, table(spark, sf, "nation"), "n_name", "s_suppkey", 5, "prompt")
    slots = {"name": F.col("s_name"), "members": F.array_join("members", ", ")}
    return blocks.select("s_suppkey", "block", prompts.render("Where does {name} trade?\n{members}", slots).alias("instruction"))


@query(
    "d17_clue_prompt",
    f"""SELECT doc_id, 'Clue: ' || array_to_string(list_filter({WORDS}, lambda w: list_contains({CATALOGUE_SQL}, w)), ' ') || chr(10) || 'Text: ' || text AS prompt
    FROM documents""",
)
def _(spark, sf):
    literal = F.concat(F.lit("['"), F.array_join(tx.words(F.col("text")), "', '"), F.lit("']"))
    known = arrays.known_labels(parsing.text_list(literal), CATALOGUE)
    slots = {"clue": F.array_join(known, " "), "text": F.col("text")}
    return table(spark, sf, "documents").select("doc_id", prompts.render("Clue: {clue}\nText: {text}", slots).alias("prompt"))


@query("d18_pair_flatten", f"SELECT conv_id, turn, question AS source, answer AS target FROM {PAIRS_SQL}")
def _(spark, sf):
    pairs = datasets.question_answer_pairs(table(spark, sf, "conversations"))
    nested = pairs.select("conv_id", "turn", F.struct("question", "answer").alias("translation"))
    return nested.select(
        "conv_id", "turn", F.col("translation.question").alias("source"), F.col("translation.answer").alias("target")
    )


@query(
    "d19_entity_swaps",
    r"""WITH t AS (SELECT doc_id, lang, text, regexp_extract_all(text, '\p{L}{5,}') AS es, string_split_regex(text, '\p{L}{5,}') AS gaps FROM documents),
    k AS (SELECT DISTINCT lang, length(entity) AS len, entity FROM (SELECT lang, unnest(es) AS entity FROM t)),
    i AS (SELECT *, row_number() OVER (PARTITION BY lang, len ORDER BY md5(concat_ws(':', 'swap', entity)), entity) - 1 AS i,
        count(*) OVER (PARTITION BY lang, len) AS n FROM k),
    s AS (SELECT a.lang, a.entity, b.entity AS replacement FROM i a JOIN i b ON b.lang = a.lang AND b.len = a.len AND b.i = (a.i + 1) % a.n),
    p AS (SELECT doc_id, lang, unnest(range(len(es))) AS pos, unnest(es) AS entity, unnest(gaps[1:len(es)]) AS gap FROM t WHERE len(es) > 0),
    r AS (SELECT doc_id, string_agg(gap || replacement, '' ORDER BY pos) AS out, count(*) FILTER (WHERE replacement <> entity) AS swapped
      FROM p JOIN s USING (lang, entity) GROUP BY doc_id)
    SELECT doc_id, len(es)::INTEGER AS entities, coalesce(swapped, 0)::INTEGER AS swapped, coalesce(out || gaps[len(gaps)], text) AS text FROM t LEFT JOIN r USING (doc_id)""",
)
def _(spark, sf):
    long_word = r"\p{L}{5,}"
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text", F.regexp_extract_all("text", F.lit(long_word), F.lit(0)).alias("words"))
    # A word starts behind all gaps and words before it.
    gaps = F.slice(F.split("text", long_word, -1), F.lit(1), F.size("words"))
    ends = arrays.running_sums(F.zip_with(gaps, "words", lambda gap, word: F.length(gap) + F.length(word)))
    starts = F.zip_with(ends, "words", lambda end, word: end - F.length(word))
    found = docs.select("doc_id", "lang", "text", F.zip_with(starts, "words", lambda start, word: F.struct(start.alias("start"), word.alias("entity"))).alias("found"))
    swapped = annotations.all_entities_swapped(found, "doc_id", "text", "found", "lang", "swap")
    return swapped.select("doc_id", F.size("found").alias("entities"), "swapped", "text")
