"""Evaluation of predictions (E5, E7-E14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.functions import arrays, prompts
from corpuskit.functions import text as tx
from corpuskit.functions.binding import let
from corpuskit.functions.hashing import draw_int
from corpuskit.functions.stems import stemmed_sql
from corpuskit.operators import datasets, metrics
from corpuskit.plans.datasets import PAIRS_SQL
from corpuskit.plans.ordered import DRAW
from corpuskit.plans.registry import query, table
from corpuskit.plans.scalar import CATALOGUE, CATALOGUE_SQL, WORDS

FIRST_WORDS = WORDS.replace("text", "substring(text, 1, length(text) // 2)")
SECOND_WORDS = WORDS.replace("text", "substring(text, length(text) // 2 + 1)")


def _halves():
    half = F.floor(F.length("text") / 2).cast("int")
    return tx.words(F.substring("text", F.lit(1), half)), tx.words(F.substring("text", half + 1, F.length("text")))


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _ner_sql(name: str, test: str) -> str:
    return f"""SELECT '{name}' AS class, (SELECT count(*) FILTER (WHERE NOT ok) FROM t) AS errors,
      sum(len(list_intersect(g, p))) FILTER (WHERE ok) AS r, sum(len(p)) FILTER (WHERE ok) AS pn, sum(len(g)) FILTER (WHERE ok) AS gn
    FROM (SELECT ok, list_distinct(list_filter(a, lambda w: {test})) AS g, list_distinct(list_filter(b, lambda w: {test})) AS p FROM t)"""


@query(
    "e5_extraction_report",
    rf"""WITH t AS (SELECT NOT regexp_matches(text, '\p{{Nd}}') AS ok, {FIRST_WORDS} AS a, {SECOND_WORDS} AS b FROM documents),
    c AS ({_ner_sql('short', 'length(w) <= 3')} UNION ALL {_ner_sql('long', 'length(w) >= 8')}),
    s AS (SELECT *, r / (pn + 1e-6) AS p, r / (gn + 1e-6) AS q FROM c)
    SELECT class, errors, CAST(r AS BIGINT) AS right, CAST(pn AS BIGINT) AS predicted, CAST(gn AS BIGINT) AS gold,
      round(p, 6) AS precision, round(q, 6) AS recall, round(CASE WHEN p + q = 0 THEN 0 ELSE 2 * p * q / (p + q) END, 6) AS f1 FROM s""",
)
def _(spark, sf):
    def by_class(words):
        short, long = (lambda w: F.length(w) <= 3), (lambda w: F.length(w) >= 8)
        return let(words, lambda ws: F.create_map(F.lit("short"), F.filter(ws, short), F.lit("long"), F.filter(ws, long)))

    first, second = _halves()
    readable = F.when(~F.col("text").rlike(r"\p{Nd}"), by_class(second))
    rows = table(spark, sf, "documents").select(by_class(first).alias("gold"), readable.alias("predicted"))
    report = metrics.extraction_report(rows, "gold", "predicted", ["short", "long"])
    return _rounded(report, "precision", "recall", "f1")


GUESS_SQL = f"""(SELECT event_id, user_id, event_type AS gold, CASE WHEN {DRAW.format(seed='guess', key='event_id')} % 100 < 60 THEN event_type
  ELSE ['signup', 'view', 'click', 'purchase', 'none'][{DRAW.format(seed='other', key='event_id')} % 5 + 1] END AS pred FROM events)"""


def _guesses(spark, sf):
    others = F.element_at(
        arrays.text_array(["signup", "view", "click", "purchase", "none"]), (draw_int("other", "event_id") % 5 + 1).cast("int")
    )
    pred = F.when(draw_int("guess", "event_id") % 100 < 60, F.col("event_type")).otherwise(others)
    return table(spark, sf, "events").select("event_id", "user_id", F.col("event_type").alias("gold"), pred.alias("pred"))


def report_sql(source: str, weight: str, by: str = "") -> str:
    lead, comma = (f"{by}, ", f", {by}") if by else ("", "")
    on = f" AND g.{by} = p.{by}" if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""WITH x AS {source},
    g AS (SELECT {lead}gold AS class, count(*) AS support, count(*) FILTER (WHERE gold = pred) AS r FROM x GROUP BY gold{comma}),
    p AS (SELECT {lead}pred AS class, count(*) AS predicted FROM x GROUP BY pred{comma}),
    c AS (SELECT {f'coalesce(g.{by}, p.{by}) AS {by},' if by else ''} coalesce(support, 0) AS support, coalesce(r, 0) AS r,
        coalesce(predicted, 0) AS predicted FROM g FULL OUTER JOIN p ON g.class = p.class{on}),
    s AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE r / predicted END AS p, CASE WHEN support = 0 THEN 0 ELSE r / support END AS q FROM c),
    f AS (SELECT *, CASE WHEN p + q = 0 THEN 0 ELSE 2 * p * q / (p + q) END AS f, {weight} AS w FROM s)
    SELECT {lead}round(sum(r) / sum(support), 6) AS accuracy, round(sum(p * w) / sum(w), 6) AS precision,
      round(sum(q * w) / sum(w), 6) AS recall, round(sum(f * w) / sum(w), 6) AS f1, CAST(sum(support) AS BIGINT) AS support FROM f {group}"""


SCORES = ("accuracy", "precision", "recall", "f1")


@query("e7_macro_report", report_sql(GUESS_SQL, "1.0"))
def _(spark, sf):
    return _rounded(metrics.classification_report(_guesses(spark, sf), "gold", "pred"), *SCORES)


LABELLED_SQL = "(SELECT quality AS gold, CAST(n_chars > 500 AS INTEGER) AS pred FROM documents JOIN labels USING (doc_id))"


@query("e8_weighted_report", report_sql(LABELLED_SQL, "support"))
def _(spark, sf):
    predicted = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") > 500).cast("int").alias("pred"))
    aligned = predicted.join(table(spark, sf, "labels").withColumnRenamed("quality", "gold"), "doc_id")
    return _rounded(metrics.classification_report(aligned, "gold", "pred", "weighted"), *SCORES)


@query(
    "e9_multi_label_report",
    f"""WITH w AS (SELECT {FIRST_WORDS} AS a, {SECOND_WORDS} AS b FROM documents),
    t AS (SELECT list_transform({CATALOGUE_SQL}, lambda c: list_contains(a, c)) AS g, list_transform({CATALOGUE_SQL}, lambda c: list_contains(b, c)) AS p FROM w),
    e AS (SELECT unnest(range(6)) AS i, unnest(g) AS g, unnest(p) AS p FROM t),
    c AS (SELECT i, coalesce(2 * count(*) FILTER (WHERE g AND p) / nullif(count(*) FILTER (WHERE g) + count(*) FILTER (WHERE p), 0), 0) AS f FROM e GROUP BY i)
    SELECT 'accuracy' AS metric, round((SELECT avg(CAST(g = p AS DOUBLE)) FROM t), 6) AS value
    UNION ALL SELECT 'f1', round((SELECT avg(f) FROM c), 6) UNION ALL SELECT 'f1_class_' || i, round(f, 6) FROM c""",
)
def _(spark, sf):
    first, second = _halves()
    rows = table(spark, sf, "documents").select(
        arrays.multi_hot(first, CATALOGUE).alias("gold"), arrays.multi_hot(second, CATALOGUE).alias("pred")
    )
    return _rounded(metrics.multi_label_report(rows, "gold", "pred", len(CATALOGUE)), "value")


@query(
    "e10_binary_report",
    """SELECT round(count(*) FILTER (WHERE quality = toxic) / count(*), 6) AS accuracy,
      round(2 * count(*) FILTER (WHERE quality = 1 AND toxic = 1) / (count(*) FILTER (WHERE quality = 1) + count(*) FILTER (WHERE toxic = 1)), 6) AS f1
    FROM labels""",
)
def _(spark, sf):
    return _rounded(metrics.binary_report(table(spark, sf, "labels"), "quality", "toxic"), "accuracy", "f1")


def _rouge_sql(n: int) -> str:
    tokens = "regexp_extract_all(lower({}), '([a-z0-9]+)', 1)"
    gram = " || ' ' || ".join(f"{{0}}[i + {j}]" for j in range(n))

    def side(c):
        return f"""SELECT conv_id, turn, {gram.format('t')} AS gram, count(*) AS c FROM
          (SELECT conv_id, turn, t, unnest(range(1, len(t) - {n - 2})) AS i FROM (SELECT conv_id, turn, {tokens.format(c)} AS t FROM q))
          GROUP BY ALL"""

    return f"""WITH q AS {PAIRS_SQL}, p AS ({side('question')}), r AS ({side('answer')}),
    m AS (SELECT conv_id, turn, sum(least(p.c, r.c)) AS m FROM p JOIN r USING (conv_id, turn, gram) GROUP BY conv_id, turn),
    ps AS (SELECT conv_id, turn, sum(c) AS s FROM p GROUP BY conv_id, turn), rs AS (SELECT conv_id, turn, sum(c) AS s FROM r GROUP BY conv_id, turn)
    SELECT q.conv_id, q.turn, round(coalesce(2 * m.m / nullif(coalesce(ps.s, 0) + coalesce(rs.s, 0), 0), 0), 6) AS score
    FROM q LEFT JOIN m USING (conv_id, turn) LEFT JOIN ps USING (conv_id, turn) LEFT JOIN rs USING (conv_id, turn)"""


def _generated(spark, sf):
    return datasets.question_answer_pairs(table(spark, sf, "conversations"))


@query("e11_rouge_1", _rouge_sql(1))
def _(spark, sf):
    return _rounded(metrics.rouge_n(_generated(spark, sf), ["conv_id", "turn"], "question", "answer", 1), "score")


@query("e11_rouge_2", _rouge_sql(2))
def _(spark, sf):
    return _rounded(metrics.rouge_n(_generated(spark, sf), ["conv_id", "turn"], "question", "answer", 2), "score")


def _stemmed_sql(questions: str) -> str:
    """Statements for a table (conv_id, turn, p, r) of stemmed tokens of questions and answers."""
    tokens = "regexp_extract_all(lower({}), '([a-z0-9]+)', 1)"
    side = "SELECT conv_id, turn, '{0}' AS side, unnest(range(len({0}))) AS pos, unnest({0}) AS token FROM q"
    return f"""q AS (SELECT conv_id, turn, question, answer, {tokens.format('question')} AS p, {tokens.format('answer')} AS r FROM {questions}),
    tok AS ({side.format('p')} UNION ALL {side.format('r')}), voc AS (SELECT DISTINCT token FROM tok),
    cut AS (SELECT conv_id, turn, side, pos, stem FROM tok JOIN {stemmed_sql('voc', 3)} USING (token)),
    arr AS (SELECT conv_id, turn, coalesce(list(stem ORDER BY pos) FILTER (WHERE side = 'p'), []) AS p,
      coalesce(list(stem ORDER BY pos) FILTER (WHERE side = 'r'), []) AS r FROM cut GROUP BY conv_id, turn)"""


def _rouge_n_sql(n: int) -> str:
    """Statements for a table s<n> of scores of the rows of arr."""
    gram = lambda c: " || ' ' || ".join(f"{c}[i + {j}]" for j in range(n))
    count = lambda c: f"SELECT conv_id, turn, {gram(c)} AS g, count(*) AS n FROM arr, unnest(range(1, len({c}) - {n - 2})) AS t(i) GROUP BY ALL"
    return f"""p{n} AS ({count('p')}), r{n} AS ({count('r')}),
    m{n} AS (SELECT conv_id, turn, sum(least(p{n}.n, r{n}.n)) AS m FROM p{n} JOIN r{n} USING (conv_id, turn, g) GROUP BY conv_id, turn),
    s{n} AS (SELECT conv_id, turn, coalesce(2 * m / nullif(greatest(len(p) - {n - 1}, 0) + greatest(len(r) - {n - 1}, 0), 0), 0) AS score
      FROM arr LEFT JOIN m{n} USING (conv_id, turn))"""


#: Row by row of the usual table: the longest common subsequence of p with the first i tokens of r, for each length of p.
LONGEST_SQL = """lcs AS (SELECT conv_id, turn, p, r, 0 AS i, list_transform(p, lambda x: 0) AS line FROM arr
      UNION ALL SELECT conv_id, turn, p, r, i + 1, list_transform(range(1, len(p) + 1), lambda j: list_max(step[1:j])) FROM (
        SELECT *, list_transform(range(1, len(p) + 1), lambda j: greatest(line[j], CASE WHEN p[j] = r[i + 1] THEN coalesce(line[j - 1], 0) + 1 ELSE 0 END)) AS step
        FROM lcs WHERE i < len(r))),
    sl AS (SELECT conv_id, turn, CASE WHEN len(p) > 0 AND len(r) > 0 THEN 2 * line[len(p)] / (len(p) + len(r)) ELSE 0 END AS score FROM lcs WHERE i = len(r))"""


@query(
    "e11_rouge_l",
    f"""WITH RECURSIVE {_stemmed_sql(PAIRS_SQL)}, {LONGEST_SQL}
    SELECT q.conv_id, q.turn, round(coalesce(score, 0), 6) AS score FROM q LEFT JOIN sl USING (conv_id, turn)""",
)
def _(spark, sf):
    tokens = metrics.rouge_table(_generated(spark, sf), ["conv_id", "turn"], "question", "answer", stem=True)
    return tokens.select("conv_id", "turn", F.round(metrics.rouge_l(F.col("pred"), F.col("ref")), 6).alias("score"))


@query(
    "e11_generation_report",
    f"""WITH RECURSIVE {_stemmed_sql(PAIRS_SQL)}, {_rouge_n_sql(1)}, {_rouge_n_sql(2)}, {LONGEST_SQL}
    SELECT round(avg(coalesce(s1.score, 0)), 4) AS rouge1, round(avg(coalesce(s2.score, 0)), 4) AS rouge2, round(avg(coalesce(sl.score, 0)), 4) AS rougeL,
      round(avg((trim(question) = trim(answer))::INTEGER), 4) AS acc
    FROM q LEFT JOIN s1 USING (conv_id, turn) LEFT JOIN s2 USING (conv_id, turn) LEFT JOIN sl USING (conv_id, turn)""",
)
def _(spark, sf):
    return metrics.generation_report(_generated(spark, sf), ["conv_id", "turn"], "question", "answer")


METHODS_SQL = f"""(SELECT 'guess' AS method, gold, pred FROM {GUESS_SQL}
  UNION ALL SELECT 'constant', gold, 'view' FROM {GUESS_SQL} UNION ALL SELECT 'oracle', gold, gold FROM {GUESS_SQL})"""


@query("e12_method_comparison", report_sql(METHODS_SQL, "support", "method"))
def _(spark, sf):
    guesses = _guesses(spark, sf)
    results = F.array(
        *[F.struct(F.lit(m).alias("method"), p.alias("p")) for m, p in (("guess", F.col("pred")), ("constant", F.lit("view")), ("oracle", F.col("gold")))]
    )
    stacked = guesses.select("gold", F.explode(results).alias("r")).select("gold", "r.method", F.col("r.p").alias("pred"))
    return _rounded(metrics.classification_report(stacked, "gold", "pred", "weighted", by=["method"]), *SCORES)


@query(
    "e14_answer_grading",
    r"""SELECT p_partkey, E'Question: which part?\nGold: ' || p_name || E'\nAnswer: ' || a || E'\nReply 0 or 1.' AS prompt,
      CAST(translate(lower(trim(a)), '-:：', '') = translate(lower(trim(p_name)), '-:：', '') AS INTEGER) AS grade
    FROM (SELECT p_partkey, p_name, CASE WHEN p_size % 2 = 0 THEN ' ' || upper(p_name) || ':' ELSE p_type END AS a FROM part)""",
)
def _(spark, sf):
    answer = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(" "), F.upper("p_name"), F.lit(":"))).otherwise(F.col("p_type"))
    rows = table(spark, sf, "part").withColumn("answer", answer)
    template = "Question: which part?\nGold: {gold}\nAnswer: {answer}\nReply 0 or 1."
    judge = prompts.render(template, {"gold": F.col("p_name"), "answer": F.col("answer")})
    same = tx.match_key(F.col("answer")) == tx.match_key(F.col("p_name"))
    return rows.select("p_partkey", judge.alias("prompt"), same.cast("int").alias("grade"))
