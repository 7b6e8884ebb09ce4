"""Vector search, clustering, retrieval and their scores (V*, J14, E1-E4, E15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.functions import prompts
from corpuskit.functions import text as tx
from corpuskit.functions import vectors as vec
from corpuskit.operators import encoders, learning, metrics, nearest, retrieval, rows, votes
from corpuskit.plans.calls import word_vectors_sql
from corpuskit.plans.ordered import DRAW
from corpuskit.plans.registry import query, table
from corpuskit.plans.scalar import WORDS
from corpuskit.plans.scores import report_sql
from corpuskit.session import cut_and_free, cut_lineage, scratch_path
from corpuskit.sources import files

V = "(SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"
UNIT = "sqrt(list_inner_product({0}, {0}))"
DOT = "list_inner_product(a.v, b.v)"
COSINE = f"({DOT} / ({UNIT.format('a.v')} * {UNIT.format('b.v')}))"
DISTANCE = "list_distance(a.v, b.v)"


def top_sql(score: str, k: int, queries: str = V, corpus: str = V, on: str = "true") -> str:
    return f"""(SELECT a.id AS query, b.id AS id, a.label AS qlabel, b.label AS label, round({score}, 9) AS score,
      row_number() OVER (PARTITION BY a.id ORDER BY round({score}, 9) DESC, b.id)::INTEGER AS rank
      FROM {queries} a JOIN {corpus} b ON {on} QUALIFY rank <= {k})"""


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


def _as_queries(df):
    return df.withColumnRenamed("id", "query")


CENTROIDS = """(SELECT id, list(x ORDER BY pos) AS v, id AS label FROM (SELECT label AS id, pos, avg(x) AS x FROM
  (SELECT label, unnest(range(64)) AS pos, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings) GROUP BY label, pos) GROUP BY id)"""


def _centroids(spark, sf):
    long = votes.mean_vectors(table(spark, sf, "embeddings"), "label", "embedding")
    return votes.as_vectors(long, "label").withColumnRenamed("label", "id")


@query(
    "v1_similarity_matrix",
    f"SELECT a.id::BIGINT AS query, b.id AS id, round({DOT}, 9) AS score FROM {CENTROIDS} a, {V} b",
)
def _(spark, sf):
    return nearest.similarity(_as_queries(_centroids(spark, sf)), _vectors(spark, sf))


@query("v2_top_k_dot", f"SELECT query, id, score, rank FROM {top_sql(DOT, 10)}")
def _(spark, sf):
    vectors = _vectors(spark, sf)
    return nearest.top_k(_as_queries(vectors), vectors, 10)


@query(
    "v3_text_search",
    f"""SELECT query, id, score, rank FROM
    {top_sql(DOT, 3, word_vectors_sql('benchmark', 'item_id', 256), word_vectors_sql('documents', 'doc_id', 256))}""",
)
def _(spark, sf):
    def encoded(name, key, alias):
        vectors = encoders.word_vectors(table(spark, sf, name), key, tx.words(F.col("text")), 256).withColumnRenamed(key, alias)
        return cut_lineage(vectors, "vectors")  # the search reads each side several times

    return nearest.top_k(encoded("benchmark", "item_id", "query"), encoded("documents", "doc_id", "id"), 3)


@query(
    "v4_nearest_example_prompt",
    rf"""SELECT query, E'Label the vector.\n\nVector ' || id || ' has label ' || label || E'.\n\nVector ' || query || ' has label' AS prompt
    FROM {top_sql(COSINE, 1, on='a.id <> b.id')}""",
)
def _(spark, sf):
    vectors = _vectors(spark, sf)
    found = nearest.top_k(_as_queries(vectors), vectors, 1, "cosine", skip_same=True)
    labelled = found.join(vectors.select("id", "label"), "id")
    template = "Label the vector.\n\nVector {id} has label {label}.\n\nVector {query} has label"
    return labelled.select("query", prompts.render(template, {c: F.col(c) for c in ("id", "label", "query")}).alias("prompt"))


@query(
    "v5_knn_graph",
    f"SELECT query AS src, id AS dst, score, rank FROM {top_sql(COSINE, 5, on='a.id <> b.id')}",
)
def _(spark, sf):
    return nearest.knn_graph(_vectors(spark, sf), 5)


@query(
    "v5_grouped_graph",
    f"SELECT label, query AS src, id AS dst, score, rank FROM {top_sql(COSINE, 5, on='a.id <> b.id AND a.label = b.label')} WHERE qlabel = label",
)
def _(spark, sf):
    return nearest.knn_graph_by(_vectors(spark, sf), "label", 5)


@query("j14_nearest_join", f"SELECT query, id, score FROM {top_sql('-' + DISTANCE, 1, on='a.id <> b.id')}")
def _(spark, sf):
    vectors = _vectors(spark, sf)
    found = nearest.top_k(_as_queries(vectors), vectors, 1, "euclidean", skip_same=True)
    return found.drop("rank")


SPLIT = f"{DRAW.format(seed='knn', key='id')} % 100 < 20"
TEST, TRAIN = f"(SELECT * FROM {V} WHERE {SPLIT})", f"(SELECT * FROM {V} WHERE NOT {SPLIT})"


def knn_sql(score: str, queries: str, corpus: str, k: int = 10) -> str:
    return f"""(SELECT query, qlabel AS gold, label AS pred FROM (SELECT query, qlabel, label, count(*) AS n FROM
      {top_sql(score, k, queries, corpus)} GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY query ORDER BY n DESC, label) = 1)"""


def _split(spark, sf):
    split = rows.split_by_ratio(_vectors(spark, sf), "knn", "id", 20)
    return split.where(F.col("split") == "train").drop("split"), split.where(F.col("split") == "test").drop("split")


@query("v6_knn_classes", f"SELECT query, pred AS predicted FROM {knn_sql(COSINE, TEST, TRAIN)}")
def _(spark, sf):
    train, test = _split(spark, sf)
    return nearest.knn_classes(_as_queries(test.drop("label")), train, 10)


@query("v6_knn_classes_euclidean", f"SELECT query, pred AS predicted FROM {knn_sql('-' + DISTANCE, TEST, TRAIN)}")
def _(spark, sf):
    train, test = _split(spark, sf)
    return nearest.knn_classes(_as_queries(test.drop("label")), train, 10, "euclidean")


@query("v7_logistic_regression")
def _(spark, sf):
    train, test = _split(spark, sf)
    return metrics.classification_report(learning.logistic_predictions(train, test), "label", "predicted")


@query(
    "v8_lloyd_step",
    f"""WITH n AS (SELECT query, id AS cluster FROM {top_sql('-' + DISTANCE, 1, V, CENTROIDS)}),
    e AS (SELECT cluster, unnest(range(64)) AS pos, unnest(v) AS x FROM n JOIN {V} t ON t.id = n.query)
    SELECT cluster AS id, pos::INTEGER AS pos, round(avg(x), 6) AS x FROM e GROUP BY cluster, pos""",
)
def _(spark, sf):
    moved = nearest.lloyd_step(_vectors(spark, sf).select("id", "vector"), cut_lineage(_centroids(spark, sf), "centroids"))
    return moved.select("id", F.posexplode("vector").alias("pos", "x")).withColumn("x", F.round("x", 6))


def kmeans_sql(points: str, k: int, steps: int) -> str:
    """Statements for a table members (id, c) of points (id, v): far starts and Lloyd's steps, written out."""
    away = "round(list_distance(pt.v, c.v), 9)"
    out = [f"pt AS MATERIALIZED (SELECT id, v FROM {points})", "far0 AS MATERIALIZED (SELECT 0 AS c, v FROM pt ORDER BY id LIMIT 1)"]
    for j in range(1, k):
        farthest = f"SELECT pt.id, any_value(pt.v) AS v, min({away}) AS d FROM pt, far{j - 1} c GROUP BY pt.id"
        out.append(f"far{j} AS MATERIALIZED (SELECT c, v FROM far{j - 1} UNION ALL (SELECT {j}, v FROM ({farthest}) WHERE d > 0 ORDER BY d DESC, id LIMIT 1))")
    nearest_to = "(SELECT pt.id, pt.v, c.c FROM pt, {} c QUALIFY row_number() OVER (PARTITION BY pt.id ORDER BY " + away + ", c.c) = 1)"
    now = f"far{k - 1}"
    for s in range(steps):
        places = f"SELECT c, unnest(range(len(v))) AS pos, unnest(v) AS x FROM {nearest_to.format(now)}"
        mean = f"SELECT c, list(x ORDER BY pos) AS v FROM (SELECT c, pos, avg(x) AS x FROM ({places}) GROUP BY c, pos) GROUP BY c"
        out.append(f"step{s} AS MATERIALIZED (SELECT c, coalesce(m.v, o.v) AS v FROM {now} o LEFT JOIN ({mean}) m USING (c))")
        now = f"step{s}"
    return ", ".join([*out, f"members AS (SELECT id, c FROM {nearest_to.format(now)})"])


@query("v8_kmeans_clusters", f"WITH {kmeans_sql(V, 10, 6)} SELECT c::INTEGER AS cluster, count(*) AS n, min(id) AS first FROM members GROUP BY c")
def _(spark, sf):
    members = learning.kmeans_clusters(_vectors(spark, sf).select("id", "vector"), 10, 6)
    return members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))


@query("v9_text_clusters")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return learning.text_clusters(docs, "text", 4).groupBy("cluster", "lang").agg(F.count(F.lit(1)).alias("n"))


@query("v10_plane_projection")
def _(spark, sf):
    return learning.plane_projection(_vectors(spark, sf), _centroids(spark, sf))


@query(
    "v11_mean_pooling",
    """WITH t AS (SELECT vec_id // 8 AS text_id, CAST(vec_id % 3 > 0 AS INTEGER) AS mask, unnest(range(64)) AS pos, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings),
    m AS (SELECT text_id, pos, sum(x * mask) / sum(mask) AS x FROM t GROUP BY text_id, pos),
    n AS (SELECT text_id, sqrt(sum(x * x)) AS n FROM m GROUP BY text_id)
    SELECT text_id, pos::INTEGER AS pos, round(x / n, 6) AS x FROM m JOIN n USING (text_id)""",
)
def _(spark, sf):
    tokens = table(spark, sf, "embeddings").withColumn("text_id", F.floor(F.col("vec_id") / 8))
    mask = (F.col("vec_id") % 3 > 0).cast("int")
    pooled = votes.as_vectors(votes.mean_vectors(tokens, "text_id", "embedding", weight=mask), "text_id")
    unit = pooled.select("text_id", F.posexplode(vec.unit(F.col("vector"))).alias("pos", "x"))
    return unit.withColumn("x", F.round("x", 6))


@query(
    "v11_first_pooling",
    """WITH f AS (SELECT vec_id // 8 AS text_id, CAST(arg_min(embedding, vec_id) AS DOUBLE[]) AS v FROM embeddings GROUP BY 1)
    SELECT text_id, unnest(range(len(v)))::INTEGER AS pos, round(unnest(v), 6) AS x, round(unnest(v) / sqrt(list_inner_product(v, v)), 6) AS unit FROM f""",
)
def _(spark, sf):
    tokens = table(spark, sf, "embeddings").withColumn("text_id", F.floor(F.col("vec_id") / 8))
    first = tokens.groupBy("text_id").agg(F.min_by("embedding", "vec_id").alias("v"))
    both = F.posexplode(F.arrays_zip(vec.doubles(F.col("v")).alias("x"), vec.unit(F.col("v")).alias("unit")))
    return first.select("text_id", both.alias("pos", "e")).select("text_id", "pos", F.round("e.x", 6).alias("x"), F.round("e.unit", 6).alias("unit"))


def tfidf_sql(documents: str, queries: str, k: int) -> str:
    """Statements for tables (doc, words) and (query, words)."""
    return f"""dt AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(words) AS term FROM {documents}) GROUP BY ALL),
    idf AS (SELECT term, ln((1 + (SELECT count(*) FROM {documents})) / (1 + count(*))) + 1 AS idf FROM dt GROUP BY term),
    dr AS (SELECT doc, term, tf * idf AS w FROM dt JOIN idf USING (term)),
    dn AS (SELECT doc, sqrt(sum(w * w)) AS n FROM dr GROUP BY doc), dw AS (SELECT doc, term, w / n AS w FROM dr JOIN dn USING (doc)),
    qr AS (SELECT query, term, count(*) * any_value(idf) AS w FROM (SELECT query, unnest(words) AS term FROM {queries}) JOIN idf USING (term) GROUP BY query, term),
    qn AS (SELECT query, sqrt(sum(w * w)) AS n FROM qr GROUP BY query), qw AS (SELECT query, term, w / n AS w FROM qr JOIN qn USING (query)),
    found AS (SELECT query, doc, round(sum(dw.w * qw.w), 9) AS score, row_number() OVER (PARTITION BY query ORDER BY round(sum(dw.w * qw.w), 9) DESC, doc)::INTEGER AS rank
      FROM dw JOIN qw USING (term) GROUP BY query, doc QUALIFY rank <= {k})"""


DOCS_SQL = f"d AS (SELECT doc_id AS doc, {WORDS} AS words FROM documents), q AS (SELECT item_id AS query, {WORDS} AS words FROM benchmark)"


def _index(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), "text")
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("query"), "text")
    weighted, idf = retrieval.weighted_documents(docs, "doc", tx.words(F.col("text")))
    return weighted, retrieval.weighted_queries(items, "query", tx.words(F.col("text")), idf)


@query("v12_tfidf_top", f"WITH {DOCS_SQL}, {tfidf_sql('d', 'q', 5)} SELECT query, doc, score, rank FROM found")
def _(spark, sf):
    documents, queries = _index(spark, sf)
    return retrieval.tfidf_top(queries, documents, 5)


@query(
    "v12_tfidf_unvisited",
    f"""WITH {DOCS_SQL}, {tfidf_sql('d', 'q', 8)}
    SELECT query, doc, score, (rank - 3)::INTEGER AS rank FROM found WHERE rank > 3""",
)
def _(spark, sf):
    documents, queries = _index(spark, sf)
    index = retrieval.block_index(documents)
    visited = cut_and_free(retrieval.tfidf_top(queries, index, 3), "visited")
    return retrieval.tfidf_top(queries, index, 5, visited)


@query("v13_graph_retrieval")
def _(spark, sf):
    documents, queries = _index(spark, sf)
    vectors = encoders.word_vectors(table(spark, sf, "documents"), "doc_id", tx.words(F.col("text")), 256).withColumnRenamed("doc_id", "id")
    edges = cut_and_free(nearest.knn_graph(cut_and_free(vectors, "vectors"), 5), "edges")
    return retrieval.graph_retrieval(queries, documents, edges, 20)


#: Passages of 20 words of the later turns of a conversation, each in its conversation; the first turn asks.
ITEM_SQL = f"""w AS (SELECT conv_id, conv_id || '/' || turn AS key, {WORDS} AS words FROM conversations WHERE turn > 0),
    d AS (SELECT conv_id, key || '/' || chunk AS doc, words[chunk * 20 + 1 : chunk * 20 + 20] AS words
      FROM (SELECT conv_id, key, unnest(range((len(words) + 19) // 20)) AS chunk, words FROM w)),
    q AS (SELECT conv_id, conv_id AS query, {WORDS} AS words FROM conversations WHERE turn = 0),
    dt AS (SELECT conv_id, doc, term, count(*) AS tf FROM (SELECT conv_id, doc, unnest(words) AS term FROM d) GROUP BY ALL),
    idf AS (SELECT conv_id, term, ln((1 + any_value(n)) / (1 + count(*))) + 1 AS idf
      FROM dt JOIN (SELECT conv_id, count(*) AS n FROM d GROUP BY conv_id) USING (conv_id) GROUP BY conv_id, term),
    dr AS (SELECT conv_id, doc, term, tf * idf AS w FROM dt JOIN idf USING (conv_id, term)),
    dn AS (SELECT conv_id, doc, sqrt(sum(w * w)) AS n FROM dr GROUP BY ALL), dw AS (SELECT conv_id, doc, term, w / n AS w FROM dr JOIN dn USING (conv_id, doc)),
    qr AS (SELECT conv_id, term, count(*) * any_value(idf) AS w FROM (SELECT conv_id, unnest(words) AS term FROM q) JOIN idf USING (conv_id, term) GROUP BY ALL),
    qn AS (SELECT conv_id, sqrt(sum(w * w)) AS n FROM qr GROUP BY ALL), qw AS (SELECT conv_id, term, w / n AS w FROM qr JOIN qn USING (conv_id)),
    score AS (SELECT conv_id, doc, round(sum(dw.w * qw.w), 9) AS score FROM dw JOIN qw USING (conv_id, term) GROUP BY ALL)"""


def _walk_sql(k: int, edges: str) -> str:
    """Statements for a table walk (conv_id, round, found, last): the rounds of each item as lists. `edges` has (conv_id, src, dst)."""
    sizes = list(retrieval.ROUND_SIZES)
    best = f"SELECT conv_id, list(doc ORDER BY score DESC, doc)[1:{min(sizes[0], k)}] AS l FROM score GROUP BY conv_id"
    step = f"""SELECT w.conv_id, w.round + 1 AS round, any_value(w.found) AS found,
        list(DISTINCT {{'s': -coalesce(s.score, 0), 'd': e.dst}}) AS fresh, least({sizes}[any_value(w.round) + 2], {k} - len(any_value(w.found))) AS room
      FROM (SELECT *, unnest(last) AS src FROM walk WHERE round + 1 < {len(sizes)}) w JOIN {edges} e ON e.conv_id = w.conv_id AND e.src = w.src
      LEFT JOIN score s ON s.conv_id = w.conv_id AND s.doc = e.dst WHERE NOT list_contains(w.found, e.dst) GROUP BY w.conv_id, w.round"""
    cut = f"SELECT conv_id, round, found, list_transform(list_sort(fresh)[1:room], lambda x: x.d) AS last FROM ({step}) WHERE room > 0"
    return f"walk AS (SELECT conv_id, 0 AS round, l AS found, l AS last FROM ({best}) UNION ALL SELECT conv_id, round, list_concat(found, last), last FROM ({cut}))"


@query(
    "v13_item_retrieval",
    f"""WITH RECURSIVE {ITEM_SQL}, x AS (SELECT doc, array_to_string(words, ' ') AS text FROM d),
    v AS (SELECT conv_id, id, v FROM {word_vectors_sql('x', 'doc', 64)} JOIN d ON d.doc = id),
    e AS (SELECT a.conv_id, a.id AS src, b.id AS dst FROM v a JOIN v b ON a.conv_id = b.conv_id AND a.id <> b.id
      QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY round({COSINE}, 9) DESC, b.id) <= 3),
    {_walk_sql(20, 'e')}
    SELECT conv_id AS query, unnest(last) AS doc, round::INTEGER AS round, unnest(range(1, len(last) + 1))::INTEGER AS rank FROM walk""",
)
def _(spark, sf):
    turns = table(spark, sf, "conversations")
    keyed = turns.where("turn > 0").withColumn("key", F.concat_ws("/", "conv_id", "turn"))
    chunks = retrieval.word_chunks(keyed, "key", tx.words(F.col("text")), 20).join(keyed.select("key", "conv_id"), "key")
    passages = cut_lineage(chunks.select("conv_id", F.concat_ws("/", "key", "chunk").alias("doc"), "words"), "passages")
    documents, terms = retrieval.weighted_documents(passages, "doc", F.col("words"), by="conv_id")
    asked = turns.where("turn = 0").select("conv_id", F.col("conv_id").alias("query"), "text")
    queries = retrieval.weighted_queries(asked, "query", tx.words(F.col("text")), terms)
    vectors = encoders.word_vectors(passages, "doc", F.col("words"), 64).withColumnRenamed("doc", "id")
    items = cut_lineage(vectors.join(passages.select(F.col("doc").alias("id"), "conv_id"), "id"), "vectors")
    edges = cut_lineage(nearest.knn_graph_by(items, "conv_id", 3).select("src", "dst"), "edges")
    return retrieval.graph_retrieval(queries, documents, edges, 20)


@query(
    "v14_index_round_trip",
    f"""WITH t AS {top_sql(DOT, 3)} SELECT query, id, score, rank FROM t""",
)
def _(spark, sf):
    path = scratch_path(spark, "index")
    files.saved_or_built(_vectors(spark, sf).select("id", "vector"), path)
    saved = files.saved_or_built(_vectors(spark, sf).select("id", "vector").limit(0), path)  # reads what is there
    return nearest.top_k(_as_queries(saved), saved, 3)


@query(
    "v15_retrieval_prompts",
    rf"""WITH w AS (SELECT doc_id, {WORDS} AS words FROM documents),
    c AS (SELECT doc_id, unnest(range((len(words) + 99) // 100)) AS chunk, words FROM w),
    d AS (SELECT doc_id || '/' || chunk AS doc, words[chunk * 100 + 1 : chunk * 100 + 100] AS words FROM c),
    q AS (SELECT item_id AS query, {WORDS} AS words, text FROM benchmark), {tfidf_sql('d', 'q', 3)},
    x AS (SELECT query, string_agg(array_to_string(words, ' '), E'\n---\n' ORDER BY rank) AS context FROM found JOIN d USING (doc) GROUP BY query)
    SELECT query, E'Use only this:\n' || coalesce(context, '') || E'\nQuestion: ' || text AS prompt FROM q LEFT JOIN x USING (query)""",
)
def _(spark, sf):
    chunks = retrieval.word_chunks(table(spark, sf, "documents"), "doc_id", tx.words(F.col("text")), 100)
    # Written as texts alone: a word has no blank, so the words of a passage are its text cut at blanks.
    passages = cut_lineage(chunks.select(F.concat_ws("/", "doc_id", "chunk").alias("doc"), F.array_join("words", " ").alias("text")), "passages")
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("query"), "text")
    documents, idf = retrieval.weighted_documents(passages, "doc", F.split("text", " "))
    found = retrieval.tfidf_top(retrieval.weighted_queries(items, "query", tx.words(F.col("text")), idf), documents, 3)
    return retrieval.retrieval_prompts(found, passages, items, "Use only this:\n{context}\nQuestion: {question}")


CUTOFFS = [1, 5, 10]


def _ranking_sql(metric: str) -> str:
    cells = {
        "recall_hit": "least(h, 1) / greatest(least(k, truths), 1)",
        "recall_set": "h / greatest(least(k, truths), 1)",
        "mrr": "CASE WHEN first <= k THEN 1.0 / first ELSE 0 END",
        "ndcg": "CASE WHEN least(k, total) > 0 THEN dcg / ideal[CAST(least(k, total) AS INTEGER)] ELSE 0 END",
    }
    return f"""WITH t AS {top_sql(DOT, 10, on='a.id <> b.id')}, k AS (SELECT unnest({CUTOFFS}) AS k),
    i AS (SELECT list(s ORDER BY n) AS ideal FROM (SELECT n, sum(1 / log2(n + 1)) OVER (ORDER BY n) AS s FROM range(1, 11) r(n))),
    s AS (SELECT label, count(*) - 1 AS truths FROM embeddings GROUP BY label),
    p AS (SELECT query, k, any_value(truths) AS truths, count(*) FILTER (WHERE qlabel = t.label AND rank <= k) AS h, count(*) FILTER (WHERE qlabel = t.label) AS total,
        min(rank) FILTER (WHERE qlabel = t.label) AS first, coalesce(sum(1 / log2(rank + 1)) FILTER (WHERE qlabel = t.label AND rank <= k), 0) AS dcg
      FROM t CROSS JOIN k JOIN s ON s.label = qlabel GROUP BY query, k)
    SELECT k, round(avg({cells[metric]}), 6) AS value FROM p, i GROUP BY k"""


def _ranking(spark, sf, metric):
    vectors = _vectors(spark, sf)
    labels = vectors.select("id", "label")
    found = nearest.top_k(_as_queries(vectors), vectors, 10, skip_same=True)
    sizes = labels.groupBy("label").agg((F.count(F.lit(1)) - 1).alias("truths"))
    queries = labels.join(sizes, "label").select(F.col("id").alias("query"), F.col("label").alias("qlabel"), "truths")
    marked = found.join(labels, "id").join(queries.select("query", "qlabel"), "query")
    hits = marked.withColumn("hit", (F.col("label") == F.col("qlabel")).cast("int"))
    report = metrics.ranking_report(hits, queries, CUTOFFS).where(F.col("metric") == metric)
    return report.select("k", F.round("value", 6).alias("value"))


@query("e1_recall_hit", _ranking_sql("recall_hit"))
def _(spark, sf):
    return _ranking(spark, sf, "recall_hit")


@query("e2_recall_set", _ranking_sql("recall_set"))
def _(spark, sf):
    return _ranking(spark, sf, "recall_set")


@query("e3_mrr", _ranking_sql("mrr"))
def _(spark, sf):
    return _ranking(spark, sf, "mrr")


@query("e4_ndcg", _ranking_sql("ndcg"))
def _(spark, sf):
    return _ranking(spark, sf, "ndcg")


SAMPLED = f"""(SELECT *, e * 1000000000 + id AS qid FROM {TRAIN}, range(3) r(e)
  QUALIFY row_number() OVER (PARTITION BY e, label ORDER BY md5(concat_ws(':', 'bench', e || ':' || id)), id) <= 8)"""


@query(
    "e15_embedding_benchmark",
    f"""WITH s AS {SAMPLED}, t AS (SELECT a.id AS query, a.label AS gold, b.e, b.label, row_number() OVER (PARTITION BY b.e, a.id
        ORDER BY round({COSINE}, 9) DESC, b.qid) AS rank FROM {TEST} a, s b QUALIFY rank <= 5),
    p AS (SELECT e, query, gold, label AS pred, count(*) AS n FROM t GROUP BY e, query, gold, label QUALIFY row_number() OVER (PARTITION BY e, query ORDER BY n DESC, label) = 1),
    r AS ({report_sql('(SELECT e, gold, pred FROM p)', '1.0', 'e')})
    SELECT round(avg(accuracy), 5) AS accuracy, round(avg(f1), 5) AS f1 FROM r""",
)
def _(spark, sf):
    train, test = _split(spark, sf)
    runs = 3
    experiments = F.explode(F.array(*[F.lit(e) for e in range(runs)]))
    repeated = train.withColumn("experiment", experiments).withColumn("draw", F.concat_ws(":", "experiment", "id"))
    sample = rows.sampled_per_group(repeated, ["experiment", "label"], "bench", "draw", 8).drop("draw")
    predicted = None
    for e in range(runs):
        part = sample.where(F.col("experiment") == e).drop("experiment")
        run = nearest.knn_classes(_as_queries(test.drop("label")), part, 5).withColumn("experiment", F.lit(e))
        predicted = run if predicted is None else predicted.unionByName(run)
    aligned = predicted.join(test.select(F.col("id").alias("query"), "label"), "query")
    report = metrics.classification_report(aligned, "label", "predicted", by=["experiment"])
    return report.agg(F.round(F.avg("accuracy"), 5).alias("accuracy"), F.round(F.avg("f1"), 5).alias("f1"))
