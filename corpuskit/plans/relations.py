"""Joins and aggregations (J*, A*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.functions import text as tx
from corpuskit.operators import lookups, pairs, rows, tokens, votes
from corpuskit.plans.ordered import ROLE_WORDS, _role_votes
from corpuskit.plans.registry import query, table
from corpuskit.plans.scalar import WORDS


@query(
    "j1_strict_lookup",
    "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def _(spark, sf):
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    found = lookups.strict_lookup(table(spark, sf, "customer"), nations, "c_nationkey", "n_name")
    return found.select("c_custkey", "c_name", "n_name")


@query(
    "j2_left_lookup",
    "SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey",
)
def _(spark, sf):
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    found = lookups.left_lookup(table(spark, sf, "supplier"), nations, "s_nationkey", ["n_name"])
    return found.select("s_suppkey", "s_name", "n_name")


@query(
    "j3_semi_join_targets",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#1')""",
)
def _(spark, sf):
    targets = table(spark, sf, "part").where(F.col("p_brand") == "Brand#1").select(F.col("p_partkey").alias("l_partkey"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lines.join(targets, "l_partkey", "left_semi").select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "j4_not_cached",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
)
def _(spark, sf):
    done = table(spark, sf, "orders").where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return lookups.not_cached(table(spark, sf, "customer").select("c_custkey", "c_name"), done, "c_custkey")


PAIRS = """(SELECT DISTINCT a.l_orderkey, a.l_partkey AS a, b.l_partkey AS b FROM lineitem a
  JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey)"""


def _order_pairs(spark, sf):
    return pairs.unordered_pairs(table(spark, sf, "lineitem"), "l_orderkey", "l_partkey")


@query(
    "j6_both_ends",
    f"""SELECT p.a, p.b, x.p_brand AS p_brand_a, x.p_retailprice AS p_retailprice_a, y.p_brand AS p_brand_b,
      y.p_retailprice AS p_retailprice_b FROM (SELECT DISTINCT a, b FROM {PAIRS}) p
    LEFT JOIN part x ON x.p_partkey = p.a LEFT JOIN part y ON y.p_partkey = p.b""",
)
def _(spark, sf):
    distinct = pairs.distinct_pairs(table(spark, sf, "lineitem"), "l_orderkey", "l_partkey")
    return pairs.with_both_ends(distinct, table(spark, sf, "part"), "p_partkey", ["p_brand", "p_retailprice"])


@query("j7_unordered_pairs", f"SELECT l_orderkey, a, b FROM {PAIRS}")
def _(spark, sf):
    return _order_pairs(spark, sf)


@query("j8_all_pairs", "SELECT x.n_name AS a, y.n_name AS b FROM nation x JOIN nation y ON x.n_name < y.n_name")
def _(spark, sf):
    return pairs.all_pairs(table(spark, sf, "nation"), "n_name")


@query("j9_rows_by_catalogue", "SELECT s_suppkey, r_name FROM supplier, region")
def _(spark, sf):
    return lookups.each_with(table(spark, sf, "supplier").select("s_suppkey"), table(spark, sf, "region"), "r_name")


@query(
    "j10_sign_labels",
    """WITH d AS (SELECT * FROM (VALUES (1, 1), (1, -1), (-1, 1), (-1, -1)) t(dx, dy)),
    p AS (SELECT c_custkey, c_acctbal * dx AS x, (c_nationkey - 12) * dy AS y FROM customer, d)
    SELECT c_custkey, x, y, CAST(x > 0 AS INTEGER) AS right, CAST(y > 0 AS INTEGER) AS up FROM p""",
)
def _(spark, sf):
    points = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    out = lookups.sign_labels(points, F.col("c_acctbal"), F.col("c_nationkey") - 12)
    return out.select("c_custkey", "x", "y", "right", "up")


@query(
    "j11_align_predictions",
    """SELECT doc_id, CAST(n_chars > 500 AS INTEGER) AS prediction, quality AS gold
    FROM documents JOIN labels USING (doc_id)""",
)
def _(spark, sf):
    predicted = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") > 500).cast("int").alias("prediction"))
    gold = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("gold"))
    return predicted.join(gold, "doc_id")


@query(
    "j12_side_by_side",
    """SELECT doc_id, lang, source, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return lookups.side_by_side(docs, table(spark, sf, "labels"), "doc_id").fillna(-1, ["quality", "toxic"])


EVENT_TYPES = ["signup", "view", "click", "purchase"]
EVENT_IDS = "(VALUES ('signup', 0), ('view', 1), ('click', 2), ('purchase', 3)) t(event_type, label_id)"


@query(
    "j13_label_ids",
    f"SELECT event_id, event_type, coalesce(label_id, -1) AS label_id FROM events LEFT JOIN {EVENT_IDS} USING (event_type)",
)
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    ids = lookups.with_label_id(events, lookups.catalogue_frame(events, EVENT_TYPES), "event_type")
    return ids.select("event_id", "event_type", "label_id")


@query("p17_known_labels", f"SELECT event_id, event_type, label_id FROM events JOIN {EVENT_IDS} USING (event_type)")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    ids = lookups.known_only(events, lookups.catalogue_frame(events, EVENT_TYPES), "event_type")
    return ids.select("event_id", "event_type", "label_id")


@query(
    "a1_group_members",
    "SELECT label, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS BIGINT) AS pos, vec_id FROM embeddings",
)
def _(spark, sf):
    return votes.group_members(table(spark, sf, "embeddings"), "label", "vec_id")


@query("a2_group_sizes", "SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL")
def _(spark, sf):
    return votes.group_sizes(table(spark, sf, "documents"), ["lang", "source"])


@query("a2_size_histogram", f"SELECT CAST(len({WORDS}) AS INTEGER) AS size, count(*) AS n FROM documents GROUP BY 1")
def _(spark, sf):
    return votes.size_histogram(table(spark, sf, "documents"), tx.words(F.col("text")))


@query("a3_vote_counts", f"SELECT role, word, count(*) AS votes FROM {ROLE_WORDS} GROUP BY role, word")
def _(spark, sf):
    return _role_votes(spark, sf)


@query(
    "a4_catalogue_coverage",
    """SELECT user_id, count(*) FILTER (WHERE event_type IN ('signup', 'view')) AS in_count,
      count(*) FILTER (WHERE event_type NOT IN ('signup', 'view')) AS out_count FROM events GROUP BY user_id""",
)
def _(spark, sf):
    return votes.catalogue_coverage(table(spark, sf, "events"), ["user_id"], "event_type", ["signup", "view"])


@query(
    "a4_catalogue_misses",
    "SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('signup', 'view') GROUP BY event_type",
)
def _(spark, sf):
    return votes.catalogue_misses(table(spark, sf, "events"), "event_type", ["signup", "view"])


@query("a5_pair_counts", f"SELECT a, b, count(*) AS n FROM {PAIRS} GROUP BY a, b")
def _(spark, sf):
    return pairs.pair_counts(table(spark, sf, "lineitem"), "l_orderkey", "l_partkey")


@query(
    "a6_both_in",
    f"""WITH t AS (SELECT p_partkey FROM part WHERE p_brand IN ('Brand#1', 'Brand#2'))
    SELECT a, b, count(*) AS n, CAST(a IN (SELECT p_partkey FROM t) AND b IN (SELECT p_partkey FROM t) AS INTEGER) AS both_in
    FROM {PAIRS} GROUP BY a, b""",
)
def _(spark, sf):
    counted = pairs.pair_counts(table(spark, sf, "lineitem"), "l_orderkey", "l_partkey")
    targets = table(spark, sf, "part").where(F.col("p_brand").isin("Brand#1", "Brand#2"))
    return pairs.flag_both_in(counted, targets, "p_partkey").select("a", "b", "n", "both_in")


@query(
    "a7_distinct_characters",
    r"""SELECT DISTINCT token FROM (SELECT unnest(string_split(text, '')) AS token FROM documents)
    WHERE regexp_matches(token, '[\x{c0}-\x{24f}]')""",
)
def _(spark, sf):
    characters = tx.characters_in(F.col("text"), 0xC0, 0x24F)
    return tokens.distinct_tokens(table(spark, sf, "documents"), characters)


@query("a8_distinct_labels", "SELECT count(DISTINCT quality) AS labels, count(DISTINCT doc_id) AS documents FROM labels")
def _(spark, sf):
    return table(spark, sf, "labels").agg(
        F.countDistinct("quality").alias("labels"), F.countDistinct("doc_id").alias("documents")
    )


@query(
    "a9_largest_suffix",
    r"""SELECT regexp_extract(url, '^(.*)/', 1) AS folder, coalesce(max(TRY_CAST(regexp_extract(url, '/(\d+)[^/]*$', 1) AS BIGINT)), -1) AS largest
    FROM pages GROUP BY 1""",
)
def _(spark, sf):
    folder, suffix = F.regexp_extract("url", r"^(.*)/", 1), F.regexp_extract("url", r"/(\d+)[^/]*$", 1)
    return votes.largest_suffix(table(spark, sf, "pages"), folder, suffix).fillna(-1, ["largest"])


DAYS = {1: "sun", 2: "mon", 3: "tue", 4: "wed", 5: "thu", 6: "fri", 7: "sat"}


@query(
    "a10_metric_pivot",
    "SELECT event_type, "
    + ", ".join(f"round(avg(value / 1000) FILTER (WHERE dayofweek(ts) = {d - 1}) * 100, 2) AS {n}" for d, n in DAYS.items())
    + " FROM events GROUP BY event_type",
)
def _(spark, sf):
    events = table(spark, sf, "events").withColumn("day", F.dayofweek("ts"))
    return votes.percent_pivot(events, "event_type", "day", DAYS, F.col("value") / 1000)


@query(
    "a11_one_hot_pivot",
    "SELECT user_id, "
    + ", ".join(f"max(CAST(event_type = '{t}' AS INTEGER)) AS type_{t}" for t in EVENT_TYPES)
    + " FROM events GROUP BY user_id",
)
def _(spark, sf):
    return votes.one_hot_pivot(table(spark, sf, "events"), "user_id", "event_type", EVENT_TYPES, prefix="type_")


@query(
    "a13_repeated_mean",
    """WITH s AS (SELECT experiment, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings, range(5) t(experiment)
      QUALIFY row_number() OVER (PARTITION BY experiment, label ORDER BY md5(concat_ws(':', 'run', experiment, vec_id)), vec_id) <= 8),
    p AS (SELECT experiment, label, CAST(unnest(range(len(v))) AS INTEGER) AS pos, unnest(v) AS x FROM s),
    e AS (SELECT experiment, label, pos, avg(x) AS m FROM p GROUP BY experiment, label, pos)
    SELECT label, pos, round(avg(m), 6) AS mean FROM e GROUP BY label, pos""",
)
def _(spark, sf):
    runs = F.explode(F.array(*[F.lit(i) for i in range(5)]))
    repeated = table(spark, sf, "embeddings").select("vec_id", "label", "embedding").withColumn("experiment", runs).withColumn("draw_key", F.concat_ws(":", "experiment", "vec_id"))
    sample = rows.sampled_per_group(repeated, ["experiment", "label"], "run", "draw_key", 8)
    per_run = votes.mean_vectors(sample.withColumn("run", F.struct("experiment", "label")), "run", "embedding")
    return per_run.groupBy("run.label", "pos").agg(F.round(F.avg("x"), 6).alias("mean"))


@query(
    "a14_mean_vectors",
    """WITH e AS (SELECT label, CAST(unnest(range(64)) AS INTEGER) AS pos, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings)
    SELECT label, pos, round(avg(x), 6) AS x FROM e GROUP BY label, pos""",
)
def _(spark, sf):
    return votes.mean_vectors(table(spark, sf, "embeddings"), "label", "embedding").withColumn("x", F.round("x", 6))


