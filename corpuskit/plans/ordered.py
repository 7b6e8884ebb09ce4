"""Ordered rows, samples and set operations (W*, K*, U*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.functions import text as tx
from corpuskit.functions.permute import permuted_sql
from corpuskit.operators import dialogue, lookups, rows, votes
from corpuskit.plans.registry import query, table
from corpuskit.plans.scalar import WORDS


def shuffled_sql(columns: str, catalogue: str, name: str, n: int, seed: str) -> str:
    """A table r of suppliers and their shuffles: the entry of a catalogue of n at each place i."""
    places = f"(SELECT {columns}, i, i AS x FROM supplier, range({n}) AS t(i))"
    return f"""n AS (SELECT {name}, row_number() OVER (ORDER BY {name}) - 1 AS x FROM {catalogue}),
    r AS (SELECT {columns}, i, {name} FROM {permuted_sql(places, seed, 's_suppkey', n)} JOIN n USING (x))"""


@query("w1_chunk_ids", "SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) // 128 AS BIGINT) AS chunk FROM documents")
def _(spark, sf):
    return rows.chunked(table(spark, sf, "documents").select("doc_id"), "doc_id", 128)


@query(
    "w2_catalogue_blocks",
    f"""WITH {shuffled_sql('s_suppkey', 'nation', 'n_name', 25, 'blocks')}
    SELECT s_suppkey, CAST(i // 7 AS INTEGER) AS block, string_agg(n_name, ',' ORDER BY i) AS members
    FROM r GROUP BY s_suppkey, i // 7""",
)
def _(spark, sf):
    firms = table(spark, sf, "supplier").select("s_suppkey")
    out = lookups.catalogue_blocks(firms, table(spark, sf, "nation"), "n_name", "s_suppkey", 7, "blocks")
    return out.select("s_suppkey", "block", F.array_join("members", ",").alias("members"))


@query("w3_round_robin", "SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 3 AS BIGINT) AS endpoint FROM documents")
def _(spark, sf):
    return rows.round_robin(table(spark, sf, "documents").select("doc_id"), "doc_id", 3)


@query(
    "w4_call_slots",
    """WITH t AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer)
    SELECT c_custkey, CAST(i % 2 AS BIGINT) AS endpoint, CAST((i // 2) // 3 AS BIGINT) AS second FROM t""",
)
def _(spark, sf):
    return rows.call_slots(table(spark, sf, "customer").select("c_custkey"), "c_custkey", endpoints=2, per_second=3)


@query(
    "w5_undersample",
    """SELECT vec_id, label FROM embeddings
    QUALIFY row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws(':', 'under', vec_id)), vec_id) <= 8""",
)
def _(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", "label")
    return rows.sampled_per_group(vectors, ["label"], "under", "vec_id", 8)


@query("w6_daily_quota", "SELECT c_custkey, CAST((row_number() OVER (ORDER BY c_custkey) - 1) // 400 AS BIGINT) AS day FROM customer")
def _(spark, sf):
    return rows.daily_quota(table(spark, sf, "customer").select("c_custkey"), "c_custkey", 400)


@query(
    "w7_error_budget",
    """WITH t AS (SELECT event_id, user_id, CAST(coalesce(sum(CAST(event_type = 'error' AS INTEGER)) OVER (PARTITION BY user_id
        ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS failures_before FROM events)
    SELECT event_id, user_id, failures_before, failures_before < 5 AS attempted FROM t""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    out = rows.within_error_budget(events, ["user_id"], "event_id", F.col("event_type") == "error", 5)
    return out.drop("event_type")


@query(
    "w8_conversation_history",
    r"""SELECT conv_id, turn, coalesce(string_agg(role || ': ' || text, E'\n') OVER (PARTITION BY conv_id ORDER BY turn
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS history FROM conversations""",
)
def _(spark, sf):
    return dialogue.with_history(table(spark, sf, "conversations")).select("conv_id", "turn", "history")


@query(
    "w9_same_source_batches",
    """SELECT doc_id, source, source || '-' || CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 16 AS BIGINT) AS batch
    FROM documents""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return rows.same_source_batches(docs, "source", "doc_id", 16)


@query(
    "w10_top_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_totalprice DESC, o_orderkey)::INTEGER AS rank FROM orders QUALIFY rank <= 3""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return rows.top_per_key(orders, ["o_custkey"], "o_totalprice", "o_orderkey", 3)


ROLE_WORDS = f"(SELECT role, unnest({WORDS}) AS word FROM conversations)"
BENCHMARK_WORDS = f"(SELECT DISTINCT unnest({WORDS}) AS word FROM benchmark)"


def _role_votes(spark, sf):
    return votes.votes(table(spark, sf, "conversations"), "role", tx.words(F.col("text")), "word")


def _benchmark_words(spark, sf):
    return table(spark, sf, "benchmark").select(F.explode(tx.words(F.col("text"))).alias("word")).distinct()


@query(
    "k1_ranked_votes",
    f"""SELECT role, word, count(*) AS votes FROM {ROLE_WORDS} WHERE word IN (SELECT word FROM {BENCHMARK_WORDS})
    GROUP BY role, word ORDER BY role, votes DESC, word""",
)
def _(spark, sf):
    return votes.ranked_votes(_role_votes(spark, sf), _benchmark_words(spark, sf), "role", "word")


@query(
    "k1_removed_votes",
    f"""SELECT role, count(DISTINCT word) AS removed FROM {ROLE_WORDS} WHERE word NOT IN (SELECT word FROM {BENCHMARK_WORDS})
    GROUP BY role""",
)
def _(spark, sf):
    return votes.removed_votes(_role_votes(spark, sf), _benchmark_words(spark, sf), "role", "word")


@query("k2_shuffled_head", "SELECT doc_id, lang FROM documents ORDER BY md5(concat_ws(':', 'take', doc_id)), doc_id LIMIT 100")
def _(spark, sf):
    return rows.shuffled_head(table(spark, sf, "documents"), "take", "doc_id", 100).select("doc_id", "lang")


@query(
    "k2_half_sample",
    """SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', 'half', l_orderkey * 8 + l_linenumber))) AS n,
      count(*) OVER () AS total FROM lineitem) WHERE n <= total // 2""",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    keyed = lines.withColumn("row", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint"))
    return rows.shuffled_head(keyed, "half", "row", lines.count() // 2).drop("row")


@query(
    "k2_nested_samples",
    """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5(concat_ws(':', 'take', doc_id)), doc_id) AS n FROM documents)
    SELECT CAST(size AS INTEGER) AS size, doc_id FROM r, (SELECT unnest([50, 100, 500]) AS size) WHERE n <= size""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    return rows.nested_samples(docs, "take", "doc_id", [50, 100, 500]).select("size", "doc_id")


@query("p5_text_key_ids", "SELECT c_name, CAST(row_number() OVER (ORDER BY c_name) - 1 AS VARCHAR) AS id FROM customer")
def _(spark, sf):
    return rows.string_ids(table(spark, sf, "customer").select("c_name"), "c_name")


DRAW = "CAST('0x' || substr(md5(concat_ws(':', '{seed}', {key})), 1, 8) AS BIGINT)"


@query(
    "k3_ratio_split",
    f"""SELECT doc_id, CASE WHEN {DRAW.format(seed='42', key='doc_id')} % 100 < 20 THEN 'test' ELSE 'train' END AS split
    FROM documents""",
)
def _(spark, sf):
    return rows.split_by_ratio(table(spark, sf, "documents").select("doc_id"), "42", "doc_id", 20)


@query(
    "k3_count_split",
    """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5(concat_ws(':', '42', doc_id)), doc_id) <= 150
      THEN 'test' ELSE 'train' END AS split FROM documents""",
)
def _(spark, sf):
    return rows.split_by_count(table(spark, sf, "documents").select("doc_id"), "42", "doc_id", 150)


@query(
    "k4_source_cap",
    """SELECT doc_id, source FROM documents
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5(concat_ws(':', 'cap', doc_id)), doc_id) <= 10""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return rows.sampled_per_group(docs, ["source"], "cap", "doc_id", 10)


@query(
    "k4_large_group_cap",
    """SELECT doc_id, lang FROM documents
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5(concat_ws(':', 'cap', doc_id)), doc_id) <= 150""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return rows.sampled_per_group(docs, ["lang"], "cap", "doc_id", 150)


@query("k5_first_rows", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 500")
def _(spark, sf):
    return table(spark, sf, "documents").orderBy("doc_id").limit(500).select("doc_id", "lang")


@query(
    "k6_sorted_members",
    f"SELECT doc_id, array_to_string(list_sort(list_distinct({WORDS})), ' ') AS members FROM documents",
)
def _(spark, sf):
    members = F.array_sort(F.array_distinct(tx.words(F.col("text"))))
    return table(spark, sf, "documents").select("doc_id", F.array_join(members, " ").alias("members"))


@query(
    "u1_concatenate",
    """SELECT c_name AS name, c_acctbal AS balance, 'customer' AS part FROM customer
    UNION ALL SELECT s_name, s_acctbal, 'supplier' FROM supplier""",
)
def _(spark, sf):
    def part(name, prefix):
        return table(spark, sf, name).select(
            F.col(f"{prefix}_name").alias("name"), F.col(f"{prefix}_acctbal").alias("balance"), F.lit(name).alias("part")
        )

    return part("customer", "c").unionByName(part("supplier", "s"))


@query(
    "u2_later_wins",
    "SELECT user_id, max(event_id) AS event_id, arg_max(props, event_id) AS props FROM events GROUP BY user_id",
)
def _(spark, sf):
    from corpuskit.sources import keyed

    events = table(spark, sf, "events").select("user_id", "event_id", "props")
    return keyed.latest_per_key(events, ["user_id"], F.col("event_id"))


@query(
    "u3_intersection_size",
    f"""WITH h AS (SELECT doc_id, {WORDS.replace('text', "substring(text, 1, length(text) // 2)")} AS a,
        {WORDS.replace('text', "substring(text, length(text) // 2 + 1)")} AS b FROM documents)
    SELECT doc_id, CAST(len(list_intersect(list_distinct(a), list_distinct(b))) AS INTEGER) AS shared FROM h""",
)
def _(spark, sf):
    half = F.floor(F.length("text") / 2).cast("int")
    first = tx.words(F.substring("text", F.lit(1), half))
    second = tx.words(F.substring("text", half + 1, F.length("text")))
    return table(spark, sf, "documents").select("doc_id", F.size(F.array_intersect(first, second)).alias("shared"))


@query(
    "u4_set_difference",
    f"""SELECT word FROM {BENCHMARK_WORDS} EXCEPT SELECT unnest({WORDS}) FROM documents""",
)
def _(spark, sf):
    seen = table(spark, sf, "documents").select(F.explode(tx.words(F.col("text"))).alias("word")).distinct()
    return _benchmark_words(spark, sf).join(seen, "word", "left_anti")


@query("u5_flatten_lists", "SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line"))


@query("u6_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_type").distinct()


