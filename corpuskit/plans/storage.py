"""Scans, sinks and keyed tables (S*). The queries write the given tables in another form and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.functions import prompts
from corpuskit.operators import lookups, rows
from corpuskit.plans.registry import query, table
from corpuskit.session import scratch_path
from corpuskit.sources import files, keyed, sqltable

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
DOCUMENT = "doc_id bigint, text string, lang string, n_chars bigint"
ORDER = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"


@query("s1_csv_scan", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    files.write_csv(table(spark, sf, "customer"), path)
    return files.read_csv(spark, path, CUSTOMER, ["c_custkey", "c_name", "c_acctbal"])


@query("s2_folder_scan", "SELECT doc_id, text, source FROM documents")
def _(spark, sf):
    path = scratch_path(spark, "folder")
    files.write_jsonl(table(spark, sf, "documents"), path, by="source")
    found = files.read_folder(spark, path, DOCUMENT, "json", ".json")
    return found.select("doc_id", "text", F.regexp_extract("file", "/source=([^/]+)/", 1).alias("source"))


@query("s3_jsonl_scan", "SELECT conv_id, turn, role, text FROM conversations")
def _(spark, sf):
    path = scratch_path(spark, "jsonl")
    files.write_jsonl(table(spark, sf, "conversations"), path)
    found = files.read_jsonl(spark, path, "conv_id bigint, turn bigint, role string, text string")
    return found.where(F.col("corrupt").isNull()).drop("corrupt")


@query("s4_json_array_scan", "SELECT doc_id, text, lang, n_chars FROM documents")
def _(spark, sf):
    path = scratch_path(spark, "arrays")
    docs = rows.chunked(table(spark, sf, "documents"), "doc_id", 100)
    arrays = docs.groupBy("chunk").agg(F.to_json(F.collect_list(F.struct("doc_id", "text", "lang", "n_chars"))).alias("value"))
    arrays.write.partitionBy("chunk").text(path)
    return files.read_json_arrays(spark, path, DOCUMENT).select("doc_id", "text", "lang", "n_chars")


@query(
    "s5_keyed_json_scan",
    "SELECT CAST(user_id AS VARCHAR) AS key, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1",
)
def _(spark, sf):
    path = scratch_path(spark, "cache")
    batches = rows.chunked(table(spark, sf, "events"), "event_id", 1000, name="batch")
    latest = keyed.latest_per_key(batches.select("batch", "user_id", "event_id", "event_type"), ["batch", "user_id"], F.col("event_id"))
    entry = F.struct(F.col("user_id").cast("string"), F.struct("event_id", "event_type"))
    maps = latest.groupBy("batch").agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    maps.write.partitionBy("batch").text(path)
    number = F.regexp_extract("file", r"/batch=(\d+)/", 1).cast("bigint")
    found = files.read_keyed_json(spark, path, "struct<event_id: bigint, event_type: string>", recency=number)
    return found.select("key", "response.event_id", "response.event_type")


@query("s6_whole_texts", "SELECT source, CAST(sum(n_chars + 1) AS BIGINT) AS characters FROM documents GROUP BY source")
def _(spark, sf):
    path = scratch_path(spark, "texts")
    table(spark, sf, "documents").select("source", "text").write.partitionBy("source").text(path)
    texts = files.read_whole_texts(spark, path)
    source = F.regexp_extract("file", "/source=([^/]+)/", 1).alias("source")
    return texts.groupBy(source).agg(F.sum(F.length("text")).alias("characters"))


@query(
    "s7_split_scan",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE CAST('0x' || substr(md5(concat_ws(':', 'split', l_orderkey)), 1, 8) AS BIGINT) % 100 < 20""",
)
def _(spark, sf):
    path = scratch_path(spark, "splits")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    rows.split_by_ratio(lines, "split", "l_orderkey", 20).write.partitionBy("split").parquet(path)
    return files.read_split(spark, path, "test").drop("split")


@query(
    "s8_content_rows",
    "SELECT text AS content, CAST(doc_id AS VARCHAR) AS doc_id, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents",
)
def _(spark, sf):
    loaded = files.as_content(table(spark, sf, "documents"), "text")
    meta = [F.col("metadata")[k].alias(k) for k in ("doc_id", "lang", "source", "n_chars")]
    return loaded.select("content", *meta)


@query("s9_csv_sink", "SELECT source, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS characters FROM documents GROUP BY source")
def _(spark, sf):
    path = scratch_path(spark, "csvsink")
    files.write_csv(table(spark, sf, "documents").select("doc_id", "text", "source"), path, by="source")
    back = files.read_csv(spark, path, "doc_id bigint, text string, source string", multi_line=True)
    return back.groupBy("source").agg(F.count("doc_id").alias("n"), F.sum(F.length("text")).alias("characters"))


@query("s10_jsonl_sink", "SELECT doc_id, text, lang, n_chars FROM documents")
def _(spark, sf):
    path = scratch_path(spark, "jsonlsink")
    files.write_jsonl(table(spark, sf, "documents").drop("source"), path)
    return files.read_jsonl(spark, path, DOCUMENT).drop("corrupt")


@query("s11_instruction_sink", "SELECT 'Name the language.' AS instruction, text AS input, lang AS output FROM documents")
def _(spark, sf):
    path = scratch_path(spark, "alpaca")
    record = prompts.instruction_record(F.lit("Name the language."), F.col("text"), F.col("lang"))
    files.write_instruction_records(table(spark, sf, "documents").select(*record), path)
    return files.read_jsonl(spark, path, "instruction string, input string, output string").drop("corrupt")


@query("s12_convert_new_files", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def _(spark, sf):
    root = scratch_path(spark, "convert")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    for status in ("F", "O", "P"):
        part = orders.where(F.col("o_orderstatus") == status)
        part.write.mode("append").option("header", "true").csv(f"{root}/in")
        files.convert_new_csv(spark, f"{root}/in", ORDER, f"{root}/out", f"{root}/done")
    return spark.read.parquet(f"{root}/out")


STORED_SQL = "(SELECT DISTINCT o_custkey AS user_id FROM orders WHERE o_orderstatus = 'P')"


def _stored(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("user_id")).distinct()


@query(
    "s13_insert_outcomes",
    f"""SELECT event_id, user_id, CASE WHEN user_id IS NULL THEN -1 WHEN user_id NOT IN (SELECT user_id FROM {STORED_SQL})
      AND row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1 THEN 1 ELSE 0 END AS outcome FROM events""",
)
def _(spark, sf):
    batch = table(spark, sf, "events").select("event_id", "user_id")
    return keyed.insert_outcomes(batch, _stored(spark, sf), "user_id", "event_id").select("event_id", "user_id", "outcome")


@query(
    "s13_insert_if_absent",
    f"""SELECT event_id, user_id, event_type FROM events WHERE user_id NOT IN (SELECT user_id FROM {STORED_SQL})
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""",
)
def _(spark, sf):
    batch = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return keyed.new_rows(batch, _stored(spark, sf), "user_id", "event_id")


@query(
    "s14_find_by_key",
    """SELECT k.c_custkey, coalesce(c_name, 'none') AS c_name FROM (SELECT DISTINCT user_id * 11 AS c_custkey FROM events) k
    LEFT JOIN customer c ON c.c_custkey = k.c_custkey""",
)
def _(spark, sf):
    wanted = table(spark, sf, "events").select((F.col("user_id") * 11).alias("c_custkey"))
    found = keyed.find(table(spark, sf, "customer"), wanted, "c_custkey")
    return found.select("c_custkey", F.coalesce("c_name", F.lit("none")).alias("c_name"))


@query(
    "s14_key_exists",
    "SELECT event_id, user_id * 11 AS c_custkey FROM events WHERE user_id * 11 IN (SELECT c_custkey FROM customer)",
)
def _(spark, sf):
    wanted = table(spark, sf, "events").select("event_id", (F.col("user_id") * 11).alias("c_custkey"))
    return keyed.existing(wanted, table(spark, sf, "customer"), "c_custkey").select("event_id", "c_custkey")


CHANGES_SQL = """(SELECT o_custkey + 100 AS c_custkey, max(o_orderkey) AS last_order,
  CASE WHEN max(o_totalprice) > 400000 THEN max(o_totalprice) END AS c_acctbal FROM orders GROUP BY o_custkey)"""


def customer_changes(orders):
    """Per customer the last order, and a new balance for some; keys beyond the known customers occur too."""
    top = F.max("o_totalprice")
    return orders.groupBy((F.col("o_custkey") + 100).alias("c_custkey")).agg(
        F.max("o_orderkey").alias("last_order"), F.when(top > 400000, top).alias("c_acctbal")
    )


MERGED_SQL = f"""SELECT coalesce(n.c_custkey, c.c_custkey) AS c_custkey, coalesce(c_name, 'none') AS c_name,
    coalesce(n.c_acctbal, c.c_acctbal, -1) AS c_acctbal, coalesce(last_order, -1) AS last_order
  FROM customer c FULL OUTER JOIN {CHANGES_SQL} n ON n.c_custkey = c.c_custkey"""


@query("s15_merge_fields", MERGED_SQL)
def _(spark, sf):
    base = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    merged = lookups.merged_fields(base, customer_changes(table(spark, sf, "orders")), "c_custkey")
    return merged.fillna({"c_name": "none", "c_acctbal": -1.0, "last_order": -1})


@query(
    "s16_sql_fetch",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def _(spark, sf):
    sql = """SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderpriority = :priority
             ORDER BY o_totalprice DESC, o_orderkey"""
    return sqltable.fetch(spark, sql, "many", {"priority": "1-URGENT"}, orders=table(spark, sf, "orders"))


@query(
    "s17_batched_update",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
      CASE WHEN o_totalprice > 300000 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def _(spark, sf):
    path = scratch_path(spark, "table")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = sqltable.updated(
        orders, F.col("o_totalprice") > 300000, {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") * 2}
    )
    changed.write.mode("append").parquet(path)
    return spark.read.schema(orders.schema).parquet(path)


@query(
    "s18_run_ledger",
    """SELECT run, quality, n FROM (SELECT 'first' AS run, quality, count(*) AS n FROM labels GROUP BY quality
      UNION ALL SELECT 'second', toxic, count(*) FROM labels GROUP BY toxic)""",
)
def _(spark, sf):
    path = scratch_path(spark, "runs")
    labels = table(spark, sf, "labels")
    for run, column in (("first", "quality"), ("second", "toxic")):
        files.append_run(labels.groupBy(F.col(column).alias("quality")).agg(F.count(F.lit(1)).alias("n")), path, run)
    return spark.read.parquet(path)
