"""Reading of model output (F10-F12, F19, X7, A12, E13).

The given tables hold no model output, so each event becomes one, in a sound or a broken wrapping by its id.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.functions import parsing
from corpuskit.plans.registry import query, table
from corpuskit.plans.scalar import strip_sql

REPLIES_SQL = r"""(SELECT event_id, event_type, CASE event_id % 6
    WHEN 0 THEN E'```json\n' || props || E'\n```'
    WHEN 1 THEN 'Here it is: ```json ' || props || '``` done'
    WHEN 2 THEN props
    WHEN 3 THEN '```json' || props || ' tail```'
    WHEN 4 THEN '```json' || replace(props, '"', chr(39)) || '```'
    ELSE '```json' || props || ', ' || props || '```' END AS reply FROM events)"""


def _replies(spark, sf):
    kind, props = F.col("event_id") % 6, F.col("props")
    reply = (
        F.when(kind == 0, F.concat(F.lit("```json\n"), props, F.lit("\n```")))
        .when(kind == 1, F.concat(F.lit("Here it is: ```json "), props, F.lit("``` done")))
        .when(kind == 2, props)
        .when(kind == 3, F.concat(F.lit("```json"), props, F.lit(" tail```")))
        .when(kind == 4, F.concat(F.lit("```json"), F.replace(props, F.lit('"'), F.lit("'")), F.lit("```")))
        .otherwise(F.concat(F.lit("```json"), props, F.lit(", "), props, F.lit("```")))
    )
    return table(spark, sf, "events").select("event_id", "event_type", reply.alias("reply"))


BODY_SQL = strip_sql("regexp_extract(reply, '(?s)```json(.*?)```', 1)")


@query(
    "f10_fenced_json",
    f"""WITH b AS (SELECT event_id, {BODY_SQL} AS body FROM {REPLIES_SQL})
    SELECT event_id, CAST(json_valid(body) AS INTEGER) AS valid,
      CASE WHEN json_valid(body) THEN CAST(json_extract_string(body, '$.k') AS INTEGER) ELSE -1 END AS k FROM b""",
)
def _(spark, sf):
    record = parsing.whole_variant(parsing.fenced_json(F.col("reply")))
    return _replies(spark, sf).select(
        "event_id",
        record.isNotNull().cast("int").alias("valid"),
        F.coalesce(F.try_variant_get(record, "$.k", "int"), F.lit(-1)).alias("k"),
    )


LISTS_SQL = r"""(SELECT event_id, event_type, CASE event_id % 6
    WHEN 0 THEN E'<think>maybe [1]</think>\n\n["' || event_type || '", "b"] so'
    WHEN 1 THEN '<think>[0]</think>[' || chr(39) || event_type || chr(39) || ']'
    WHEN 2 THEN 'no list, user ' || user_id
    WHEN 3 THEN '</think>[' || user_id || ', "' || event_type || '"]'
    WHEN 4 THEN E'</think>\n["' || event_type || E'",\n "c"'
    ELSE '["x", "' || event_type || '"] </think> []' END AS reply FROM events)"""


def _list_replies(spark, sf):
    kind, name, user = F.col("event_id") % 6, F.col("event_type"), F.col("user_id").cast("string")
    reply = (
        F.when(kind == 0, F.concat(F.lit('<think>maybe [1]</think>\n\n["'), name, F.lit('", "b"] so')))
        .when(kind == 1, F.concat(F.lit("<think>[0]</think>['"), name, F.lit("']")))
        .when(kind == 2, F.concat(F.lit("no list, user "), user))
        .when(kind == 3, F.concat(F.lit("</think>["), user, F.lit(', "'), name, F.lit('"]')))
        .when(kind == 4, F.concat(F.lit('</think>\n["'), name, F.lit('",\n "c"')))
        .otherwise(F.concat(F.lit('["x", "'), name, F.lit('"] </think> []')))
    )
    return table(spark, sf, "events").select("event_id", "event_type", reply.alias("reply"))


AFTER_THINK_SQL = r"regexp_extract(reply, '(?s)</think>\n*(\[.*?\])', 1)"
FIRST_LIST_SQL = r"regexp_extract(reply, '(?s)(\[.*?\])', 1)"


@query("f11_list_after_think", f"SELECT event_id, {AFTER_THINK_SQL} AS after_think, {FIRST_LIST_SQL} AS first FROM {LISTS_SQL}")
def _(spark, sf):
    reply = F.col("reply")
    return _list_replies(spark, sf).select(
        "event_id", parsing.list_after_think(reply).alias("after_think"), parsing.first_list(reply).alias("first")
    )


@query(
    "f12_list_literal",
    rf"""WITH t AS (SELECT event_id, replace({AFTER_THINK_SQL}, chr(39), '"') AS body FROM {LISTS_SQL})
    SELECT event_id, CASE WHEN json_valid(body) AND regexp_matches(body, '^\[\s*"')
      THEN array_to_string(CAST(json(body) AS VARCHAR[]), '|') ELSE '' END AS items FROM t""",
)
def _(spark, sf):
    items = parsing.text_list(parsing.list_after_think(F.col("reply")))
    return _list_replies(spark, sf).select("event_id", F.array_join(items, "|").alias("items"))


@query(
    "f19_lon_lat",
    """SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal / 100 ELSE -999 END AS lon,
      CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_nationkey AS DOUBLE) ELSE -999 END AS lat FROM customer""",
)
def _(spark, sf):
    place = F.concat((F.col("c_acctbal") / 100).cast("string"), F.lit(","), F.col("c_nationkey").cast("string"))
    found = F.concat(F.lit('{"status":"1","geocodes":[{"location":"'), place, F.lit('"},{"location":"0,0"}]}'))
    response = F.when(F.col("c_custkey") % 5 != 0, found).otherwise(F.lit('{"status":"1","geocodes":[]}'))
    read = table(spark, sf, "customer").select("c_custkey", parsing.lon_lat(response).alias("p"))
    return read.select("c_custkey", "p.lon", "p.lat").fillna(-999.0, ["lon", "lat"])


RECORDS_SQL = r"""(SELECT event_id, event_type, CASE event_id % 7
    WHEN 0 THEN E'```json\n' || r || E'\n```'
    WHEN 1 THEN E'the answer is below ```  \n\n' || r || E'\n\n ```'
    WHEN 2 THEN r
    WHEN 3 THEN r || ' and more'
    WHEN 4 THEN replace(r, '"reason"', '"reasons"')
    WHEN 5 THEN replace(r, '"label": ', '"label": 1, "old": ')
    ELSE 'sorry' END AS reply
  FROM (SELECT event_id, event_type, '{"reason": "user ' || user_id || '", "label": ' || CASE WHEN event_id % 2 = 0
      THEN '"' || event_type || '"' ELSE '["' || event_type || '", "view"]' END || ', "confidence": ' || (event_id % 130) || 'e-2}' AS r
    FROM events))"""


def _records(spark, sf):
    name = F.col("event_type")
    label = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('"'), name, F.lit('"'))).otherwise(
        F.concat(F.lit('["'), name, F.lit('", "view"]'))
    )
    record = F.concat(
        F.lit('{"reason": "user '), F.col("user_id").cast("string"), F.lit('", "label": '), label,
        F.lit(', "confidence": '), (F.col("event_id") % 130).cast("string"), F.lit("e-2}"),
    )
    kind, r = F.col("event_id") % 7, F.col("r")
    reply = (
        F.when(kind == 0, F.concat(F.lit("```json\n"), r, F.lit("\n```")))
        .when(kind == 1, F.concat(F.lit("the answer is below ```  \n\n"), r, F.lit("\n\n ```")))
        .when(kind == 2, r)
        .when(kind == 3, F.concat(r, F.lit(" and more")))
        .when(kind == 4, F.replace(r, F.lit('"reason"'), F.lit('"reasons"')))
        .when(kind == 5, F.replace(r, F.lit('"label": '), F.lit('"label": 1, "old": ')))
        .otherwise(F.lit("sorry"))
    )
    events = table(spark, sf, "events").select("event_id", "event_type", record.alias("r"))
    return events.select("event_id", "event_type", reply.alias("reply"))


RECORD_FIELDS = [
    parsing.Field("reason"),
    parsing.Field("label", "text_or_list", choices=["signup", "view", "click", "purchase"]),
    parsing.Field("confidence", "number", required=False, lo=0.0, hi=1.0),
]

TYPED_SQL = rf"""(WITH b AS (SELECT event_id, event_type, {strip_sql("CASE WHEN regexp_matches(reply, '(?s)```.*?```') THEN regexp_extract(reply, '(?s)```(?:json)?(.*?)```', 1) ELSE reply END")} AS body
      FROM {RECORDS_SQL}),
  j AS (SELECT event_id, event_type, CASE WHEN json_valid(body) THEN json(body) END AS o FROM b),
  v AS (SELECT event_id, event_type, o IS NOT NULL AS whole, o->>'$.reason' AS reason, json_type(o, '$.label') AS kind,
      CASE json_type(o, '$.label') WHEN 'VARCHAR' THEN [o->>'$.label'] WHEN 'ARRAY' THEN CAST(o->'$.label' AS VARCHAR[]) END AS label,
      CAST(o->>'$.confidence' AS DOUBLE) AS confidence FROM j)
  SELECT event_id, event_type, label, reason, confidence, CASE WHEN NOT whole THEN 'not one JSON object' ELSE concat_ws('; ',
      CASE WHEN reason IS NULL THEN 'reason: missing' END,
      CASE WHEN kind NOT IN ('VARCHAR', 'ARRAY') THEN 'label: wrong type'
        WHEN len(list_filter(label, lambda x: x NOT IN ('signup', 'view', 'click', 'purchase'))) > 0 THEN 'label: not a choice' END,
      CASE WHEN confidence > 1 THEN 'confidence: too large' END) END AS errors FROM v)"""


@query(
    "x7_typed_record",
    f"""SELECT event_id, CAST(errors = '' AS INTEGER) AS valid, errors, coalesce(reason, '') AS reason,
      coalesce(array_to_string(label, '|'), '') AS label, coalesce(confidence, -1) AS confidence FROM {TYPED_SQL}""",
)
def _(spark, sf):
    read = parsing.with_typed_record(_records(spark, sf), F.col("reply"), RECORD_FIELDS, "p")
    return read.select(
        "event_id",
        F.col("p.valid").cast("int").alias("valid"),
        F.array_join("p.errors", "; ").alias("errors"),
        F.coalesce("p.reason", F.lit("")).alias("reason"),
        F.coalesce(F.array_join("p.label", "|"), F.lit("")).alias("label"),
        F.coalesce("p.confidence", F.lit(-1.0)).alias("confidence"),
    )


@query(
    "a12_parse_counters",
    f"""SELECT event_type, count(*) AS total, count(*) FILTER (WHERE NOT contains(reply, '</think>')) AS no_close_tag,
      count(*) FILTER (WHERE {AFTER_THINK_SQL} = '') AS no_list, count(*) FILTER (WHERE contains(reply, '[') AND NOT contains(reply, ']')) AS cut_off
    FROM {LISTS_SQL} GROUP BY event_type""",
)
def _(spark, sf):
    reply = F.col("reply")
    return _list_replies(spark, sf).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.contains(reply, F.lit("</think>"))).alias("no_close_tag"),
        F.count_if(parsing.list_after_think(reply) == "").alias("no_list"),
        F.count_if(F.contains(reply, F.lit("[")) & ~F.contains(reply, F.lit("]"))).alias("cut_off"),
    )


@query(
    "e13_valid_rate",
    f"""SELECT event_type, count(*) AS total, count(*) FILTER (WHERE errors = '') AS valid,
      round(count(*) FILTER (WHERE errors = '') / count(*), 6) AS rate FROM {TYPED_SQL} GROUP BY event_type""",
)
def _(spark, sf):
    read = parsing.with_typed_record(_records(spark, sf), F.col("reply"), RECORD_FIELDS, "p").select("event_type", F.col("p.valid").alias("valid"))
    return read.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("valid").alias("valid"),
        F.round(F.count_if("valid") / F.count(F.lit(1)), 6).alias("rate"),
    )
