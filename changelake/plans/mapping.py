"""Mapping-rule and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from changelake.functions import scalar as S
from changelake.operators.decode import decode
from changelake.operators.mapping import apply_rule, cast_errors, embed_json, emit_filter, typed_fields
from changelake.plans import fixtures as fx
from changelake.plans.registry import query
from changelake.plans.sql_fixtures import with_log
from changelake.rules import DEFAULT_RULES, USERS_RULE
from changelake.sources.testlog import EVENTS_RULE

KEYS = "array_join(array_sort(map_keys({})), ',')"


@query("rename_fields", with_log("""
SELECT off, CASE WHEN op <> 'd' THEN '_pkId,amount,eventType,props' END AS after_keys,
       CASE WHEN op IN ('u', 'd') AND prev_eid IS NOT NULL THEN '_pkId,amount,eventType,props' END AS before_keys
FROM good
"""))
def rename_fields(spark, sf_dir):
    """Both images renamed by the table's rule."""
    g = apply_rule(fx.good(spark, sf_dir), {"users": EVENTS_RULE})
    return g.select(F.col("offset").alias("off"), F.expr(KEYS.format("after")).alias("after_keys"),
                    F.expr(KEYS.format("before")).alias("before_keys"))


@query("rename_unknown_map", with_log("""
SELECT off, CASE WHEN op <> 'd' THEN '_pkId,event_type,props,value' END AS after_keys FROM good
"""))
def rename_unknown_map(spark, sf_dir):
    """The shipped users rule on schemaless images: unruled fields pass through."""
    g = apply_rule(fx.good(spark, sf_dir), {"users": USERS_RULE}, images=("after",))
    return g.select(F.col("offset").alias("off"), F.expr(KEYS.format("after")).alias("after_keys"))


@query("route_topics", """
WITH t AS (
  SELECT 'cdc.users' AS topic, (SELECT count(*) FROM events) + (SELECT count(*) FROM events WHERE event_id % 10 = 0) AS n
  UNION ALL SELECT 'cdc.orders', (SELECT count(*) FROM orders)
  UNION ALL SELECT 'cdc.order_items', (SELECT count(*) FROM lineitem))
SELECT topic, 'src.public.' || substr(topic, 5) AS source_topic, topic AS routed,
       'transformed.' || substr(topic, 5) AS transformed, n
FROM t
""")
def route_topics(spark, sf_dir):
    """Connector-side regex router and mapping-stage topic routing, per record."""
    log = fx.multi_table_log(spark, sf_dir)
    src = F.concat(F.lit("src.public."), S.table_of("topic"))
    routed = S.route(src, r"src\.public\.(.*)", "cdc.$1")
    return (log.select("topic", src.alias("source_topic"), routed.alias("routed"),
                       S.target_topic(routed).alias("transformed"))
            .groupBy("topic", "source_topic", "routed", "transformed").agg(F.count("*").alias("n")))


@query("cast_defaults", with_log("""
SELECT off, user_id AS _pkId, event_type AS eventType, value AS amount, props, TRUE AS isActive,
       CAST(0 AS INTEGER) AS n_cast_errors
FROM good WHERE op <> 'd'
"""))
def cast_defaults(spark, sf_dir):
    """Typed projection by the rule, defaults for absent fields, cast failures counted."""
    g = fx.good(spark, sf_dir).filter(F.col("op") != "d")
    return g.select(F.col("offset").alias("off"), *typed_fields("after", EVENTS_RULE),
                    F.size(cast_errors("after", EVENTS_RULE)).alias("n_cast_errors"))


@query("embed_json", with_log("""
SELECT off, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM good WHERE op <> 'd'
"""))
def embed_json_q(spark, sf_dir):
    """P10: a JSON text field embedded as a nested value."""
    g = fx.good(spark, sf_dir).filter(F.col("op") != "d")
    return g.select(F.col("offset").alias("off"),
                    embed_json(F.col("after")["props"], "k bigint")["k"].alias("k"))


@query("iso8601", with_log("""
SELECT off, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS created_at FROM good
"""))
def iso8601_q(spark, sf_dir):
    """ISO-8601 rendering of the source commit time."""
    g = fx.good(spark, sf_dir)
    return g.select(F.col("offset").alias("off"), S.iso8601(F.timestamp_millis("source_ts_ms")).alias("created_at"))


@query("doc_id", with_log("""
SELECT 'users:' || CAST(user_id AS VARCHAR) AS _id, count(*) AS events FROM good GROUP BY user_id
"""))
def doc_id_q(spark, sf_dir):
    """Document ids (idStrategy pk) with their number of events."""
    g = fx.good(spark, sf_dir)
    return g.groupBy(S.doc_id("table", "pk").alias("_id")).agg(F.count("*").alias("events"))


@query("stamp", with_log("""
SELECT off, lsn AS sourceLsn, CAST(1 AS INTEGER) AS schemaVersion,
       CAST(user_id AS VARCHAR) AS id_field FROM good WHERE op <> 'd'
"""))
def stamp_q(spark, sf_dir):
    """sourceLsn and schemaVersion stamped over the row's own fields."""
    g = fx.good(spark, sf_dir).filter(F.col("op") != "d")
    doc = F.map_concat(F.col("after"), F.create_map(F.lit("sourceLsn"), F.col("lsn").cast("string"),
                                                    F.lit("schemaVersion"), F.lit("1")))
    return g.select(F.col("offset").alias("off"), doc["sourceLsn"].cast("bigint").alias("sourceLsn"),
                    doc["schemaVersion"].cast("int").alias("schemaVersion"), doc["id"].alias("id_field"))


@query("classify_error", """
SELECT CASE WHEN contains(m, 'context') THEN 'context' WHEN contains(m, 'connection') THEN 'connection'
            ELSE 'other' END AS reason, count(*) AS n
FROM (SELECT CASE CAST(json_extract(props, '$.k') AS BIGINT) % 3 WHEN 0 THEN 'context deadline exceeded'
                  WHEN 1 THEN 'connection reset by peer' ELSE 'write conflict' END AS m
      FROM events WHERE event_type = 'error')
GROUP BY 1
""")
def classify_error_q(spark, sf_dir):
    """Write errors by classified reason."""
    e = fx.error_log(spark, sf_dir)
    return e.groupBy(S.classify_error("message").alias("reason")).agg(F.count("*").alias("n"))


WAL_SQL = """
WITH p AS (
  SELECT event_id, event_id * 16777216 + user_id AS cur, greatest(event_id - 100, 0) * 16777216 AS rst FROM events),
t AS (
  SELECT event_id, cur - rst AS b,
         hex(cur >> 32) || '/' || hex(cur & 4294967295) AS current_lsn,
         hex(rst >> 32) || '/' || hex(rst & 4294967295) AS restart_lsn FROM p)
SELECT event_id, current_lsn, restart_lsn, CAST(b AS BIGINT) AS retained_bytes,
       CASE WHEN b < 10240 THEN CAST(b AS VARCHAR) || ' bytes'
            WHEN b < 10485760 THEN CAST(CAST(round(b / 1024.0) AS BIGINT) AS VARCHAR) || ' kB'
            WHEN b < 10737418240 THEN CAST(CAST(round(b / 1048576.0) AS BIGINT) AS VARCHAR) || ' MB'
            WHEN b < 10995116277760 THEN CAST(CAST(round(b / 1073741824.0) AS BIGINT) AS VARCHAR) || ' GB'
            ELSE CAST(CAST(round(b / 1099511627776.0) AS BIGINT) AS VARCHAR) || ' TB' END AS retained
FROM t
"""


def wal_positions(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    cur = F.col("event_id") * F.lit(16777216) + F.col("user_id")
    rst = F.greatest(F.col("event_id") - 100, F.lit(0)) * F.lit(16777216)

    def text(p):
        return F.concat(F.hex(F.shiftright(p, 32)), F.lit("/"), F.hex(p.bitwiseAND(F.lit(4294967295))))
    return ev.select("event_id", "user_id", text(cur).alias("current_lsn"), text(rst).alias("restart_lsn"))


@query("wal_distance", WAL_SQL)
def wal_distance(spark, sf_dir):
    """WAL distance between two ``X/Y`` positions and its readable size."""
    w = wal_positions(spark, sf_dir)
    d = S.lsn_diff("current_lsn", "restart_lsn")
    return w.select("event_id", "current_lsn", "restart_lsn", d.cast("bigint").alias("retained_bytes"),
                    S.size_pretty(d).alias("retained"))


@query("build_profile", """
SELECT c_custkey, '{"plan":"' || c_mktsegment || '","batch":' || CAST(c_nationkey AS VARCHAR) || '}' AS profile,
       'seed' || CAST(c_custkey AS VARCHAR) || '@test.dev' AS email
FROM customer
""")
def build_profile(spark, sf_dir):
    """JSON value built from fields (seed-style rows from customers)."""
    c = fx.table(spark, sf_dir, "customer")
    return c.select("c_custkey", S.build_json(plan=F.col("c_mktsegment"), batch=F.col("c_nationkey")).alias("profile"),
                    F.concat(F.lit("seed"), F.col("c_custkey").cast("string"), F.lit("@test.dev")).alias("email"))


@query("emit_filter", """
SELECT 'users' AS table_name, (SELECT count(*) FROM events) + (SELECT count(*) FROM events WHERE event_id % 10 = 0) AS n
UNION ALL SELECT 'orders', (SELECT count(*) FROM orders)
""")
def emit_filter_q(spark, sf_dir):
    """Lookup-only tables are kept out of the written output."""
    log = fx.multi_table_log(spark, sf_dir).withColumn("table", S.table_of("topic"))
    rules = dict(DEFAULT_RULES)
    return emit_filter(log, rules).groupBy(F.col("table").alias("table_name")).agg(F.count("*").alias("n"))


@query("scalar_texts", """
SELECT o_orderkey, 'orders' AS table_name, CAST(floor(epoch(o_orderdate)) AS BIGINT) AS epoch_s,
       '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS row_text
FROM orders
""")
def scalar_texts(spark, sf_dir):
    """The table of a qualified name, a row as JSON text, seconds since the epoch."""
    o = fx.table(spark, sf_dir, "orders").withColumn("src", F.lit("public.orders"))
    return o.select("o_orderkey", S.table_of_source("src").alias("table_name"), S.epoch_seconds(F.col("o_orderdate").cast("timestamp")).alias("epoch_s"),
                    S.row_json("o_orderkey", "o_custkey", "o_orderstatus").alias("row_text"))


@query("oversize_rejects", with_log("""
r AS (SELECT CASE WHEN reason = 'tombstone' THEN reason WHEN off % 61 = 0 THEN 'oversize' ELSE coalesce(reason, 'good') END AS reason FROM log)
SELECT reason, count(*) AS n FROM r GROUP BY reason
"""))
def oversize_rejects(spark, sf_dir):
    """values above a size limit go to the dead letters, all others are decoded as before."""
    log = fx.events_log(spark, sf_dir)
    log = log.withColumn("value", F.when(F.col("offset") % 61 == 0, F.concat("value", F.lit(" " * 4000))).otherwise(F.col("value")))
    return decode(log, max_value_bytes=4000).groupBy(F.coalesce("error_reason", F.lit("good")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
