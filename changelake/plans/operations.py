"""Operational paths: snapshot then stream (T10), heartbeats (T11), live counters (T12),
id / topic pattern matches (F10)."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from changelake.operators.decode import decode, good_events
from changelake.plans import fixtures as fx
from changelake.plans.registry import query
from changelake.plans.sql_fixtures import LATEST_CTE, NEXT_ORDERS_CTE, with_ctes, with_log
from changelake.session import scratch_dir
from changelake.sources.changelog import diff_to_changelog
from changelake.sources.state_store import StateStore
from changelake.streaming.apply import apply_batch

HEARTBEAT_TOPIC = "__heartbeat.cdc"


@query("snapshot_then_stream", with_ctes(NEXT_ORDERS_CTE, body="""
SELECT n.o_orderkey, n.o_orderstatus,
       CAST(CASE WHEN o.o_orderkey IS NULL OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus THEN 2 ELSE 1 END AS BIGINT) AS sourceLsn
FROM nxt n LEFT JOIN orders o ON o.o_orderkey = n.o_orderkey
"""))
def snapshot_then_stream(spark, sf_dir):
    """The snapshot applied at LSN 1, then the change stream (LSN 2) through the same gate;
    a replay of the snapshot afterwards is absorbed by the gate."""
    store = StateStore(spark, scratch_dir(spark, "snap-stream"), buckets=16)
    snap = fx.orders_log(spark, sf_dir)
    apply_batch(store, snap, 0)
    changes = diff_to_changelog(fx.table(spark, sf_dir, "orders"), fx.orders_next(spark, sf_dir), "o_orderkey",
                                lsn=2, table="orders", ts=fx.SNAPSHOT_TS)
    apply_batch(store, changes, 1)
    apply_batch(store, snap, 2)      # overlap: the snapshot delivered again changes nothing
    cur = store.current()
    return cur.select(F.col("doc")["o_orderkey"].cast("bigint").alias("o_orderkey"),
                      F.col("doc")["o_orderstatus"].alias("o_orderstatus"), "sourceLsn")


def heartbeat_log(spark, sf_dir):
    """Events log plus one heartbeat record per minute with traffic (idle sources advance)."""
    log = fx.events_log(spark, sf_dir)
    hb = (log.groupBy(F.date_trunc("minute", "timestamp").alias("timestamp")).agg(F.count("*").alias("_n"))
          .select(F.lit(HEARTBEAT_TOPIC).alias("topic"), F.lit(0).alias("partition"),
                  F.unix_seconds("timestamp").alias("offset"), "timestamp",
                  F.lit(None).cast("string").alias("key"),
                  F.to_json(F.struct(F.unix_millis("timestamp").alias("ts_ms"))).alias("value")))
    return log.unionByName(hb)


@query("heartbeats", with_log("""
SELECT 'heartbeat' AS kind, count(DISTINCT date_trunc('minute', ts)) AS n FROM log
UNION ALL SELECT 'decoded_good', count(*) FROM good
"""))
def heartbeats(spark, sf_dir):
    """Heartbeat records are split off before decode (they never reach the gate) and
    counted as the time spine."""
    log = heartbeat_log(spark, sf_dir)
    is_hb = F.col("topic") == HEARTBEAT_TOPIC
    hb = log.filter(is_hb).agg(F.count("*").alias("n")).withColumn("kind", F.lit("heartbeat"))
    good = good_events(decode(log.filter(~is_hb))).agg(F.count("*").alias("n")).withColumn("kind", F.lit("decoded_good"))
    return hb.unionByName(good).select("kind", "n")


@query("observe_counters", with_log("""
SELECT count(*) AS records, count(*) FILTER (WHERE reason IS NULL) AS good,
       count(*) FILTER (WHERE reason IS NOT NULL AND reason <> 'tombstone') AS rejected,
       count(*) FILTER (WHERE reason = 'tombstone') AS tombstones
FROM log
"""))
def observe_counters(spark, sf_dir):
    """Live progress counters collected by ``observe`` while the decoded log is written
    (one pass; the same works on a streaming query through its progress events)."""
    obs = Observation("decode_counters")
    d = decode(fx.events_log(spark, sf_dir)).observe(
        obs, F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("error_reason").isNull()).alias("good"),
        F.count_if(F.col("error_reason").isNotNull() & (F.col("error_reason") != "tombstone")).alias("rejected"),
        F.count_if(F.col("error_reason") == "tombstone").alias("tombstones"))
    d.write.mode("overwrite").parquet(scratch_dir(spark, "observed"))
    m = obs.get
    return spark.createDataFrame([(m["records"], m["good"], m["rejected"], m["tombstones"])],
                                 "records long, good long, rejected long, tombstones long")


@query("pattern_match", with_log("""
SELECT 'cdc.users' AS topic, count(*) FILTER (WHERE CAST(user_id AS VARCHAR) LIKE '1%') AS ids_starting_1,
       count(*) FILTER (WHERE regexp_matches(CAST(user_id AS VARCHAR), '^[0-9]*7$')) AS ids_ending_7
FROM good
"""))
def pattern_match(spark, sf_dir):
    """prefix and regex matches on ids of a topic pattern."""
    g = good_events(decode(fx.events_log(spark, sf_dir))).filter(F.col("topic").rlike(r"^cdc\."))
    return g.groupBy("topic").agg(F.count_if(F.col("pk").startswith("1")).alias("ids_starting_1"),
                                  F.count_if(F.col("pk").rlike("^[0-9]*7$")).alias("ids_ending_7"))


@query("apply_mapped", with_log(LATEST_CTE + """
SELECT 'users' AS table_name, count(*) AS n, min('_pkId,event_type,props,value') AS field_names,
       CAST(1 AS INTEGER) AS schema_version FROM latest WHERE op <> 'd'
UNION ALL
SELECT 'orders', (SELECT count(*) FROM orders),
       'o_custkey,o_orderdate,o_orderkey,o_orderpriority,o_orderstatus,o_totalprice', CAST(1 AS INTEGER)
"""))
def apply_mapped(spark, sf_dir):
    """Decode -> map by the shipped rules -> gate -> state, over a three-table log in one
    batch job: users renamed by its rule, orders passed through (no ruled field in the
    snapshot images), order_items kept out (lookup-only)."""
    from changelake.rules import DEFAULT_RULES
    store = StateStore(spark, scratch_dir(spark, "mapped-state"), buckets=16)
    apply_batch(store, fx.multi_table_log(spark, sf_dir), 0, rules=DEFAULT_RULES)
    cur = store.current()
    return cur.groupBy(F.col("table").alias("table_name")).agg(
        F.count("*").alias("n"),
        F.min(F.array_join(F.array_sort(F.map_keys("doc")), ",")).alias("field_names"),
        F.min("schemaVersion").alias("schema_version"))
