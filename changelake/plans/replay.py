"""The mapping stage as a stream, bounded replay, keys of several columns, retention by row."""

from __future__ import annotations

from pyspark.sql import functions as F

from changelake.operators.decode import decode, good_events
from changelake.operators.gate import current_state
from changelake.operators.retention import retain
from changelake.plans import fixtures as fx
from changelake.plans.embedding import ITEMS_CTE, item_rows
from changelake.plans.registry import query
from changelake.plans.sql_fixtures import with_ctes, with_log
from changelake.plans.streams import log_files
from changelake.session import scratch_dir
from changelake.sources.changelog import diff_to_changelog, read_changelog, snapshot_to_changelog
from changelake.sources.testlog import EVENTS_RULE
from changelake.streaming.mapped import stream_map


@query("stream_mapped", with_log("""
SELECT off, CAST(user_id AS VARCHAR) AS pk, op, lsn, CASE WHEN op <> 'd' THEN event_type END AS "eventType",
       CASE WHEN op <> 'd' THEN value END AS amount, CASE WHEN op <> 'd' THEN props END AS props FROM good
"""))
def stream_mapped(spark, sf_dir):
    """The log mapped by a stream in several batches, published per table, decoded again: keys,
    positions and renamed images of every record."""
    out = scratch_dir(spark, "mapped")
    q = stream_map(spark, log_files(spark, sf_dir), out, scratch_dir(spark, "mapped-ck"), {"users": EVENTS_RULE}, max_files_per_trigger=2)
    q.awaitTermination()
    a = F.col("after")
    return good_events(decode(read_changelog(spark, out, tables=["users"]))).select(
        F.col("offset").alias("off"), "pk", "op", "lsn", a["eventType"].alias("eventType"),
        a["amount"].cast("double").alias("amount"), a["props"].alias("props"))


@query("replay_ranges", with_log("""
SELECT part AS partition, off AS "offset", reason IS NULL AS good FROM log
WHERE part < 4 AND off >= part * 100 AND off < part * 100 + 2000 AND (part <> 2 OR off < 250)
"""))
def replay_ranges(spark, sf_dir):
    """A bounded read of a log with a range of offsets for each partition; other partitions are not read."""
    ranges = {("cdc.users", p): (p * 100, 250 if p == 2 else p * 100 + 2000) for p in range(4)}
    log = read_changelog(spark, log_files(spark, sf_dir), offset_range=ranges)
    return decode(log).select("partition", "offset", F.col("error_reason").isNull().alias("good"))


LINES_CTE = ITEMS_CTE + """,
lines AS (SELECT order_id, id % 10000 AS line, sku, qty FROM items),
lines_next AS (SELECT order_id, line, sku, CASE WHEN line % 7 = 3 THEN qty + 10 ELSE qty END AS qty FROM lines WHERE (order_id + line) % 11 <> 0)
"""


@query("composite_keys", with_ctes(LINES_CTE, body="""
SELECT 'order_items:' || n.order_id || '|' || n.line AS _id, n.sku, n.qty, CASE WHEN n.qty <> l.qty THEN 2 ELSE 1 END::BIGINT AS "sourceLsn"
FROM lines_next n JOIN lines l USING (order_id, line)
"""))
def composite_keys(spark, sf_dir):
    """rows keyed by order and line through snapshot, diff, decode and gate."""
    items = item_rows(fx.table(spark, sf_dir, "lineitem"))
    lines = items.select("order_id", (F.col("id") % 10000).alias("line"), "sku", "qty")
    later = lines.where("(order_id + line) % 11 <> 0").withColumn("qty", F.when(F.col("line") % 7 == 3, F.col("qty") + 10).otherwise(F.col("qty")))
    keys = ["order_id", "line"]
    log = snapshot_to_changelog(lines, "order_items", keys, lsn=1, ts=fx.SNAPSHOT_TS).unionByName(
        diff_to_changelog(lines, later, keys, lsn=2, table="order_items", ts=fx.SNAPSHOT_TS))
    state = current_state(good_events(decode(log, keys={"order_items": keys})))
    return state.select("_id", F.col("doc")["sku"].alias("sku"), F.col("doc")["qty"].cast("bigint").alias("qty"), "sourceLsn")


@query("retain_rows", with_log("""
t AS (SELECT 'cdc.users' AS topic, part, off, ts, user_id, event_id, reason FROM log
      UNION ALL SELECT 'dlq.users', part, off, ts, user_id, event_id, reason FROM log WHERE reason IS NOT NULL),
k AS (SELECT *, CASE WHEN event_id % 83 = 0 THEN 'none' ELSE CAST(user_id AS VARCHAR) END AS key FROM t),
n AS (SELECT *, off = max(off) OVER (PARTITION BY topic, part, key) AS newest FROM k), h AS (SELECT max(ts) AS mx FROM log)
SELECT topic, part AS partition, off AS "offset" FROM n, h
WHERE topic = 'dlq.users' OR ts >= mx - INTERVAL 7 DAY OR (newest AND reason IS DISTINCT FROM 'tombstone')
"""))
def retain_rows(spark, sf_dir):
    """The records that outlive retention: 7 days of the change log and the newest record of every
    key (a compacted topic), all dead letters."""
    dec = fx.decoded(spark, sf_dir)
    bad = F.col("error_reason").isNotNull()
    topics = F.when(bad, F.array(F.lit("cdc.users"), F.lit("dlq.users"))).otherwise(F.array(F.lit("cdc.users")))
    log = dec.select(F.explode(topics).alias("topic"), "partition", "offset", "timestamp", "key", "value")
    newest = F.lit(fx.table(spark, sf_dir, "events").agg(F.max("ts").cast("timestamp")).first()[0])
    return retain(log, {"cdc": 7, "dlq": None}, newest, compacted=("cdc.users",)).select("topic", "partition", "offset")
