"""Limit, sample and topic queries; change-log sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from changelake.functions.scalar import target_topic
from changelake.operators import gate
from changelake.operators import ordering as O
from changelake.operators.decode import decode, good_events
from changelake.operators.mapping import apply_rule, map_changelog
from changelake.plans import fixtures as fx
from changelake.plans.registry import query
from changelake.plans.sql_fixtures import LATEST_CTE, with_log
from changelake.rules import FieldRule, Rule
from changelake.session import scratch_dir
from changelake.sources.changelog import only_tables, read_changelog, write_changelog
from changelake.sources.testlog import EVENTS_RULE


@query("peek", with_log("""
r AS (SELECT 'cdc.users' AS topic, part, off FROM log UNION ALL SELECT 'cdc.orders', NULL, o_orderkey FROM orders)
SELECT topic, part, off FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY off, part) AS rn FROM r) WHERE rn <= 5
"""))
def peek_q(spark, sf_dir):
    """L1: the first five records of each topic."""
    log = fx.events_log(spark, sf_dir).unionByName(fx.orders_log(spark, sf_dir))
    p = O.peek(log, 5, ["topic"], ["offset", "partition"])
    return p.select("topic", F.when(F.col("topic") == "cdc.users", F.col("partition")).alias("part"),
                    F.col("offset").alias("off"))


@query("first_row", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 1")
def first_row_q(spark, sf_dir):
    """L2: the smallest-key row."""
    return O.first_row(fx.table(spark, sf_dir, "orders"), "o_orderkey")


@query("sample_rows", """
SELECT * FROM orders WHERE CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 5
ORDER BY o_orderkey LIMIT 100
""")
def sample_rows_q(spark, sf_dir):
    """L3: 5 % key-hash sample, then the first 100 by key."""
    o = fx.table(spark, sf_dir, "orders")
    return O.hash_sample(o, "o_orderkey", 5).orderBy("o_orderkey").limit(100)


@query("pick_row", """
SELECT o_orderkey, o_orderstatus FROM (
  SELECT o_orderkey, o_orderstatus, 0 AS prio FROM orders
  WHERE CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 5
  UNION ALL SELECT * FROM (SELECT o_orderkey, o_orderstatus, 1 FROM orders ORDER BY o_orderkey LIMIT 1))
ORDER BY prio, o_orderkey LIMIT 1
""")
def pick_row_q(spark, sf_dir):
    """L2/L3: the row an update would pick — from a 5 % sample, else the smallest key."""
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return O.pick_row(o, "o_orderkey", 5)


@query("sample_rows_random")
def sample_rows_random(spark, sf_dir):
    """L3: Bernoulli 5 % sample (random; row count only)."""
    return O.sample_rows(fx.table(spark, sf_dir, "orders"), 0.05)


TOPIC_COUNTS_SQL = """
SELECT 'cdc.users' AS topic, (SELECT count(*) FROM events) + (SELECT count(*) FROM events WHERE event_id % 10 = 0) AS n
UNION ALL SELECT 'cdc.orders', (SELECT count(*) FROM orders)
UNION ALL SELECT 'cdc.order_items', (SELECT count(*) FROM lineitem)
"""


@query("topics", TOPIC_COUNTS_SQL)
def topics_q(spark, sf_dir):
    """Topics of the multi-table log, sorted, with record counts."""
    return O.topics(fx.multi_table_log(spark, sf_dir))


@query("only_tables", """
SELECT 'cdc.users' AS topic, (SELECT count(*) FROM events) + (SELECT count(*) FROM events WHERE event_id % 10 = 0) AS n
UNION ALL SELECT 'cdc.orders', (SELECT count(*) FROM orders)
""")
def only_tables_q(spark, sf_dir):
    """The include-list keeps users and orders, drops order_items."""
    return only_tables(fx.multi_table_log(spark, sf_dir), ["users", "orders"]).groupBy("topic").agg(
        F.count("*").alias("n"))


@query("read_changelog", with_log("""
SELECT op, count(*) AS n FROM good GROUP BY op
"""))
def read_changelog_q(spark, sf_dir):
    """A change log written as files, read back bounded by topic pattern, decoded."""
    path = scratch_dir(spark, "changelog")
    fx.multi_table_log(spark, sf_dir).write.mode("overwrite").parquet(path)
    log = read_changelog(spark, path, pattern=r"cdc\.users")
    return good_events(decode(log)).groupBy("op").agg(F.count("*").alias("n"))


def _mapped_images_sql():
    """Renamed after images as canonical text of typed JSON fields."""
    return """concat('id=', user_id, ';eventType="', event_type, '";amount=', CAST(value AS VARCHAR), ';props=', to_json(props))"""


@query("map_changelog", with_log(f"""
SELECT off, part, 'transformed.users' AS topic, '{{"schema":{{}},"payload":{{"id":' || user_id || '}}}}' AS key,
       op, lsn, CASE WHEN op <> 'd' THEN {_mapped_images_sql()} END AS after
FROM good
"""))
def map_changelog_q(spark, sf_dir):
    """The mapping stage's log, written per table and read back; per good record its
    place, key, operation, LSN and the renamed image with its JSON types."""
    path = scratch_dir(spark, "mapped")
    write_changelog(map_changelog(fx.events_log(spark, sf_dir), {"users": MAP_RULE}), path)
    back = spark.read.parquet(path)
    good = decode(back).filter("error_reason is null").select("offset", "partition")
    v = F.parse_json("value")

    def field(name, kind):
        return F.variant_get(v, f"$.payload.{name}", kind)

    text = F.concat(F.lit("id="), field("after.id", "bigint"), F.lit(";eventType="), F.to_json(field("after.eventType", "variant")),
                    F.lit(";amount="), field("after.amount", "double").cast("string"), F.lit(";props="), F.to_json(field("after.props", "variant")))
    return back.join(good, ["offset", "partition"]).select(
        F.col("offset").alias("off"), F.col("partition").alias("part"), "topic", "key", field("op", "string").alias("op"),
        field("source.lsn", "bigint").alias("lsn"), F.when(field("op", "string") != "d", text).alias("after"))


@query("map_changelog_bytes", with_log("""
SELECT reason, count(*) AS n, count(*) AS same FROM log WHERE reason IN ('tombstone', 'bad_json') GROUP BY reason
UNION ALL SELECT 'unruled', count(*), count(*) FROM orders
"""))
def map_changelog_bytes(spark, sf_dir):
    """Tombstones, values that are no envelope and records of unruled tables keep their bytes."""
    keys = ["topic", "partition", "offset"]
    log = fx.events_log(spark, sf_dir).unionByName(fx.orders_log(spark, sf_dir))
    mapped = map_changelog(log, {"users": MAP_RULE}).select(
        F.concat(F.lit("cdc."), F.substring_index("topic", ".", -1)).alias("topic"), "partition", "offset",
        F.struct("key", "value").alias("after"))
    before = decode(log).filter("error_reason in ('tombstone', 'bad_json') or table = 'orders'") \
        .select(*keys, F.coalesce("error_reason", F.lit("unruled")).alias("reason"), F.struct("key", "value").alias("before"))
    return before.join(mapped, keys).groupBy("reason").agg(
        F.count("*").alias("n"), F.count_if(F.col("before").eqNullSafe(F.col("after"))).alias("same"))


@query("map_then_apply", with_log(LATEST_CTE + """
SELECT 'users:' || CAST(user_id AS VARCHAR) AS _id, event_type AS "eventType", CAST(value AS VARCHAR) AS amount, lsn AS sourceLsn
FROM latest WHERE op <> 'd'
"""))
def map_then_apply(spark, sf_dir):
    """P6 -> F1 -> G7: the mapped log decoded and gated."""
    docs = gate.current_state(good_events(decode(map_changelog(fx.events_log(spark, sf_dir), {"users": MAP_RULE}))))
    return docs.select("_id", F.col("doc")["eventType"].alias("eventType"), F.col("doc")["amount"].alias("amount"), "sourceLsn")


#: The events rule without a new name for the key field.
MAP_RULE = Rule(source="public.users", target="users", fields={
    "event_type": FieldRule(target="eventType"), "value": FieldRule(type="double", target="amount")})


@query("write_changelog", with_log("""
SELECT 'users' AS table_name, 'transformed.users' AS topic, count(*) AS n, count(DISTINCT user_id) AS keys FROM good
"""))
def write_changelog_q(spark, sf_dir):
    """The mapped log published per table (directory per table), read back."""
    g = good_events(decode(fx.events_log(spark, sf_dir)))
    mapped = apply_rule(g, {"users": EVENTS_RULE}).select(
        target_topic("topic").alias("topic"), "partition", "offset", "timestamp",
        F.to_json(F.struct(F.col("pk").alias("id"))).alias("key"), F.to_json("after").alias("value"), "pk")
    path = scratch_dir(spark, "mapped")
    write_changelog(mapped, path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("table").alias("table_name"), "topic").agg(
        F.count("*").alias("n"), F.count_distinct("pk").alias("keys"))
