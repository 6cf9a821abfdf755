"""Rules that shape stored documents, over two versions of a rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.operators import audit
from changelake.operators.decode import decode, good_events
from changelake.operators.mapping import typed_documents, upgrade_documents
from changelake.plans import fixtures as fx
from changelake.plans.registry import query
from changelake.plans.sql_fixtures import NEXT_ORDERS_CTE, with_ctes
from changelake.rules import FieldRule, Rule
from changelake.session import scratch_dir
from changelake.sources.changelog import diff_to_changelog, snapshot_to_changelog
from changelake.sources.state_store import StateStore
from changelake.streaming.apply import apply_batch

FIELDS = {
    "id": FieldRule(type="bigint", target="_pkId"),
    "user_id": FieldRule(type="bigint", target="userId"),
    "status": FieldRule(type="string", enum=("O", "F")),
    "total_cents": FieldRule(type="bigint", target="totalCents"),
    "created_at": FieldRule(type="timestamptz", target="createdAt", format="iso8601"),
    "meta": FieldRule(type="jsonb", embed=True),
    "is_open": FieldRule(type="boolean", target="isOpen", default=True),
}
V1 = Rule(source="public.orders", target="orders", schema_version=1, fields=FIELDS)
#: The second version stores the total under another name and adds a field with a default.
V2 = Rule(source="public.orders", target="orders", schema_version=2, fields=FIELDS | {
    "total_cents": FieldRule(type="bigint", target="total"), "channel": FieldRule(type="string", default="web")})


def rows(orders: DataFrame) -> DataFrame:
    """Rows of an ``orders`` table: a few totals are no numbers, ``meta`` is JSON text."""
    k = F.col("o_orderkey")
    return orders.select(
        k.alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("status"),
        F.when(k % 97 == 5, "n/a").otherwise(F.concat(F.lit("00"), F.floor("o_totalprice"))).alias("total_cents"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.concat(F.lit('{ "prio": "'), "o_orderpriority", F.lit('", "flags": ['), k % 3, F.lit(", 2] }")).alias("meta"))


def _store(spark, sf_dir) -> StateStore:
    """A snapshot applied under the first version, then the changes to the next under the second."""
    now, later = rows(fx.table(spark, sf_dir, "orders")), rows(fx.orders_next(spark, sf_dir))
    store = StateStore(spark, scratch_dir(spark, "typed"), buckets=8)
    apply_batch(store, snapshot_to_changelog(now, "orders", "id", lsn=1, ts=fx.SNAPSHOT_TS), 0, {"orders": V1}, writer="w", shape=True)
    apply_batch(store, diff_to_changelog(now, later, "id", lsn=2, table="orders", ts=fx.SNAPSHOT_TS), 1, {"orders": V2}, writer="w", shape=True)
    return store


#: ``n``: rows of the next snapshot with the version they are written under.
VERSIONS_CTE = """
n AS (SELECT nxt.*, CASE WHEN o.o_orderkey IS NULL OR o.o_orderstatus <> nxt.o_orderstatus THEN 2 ELSE 1 END AS v
      FROM nxt LEFT JOIN orders o ON o.o_orderkey = nxt.o_orderkey)
"""
STORED = "o_orderkey % 97 <> 5 AND o_orderstatus IN ('O', 'F')"


@query("apply_typed", with_ctes(NEXT_ORDERS_CTE, VERSIONS_CTE, body=f"""
SELECT 'orders:' || o_orderkey AS _id, CAST(v AS INTEGER) AS "schemaVersion", o_orderkey AS "_pkId", o_custkey AS "userId",
       o_orderstatus AS status, CAST(floor(o_totalprice) AS BIGINT) AS total,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS created_text, o_orderpriority AS prio,
       '{{"flags":[' || (o_orderkey % 3) || ',2],"prio":"' || o_orderpriority || '"}}' AS meta_text,
       TRUE AS "isOpen", 'web' AS channel
FROM n WHERE {STORED}
"""))
def apply_typed(spark, sf_dir):
    """Documents stored under two versions of a rule, read as typed columns of the
    newest: numbers, times as ISO text, embedded JSON, defaults, a renamed and an added field."""
    docs = upgrade_documents(_store(spark, sf_dir).current(), {"orders": [V1, V2]})
    text = docs.select(F.col("_id").alias("i"), F.col("doc")["createdAt"].alias("created_text"), F.col("doc")["meta"].alias("meta_text"))
    t = typed_documents(docs, V2).join(text, F.col("_id") == F.col("i"))
    return t.select("_id", "schemaVersion", "_pkId", "userId", "status", "total", "created_text",
                    F.variant_get("meta", "$.prio", "string").alias("prio"), "meta_text", "isOpen", "channel")


@query("apply_typed_rejects", with_ctes(NEXT_ORDERS_CTE, VERSIONS_CTE, body="""
SELECT batch, reason, count(*) AS n FROM (
  SELECT 0 AS batch, CASE WHEN o_orderkey % 97 = 5 THEN 'bad_cast' WHEN o_orderstatus NOT IN ('O', 'F') THEN 'bad_enum' END AS reason FROM orders
  UNION ALL SELECT 1, CASE WHEN o_orderkey % 97 = 5 THEN 'bad_cast' WHEN o_orderstatus NOT IN ('O', 'F') THEN 'bad_enum' END FROM n WHERE v = 2)
WHERE reason IS NOT NULL GROUP BY ALL
"""))
def apply_typed_rejects(spark, sf_dir):
    """What the rules reject in each batch, from the dead letters."""
    dlq = _store(spark, sf_dir).read_side("dlq")
    return dlq.groupBy(F.col("batch").cast("int").alias("batch"), F.col("error_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("schema_versions", with_ctes(NEXT_ORDERS_CTE, VERSIONS_CTE, body=f"""
SELECT CAST(v AS INTEGER) AS "schemaVersion", count(*) AS n FROM n WHERE {STORED} GROUP BY v
"""))
def schema_versions(spark, sf_dir):
    """Documents by the version of the rule that they were written under."""
    return _store(spark, sf_dir).current().groupBy("schemaVersion").agg(F.count(F.lit(1)).alias("n"))


@query("rule_audit", """
SELECT 'orders' AS table_name, * FROM (
  SELECT 'id_type' AS check_name, 0 AS violations UNION ALL SELECT 'id_not_null', 0 UNION ALL SELECT 'user_id_type', 0
  UNION ALL SELECT 'status_enum', count(*) FILTER (WHERE o_orderstatus NOT IN ('O', 'F')) FROM orders
  UNION ALL SELECT 'total_cents_type', count(*) FILTER (WHERE o_orderkey % 97 = 5) FROM orders
  UNION ALL SELECT 'total_cents_min', count(*) FILTER (WHERE o_orderkey % 97 <> 5 AND floor(o_totalprice) < 100000) FROM orders
  UNION ALL SELECT 'created_at_type', 0 UNION ALL SELECT 'meta_type', 0
  UNION ALL SELECT 'is_open_type', 0 UNION ALL SELECT 'is_open_not_null', count(*) FROM orders)
""")
def rule_audit(spark, sf_dir):
    """F8: the checks that a rule implies (types, enum) and constraints (not null, minimum), in one pass."""
    ev = good_events(decode(snapshot_to_changelog(rows(fx.table(spark, sf_dir, "orders")), "orders", "id", lsn=1, ts=fx.SNAPSHOT_TS)))
    return audit.constraint_counts(ev, "orders", audit.rule_checks(V1, "after", required=("id", "is_open"), at_least={"total_cents": 100000}))
