"""Snapshots, capture by diff, joins, history and per-key audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from changelake.operators import audit, joins
from changelake.operators.decode import decode, good_events
from changelake.operators.history import history
from changelake.plans import fixtures as fx
from changelake.plans.embedding import ITEMS_CTE, item_rows, order_rows
from changelake.plans.registry import query
from changelake.plans.sql_fixtures import NEXT_ORDERS_CTE, with_ctes, with_log
from changelake.sources.changelog import snapshot_to_changelog


@query("snapshot_to_changelog", """
SELECT 'orders' AS table_name, CAST(o_orderkey AS VARCHAR) AS pk, CAST(1 AS BIGINT) AS lsn, 'r' AS op,
       o_orderstatus AS status FROM orders
""")
def snapshot_q(spark, sf_dir):
    """S3: a whole table as snapshot-read events, decoded back."""
    ev = good_events(decode(fx.orders_log(spark, sf_dir)))
    return ev.select(F.col("table").alias("table_name"), "pk", "lsn", "op",
                     F.col("after")["o_orderstatus"].alias("status"))


@query("diff_to_changelog", with_ctes(NEXT_ORDERS_CTE, body="""
SELECT CAST(coalesce(o.o_orderkey, n.o_orderkey) AS VARCHAR) AS pk,
       CASE WHEN o.o_orderkey IS NULL THEN 'c' WHEN n.o_orderkey IS NULL THEN 'd' ELSE 'u' END AS op,
       o.o_orderstatus AS old_status, n.o_orderstatus AS new_status
FROM orders o FULL OUTER JOIN nxt n ON o.o_orderkey = n.o_orderkey
WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus
   OR o.o_custkey IS DISTINCT FROM n.o_custkey OR o.o_totalprice IS DISTINCT FROM n.o_totalprice
   OR o.o_orderdate IS DISTINCT FROM n.o_orderdate OR o.o_orderpriority IS DISTINCT FROM n.o_orderpriority
"""))
def diff_q(spark, sf_dir):
    """Two table versions -> create / update / delete events with before and after images."""
    ev = fx.orders_diff_events(spark, sf_dir)
    return ev.select("pk", "op", F.col("before")["o_orderstatus"].alias("old_status"),
                     F.col("after")["o_orderstatus"].alias("new_status"))


ITEM_TEXT = "concat_ws(':', CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), " \
            "CAST(l_suppkey AS VARCHAR), CAST(CAST(l_quantity AS BIGINT) AS VARCHAR))"
ITEM_FIELDS = ["l_linenumber", "l_partkey", "l_suppkey", "qty"]


def _items(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem").withColumn("qty", F.col("l_quantity").cast("bigint"))


def _embedded_text(df):
    txt = F.array_join(F.transform("items", lambda x: F.concat_ws(
        ":", *[x[c].cast("string") for c in ITEM_FIELDS])), ",")
    return df.select("o_orderkey", F.size("items").cast("bigint").alias("n_items"), txt.alias("items"))


EMBED_SQL_TAIL = f"""
SELECT p.o_orderkey, coalesce(c.n, 0) AS n_items, coalesce(c.items, '') AS items
FROM parents p LEFT JOIN (
  SELECT l_orderkey, count(*) AS n,
         string_agg({ITEM_TEXT}, ',' ORDER BY l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT)) AS items
  FROM lineitem GROUP BY l_orderkey) c ON c.l_orderkey = p.o_orderkey
"""


@query("embed_orders", "WITH parents AS (SELECT * FROM orders)" + EMBED_SQL_TAIL)
def embed_orders(spark, sf_dir):
    """Line items embedded in each order as a sorted array (empty when none)."""
    e = joins.embed(fx.table(spark, sf_dir, "orders"), _items(spark, sf_dir), "l_orderkey", "o_orderkey",
                    "items", ITEM_FIELDS)
    return _embedded_text(e)


PAGED_SQL = f"""
WITH c AS (SELECT l_orderkey, {ITEM_TEXT} AS t, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS qty,
                  count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem),
p AS (SELECT *, CAST(('0x' || substr(md5(t), 1, 8)) AS BIGINT) % CAST(ceil(n / 2.0) AS BIGINT) AS page FROM c),
g AS (SELECT l_orderkey, page, count(*) AS n_items,
             string_agg(t, ',' ORDER BY l_linenumber, l_partkey, l_suppkey, qty) AS items FROM p GROUP BY 1, 2)
SELECT o.o_orderkey, coalesce(g.page, 0) AS page, coalesce(g.n_items, 0) AS n_items, coalesce(g.items, '') AS items
FROM orders o LEFT JOIN g ON g.l_orderkey = o.o_orderkey
"""


@query("embed_orders_paged", PAGED_SQL)
def embed_orders_paged(spark, sf_dir):
    """J1, paged: line items spread over pages of about two per order (hash of the item)."""
    e = joins.embed_paged(fx.table(spark, sf_dir, "orders"), _items(spark, sf_dir), "l_orderkey", "o_orderkey",
                          "items", ITEM_FIELDS, page_size=2)
    txt = F.array_join(F.transform("items", lambda x: F.concat_ws(":", *[x[c].cast("string") for c in ITEM_FIELDS])), ",")
    return e.select("o_orderkey", "page", F.size("items").cast("bigint").alias("n_items"), txt.alias("items"))


@query("embed_incremental", with_ctes(NEXT_ORDERS_CTE, """
touched AS (
  SELECT CAST(pk AS BIGINT) AS k FROM (
    SELECT coalesce(o.o_orderkey, n.o_orderkey) AS pk FROM orders o FULL OUTER JOIN nxt n ON o.o_orderkey = n.o_orderkey
    WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus)
  UNION SELECT l_orderkey FROM lineitem WHERE l_partkey % 17 = 0)""",
                                         "parents AS (SELECT * FROM nxt WHERE o_orderkey IN (SELECT k FROM touched))",
                                         body=EMBED_SQL_TAIL))
def embed_incremental(spark, sf_dir):
    """Only parents whose own row changed or that have a changed child are re-embedded."""
    changed_parents = fx.orders_diff_events(spark, sf_dir).select(F.col("pk").cast("bigint"))
    items = _items(spark, sf_dir)
    touched = joins.touched_parents(changed_parents, items.filter(F.col("l_partkey") % 17 == 0), "l_orderkey")
    e = joins.embed_incremental(fx.orders_next(spark, sf_dir), items, touched, "l_orderkey", "o_orderkey",
                                "items", ITEM_FIELDS)
    return _embedded_text(e)


@query("orphans", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 101 <> 0)
""")
def orphans_q(spark, sf_dir):
    """Line items whose order is gone (orders with key % 101 = 0 removed)."""
    parents = fx.table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 101 != 0)
    o = joins.orphans(fx.table(spark, sf_dir, "lineitem"), parents, "l_orderkey", "o_orderkey")
    return o.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("cascade_deletes", with_ctes(NEXT_ORDERS_CTE, body="""
SELECT l_orderkey, l_linenumber, l_partkey, 'd' AS op FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders EXCEPT SELECT o_orderkey FROM nxt)
"""))
def cascade_q(spark, sf_dir):
    """Deletes of orders expanded to deletes of their line items."""
    dels = fx.orders_diff_events(spark, sf_dir).filter(F.col("op") == "d").select(F.col("pk").cast("bigint").alias("pk"))
    c = joins.cascade_deletes(dels, fx.table(spark, sf_dir, "lineitem"), "l_orderkey")
    return c.select("l_orderkey", "l_linenumber", "l_partkey", "op")


@query("cascade_levels", with_ctes(ITEMS_CTE, """
d AS (SELECT c_custkey, c_custkey + 1000 AS lsn FROM customer WHERE c_custkey % 10 = 3),
o AS (SELECT o_orderkey, o_custkey, o_orderstatus, lsn FROM orders JOIN d ON o_custkey = c_custkey),
i AS (SELECT items.*, lsn FROM items JOIN o ON order_id = o_orderkey)
""", body="""
SELECT 'orders' AS table_name, CAST(o_orderkey AS VARCHAR) AS pk, lsn, 'd' AS op, 1 AS depth,
       CAST(o_custkey AS VARCHAR) AS parent_pk, o_orderstatus AS detail FROM o
UNION ALL SELECT 'order_items', CAST(id AS VARCHAR), lsn, 'd', 2, CAST(order_id AS VARCHAR), sku FROM i
"""))
def cascade_levels(spark, sf_dir):
    """Deleted users take their orders along, and these their items, as delete events with key,
    LSN and before image."""
    users = fx.table(spark, sf_dir, "customer").where("c_custkey % 10 = 3")
    deletes = users.select(F.lit("users").alias("table"), F.col("c_custkey").cast("string").alias("pk"),
                           (F.col("c_custkey") + 1000).alias("lsn"))
    c = joins.cascade(deletes, {"orders": order_rows(fx.table(spark, sf_dir, "orders")),
                                "order_items": item_rows(fx.table(spark, sf_dir, "lineitem"))},
                      [joins.ForeignKey("orders", "user_id", "users"), joins.ForeignKey("order_items", "order_id", "orders")])
    b = F.col("before")
    return c.select(F.col("table").alias("table_name"), "pk", "lsn", "op", "depth",
                    F.coalesce(b["user_id"], b["order_id"]).alias("parent_pk"), F.coalesce(b["status"], b["sku"]).alias("detail"))


@query("insert_absent", """
WITH t AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 2 = 0),
n AS (SELECT c_custkey, 'New ' || c_name AS c_name, c_acctbal FROM customer
      UNION ALL SELECT c_custkey, 'Dup ' || c_name, c_acctbal + 1 FROM customer WHERE c_custkey % 3 = 0)
SELECT * FROM t
UNION ALL
SELECT c_custkey, c_name, c_acctbal FROM (
  SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY c_acctbal) AS rn FROM n) x
WHERE rn = 1 AND c_custkey NOT IN (SELECT c_custkey FROM t)
""")
def insert_absent_q(spark, sf_dir):
    """Insert-if-absent by key; within the new rows the first per key is taken."""
    c = fx.table(spark, sf_dir, "customer")
    t = c.filter(F.col("c_custkey") % 2 == 0).select("c_custkey", "c_name", "c_acctbal")
    n = c.select("c_custkey", F.concat(F.lit("New "), "c_name").alias("c_name"), "c_acctbal").unionByName(
        c.filter(F.col("c_custkey") % 3 == 0).select("c_custkey", F.concat(F.lit("Dup "), "c_name").alias("c_name"),
                                                     (F.col("c_acctbal") + 1).alias("c_acctbal")))
    return joins.insert_absent(t, n, "c_custkey", order_col="c_acctbal")


@query("upsert_by_key", """
WITH t AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer),
n AS (SELECT c_custkey + 1000000000 AS c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE c_name || '-new' END AS c_name,
             c_nationkey + 1 AS c_nationkey, c_acctbal + 1 AS c_acctbal, 'UPDATED' AS c_mktsegment FROM customer)
SELECT CASE WHEN t.c_name IS NOT NULL THEN t.c_custkey ELSE n.c_custkey END AS c_custkey,
       coalesce(t.c_name, n.c_name) AS c_name,
       CASE WHEN t.c_name IS NOT NULL THEN t.c_nationkey ELSE n.c_nationkey END AS c_nationkey,
       CASE WHEN n.c_name IS NOT NULL THEN n.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       CASE WHEN n.c_name IS NOT NULL THEN n.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment
FROM t FULL OUTER JOIN n ON t.c_name = n.c_name
""")
def upsert_by_key_q(spark, sf_dir):
    """Natural-key upsert of all customers, a third under their old names: matched rows take
    the new set-columns and keep their id."""
    t = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    name = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise(F.concat("c_name", F.lit("-new")))
    n = t.select((F.col("c_custkey") + 1000000000).alias("c_custkey"), name.alias("c_name"),
                 (F.col("c_nationkey") + 1).alias("c_nationkey"), (F.col("c_acctbal") + 1).alias("c_acctbal"),
                 F.lit("UPDATED").alias("c_mktsegment"))
    return joins.upsert_by(t, n, "c_name", ["c_acctbal", "c_mktsegment"], order_col="c_custkey")


@query("deletion_audit", with_ctes(NEXT_ORDERS_CTE, body="""
SELECT o_orderkey FROM orders EXCEPT SELECT o_orderkey FROM nxt
"""))
def deletion_audit_q(spark, sf_dir):
    """Keys deleted upstream that a target (a stale copy of the whole table) still has."""
    last = fx.orders_diff_events(spark, sf_dir).select(F.col("pk").cast("bigint").alias("o_orderkey"), "op")
    return joins.deletion_audit(last, fx.table(spark, sf_dir, "orders"), "o_orderkey").select("o_orderkey")


@query("trace_row", with_ctes(NEXT_ORDERS_CTE, body="""
SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, o.o_orderstatus AS src_o_orderstatus,
       n.o_orderstatus AS tgt_o_orderstatus, o.o_orderkey IS NOT NULL AS in_src, n.o_orderkey IS NOT NULL AS in_tgt
FROM (SELECT * FROM orders WHERE o_orderkey % 13 = 0) o
FULL OUTER JOIN (SELECT * FROM nxt WHERE o_orderkey % 13 = 0 AND o_orderkey IN (SELECT o_orderkey FROM orders)) n
  ON o.o_orderkey = n.o_orderkey
"""))
def trace_row_q(spark, sf_dir):
    """the keys whose status was changed, source and target side by side."""
    src = fx.table(spark, sf_dir, "orders")
    keys = src.filter(F.col("o_orderkey") % 13 == 0).select("o_orderkey")
    t = joins.trace_rows(src.select("o_orderkey", "o_orderstatus"),
                         fx.orders_next(spark, sf_dir).select("o_orderkey", "o_orderstatus"), "o_orderkey", keys)
    return t.select("o_orderkey", "src_o_orderstatus", "tgt_o_orderstatus", "in_src", "in_tgt")


@query("history", with_log("""
f AS (SELECT user_id, lsn, op, row_number() OVER (PARTITION BY user_id, lsn ORDER BY part, off) AS rn FROM good)
SELECT CAST(user_id AS VARCHAR) AS pk, lsn AS valid_from,
       lead(lsn) OVER (PARTITION BY user_id ORDER BY lsn) AS valid_to, op,
       lead(lsn) OVER (PARTITION BY user_id ORDER BY lsn) IS NULL AS is_current
FROM f WHERE rn = 1
"""))
def history_q(spark, sf_dir):
    """Version intervals per key (valid_from / valid_to LSN)."""
    h = history(fx.good(spark, sf_dir))
    return h.select("pk", "valid_from", "valid_to", "op", "is_current")


@query("changed_fields", with_log("""
SELECT g.off,
       CASE WHEN g.prev_eid IS NULL THEN NULL ELSE concat_ws(',',
            CASE WHEN p.event_type IS DISTINCT FROM g.event_type THEN 'event_type' END,
            CASE WHEN p.props IS DISTINCT FROM g.props THEN 'props' END,
            CASE WHEN p.value IS DISTINCT FROM g.value THEN 'value' END) END AS changed
FROM good g LEFT JOIN events p ON p.event_id = g.prev_eid
WHERE g.op = 'u'
"""))
def changed_fields_q(spark, sf_dir):
    """Fields an update changed (before vs after image)."""
    g = fx.good(spark, sf_dir).filter(F.col("op") == "u")
    return g.select(F.col("offset").alias("off"),
                    F.array_join(audit.changed_fields("before", "after"), ",").alias("changed"))


@query("chain_violations", with_log("""
d AS (
  SELECT g.*, lag(CASE WHEN g.op <> 'd' THEN g.event_id END) OVER (PARTITION BY g.user_id ORDER BY g.off) AS prev_after_eid,
         lag(g.event_id) OVER (PARTITION BY g.user_id ORDER BY g.off) AS prev_row
  FROM good g)
SELECT d.off, CAST(d.user_id AS VARCHAR) AS pk
FROM d LEFT JOIN events b ON b.event_id = d.prev_eid LEFT JOIN events a ON a.event_id = d.prev_after_eid
WHERE d.op IN ('u', 'd') AND d.prev_eid IS NOT NULL
  AND (a.event_id IS NULL OR a.event_type IS DISTINCT FROM b.event_type OR a.value IS DISTINCT FROM b.value
       OR a.props IS DISTINCT FROM b.props)
"""))
def chain_violations_q(spark, sf_dir):
    """Before images that do not continue the previous after image of the key."""
    v = audit.chain_violations(fx.good(spark, sf_dir))
    return v.select(F.col("offset").alias("off"), "pk")


@query("chain_missing_before", with_log("""
d AS (SELECT *, lag(CASE WHEN op <> 'd' THEN event_id END) OVER (PARTITION BY user_id ORDER BY off) AS prev_after_eid FROM good)
SELECT off, CAST(user_id AS VARCHAR) AS pk, op FROM d WHERE op IN ('u', 'd') AND prev_after_eid IS NOT NULL
"""))
def chain_missing_before(spark, sf_dir):
    """W11, full images promised: updates and deletes without a before image whose key has a live
    image before (a log captured without before images)."""
    v = audit.chain_violations(fx.good(spark, sf_dir, before_images=False), full_images=True)
    return v.select(F.col("offset").alias("off"), "pk", "op")


@query("order_violations", with_log("""
d AS (SELECT *, lag(lsn) OVER (PARTITION BY user_id ORDER BY off) AS prev_lsn FROM good)
SELECT CAST(user_id AS VARCHAR) AS pk, off, lsn, prev_lsn FROM d WHERE prev_lsn > lsn
"""))
def order_violations_q(spark, sf_dir):
    """Deliveries whose LSN goes down for the key."""
    v = audit.order_violations(fx.good(spark, sf_dir))
    return v.select("pk", F.col("offset").alias("off"), "lsn", "prev_lsn")


@query("partition_violations", """
SELECT CAST(l_orderkey AS VARCHAR) AS pk, count(DISTINCT l_linenumber % 6) AS n_partitions
FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_linenumber % 6) > 1
""")
def partition_violations_q(spark, sf_dir):
    """Keys spread over several partitions (line items partitioned by line number)."""
    li = fx.table(spark, sf_dir, "lineitem")
    log = snapshot_to_changelog(li.withColumn("id", F.col("l_orderkey")), "order_items", "id", lsn=1,
                                ts=fx.SNAPSHOT_TS)
    ev = good_events(decode(log)).drop("partition")
    # the partition comes from the line number here, so one order spans partitions
    ev = ev.withColumn("partition", (F.col("after")["l_linenumber"].cast("int") % 6))
    return audit.partition_violations(ev, ("pk",)).select("pk", F.col("n_partitions").cast("bigint"))


@query("checkpoint_monotonic", with_log("""
c AS (SELECT part, date_trunc('hour', ts) AS batch, max(lsn) AS max_lsn FROM good GROUP BY part, batch),
d AS (SELECT *, lag(max_lsn) OVER (PARTITION BY part ORDER BY batch) AS prev FROM c)
SELECT 'users' AS table_name, part, bool_and(prev IS NULL OR prev <= max_lsn) AS monotonic, count(*) AS batches
FROM d GROUP BY part
"""))
def checkpoint_monotonic_q(spark, sf_dir):
    """Checkpointed LSN per (table, partition) never goes down across hourly batches."""
    g = fx.good(spark, sf_dir).withColumn("batch", F.date_trunc("hour", "timestamp"))
    ck = g.groupBy("table", "partition", "batch").agg(F.max("lsn").alias("max_lsn"))
    m = audit.checkpoint_monotonic(ck)
    return m.select(F.col("table").alias("table_name"), F.col("partition").alias("part"), "monotonic", "batches")


@query("constraint_audit", """
SELECT 'orders' AS table_name, 'status_enum' AS check_name,
       CAST(count(*) FILTER (WHERE coalesce(o_orderstatus NOT IN ('O', 'F'), TRUE)) AS BIGINT) AS violations FROM orders
UNION ALL SELECT 'orders', 'total_nonnegative', CAST(count(*) FILTER (WHERE coalesce(o_totalprice < 0, TRUE)) AS BIGINT) FROM orders
UNION ALL SELECT 'orders', 'custkey_not_null', CAST(count(*) FILTER (WHERE o_custkey IS NULL) AS BIGINT) FROM orders
UNION ALL SELECT 'lineitem', 'qty_positive', CAST(count(*) FILTER (WHERE coalesce(l_quantity <= 0, TRUE)) AS BIGINT) FROM lineitem
UNION ALL SELECT 'lineitem', 'price_nonnegative', CAST(count(*) FILTER (WHERE coalesce(l_extendedprice < 0, TRUE)) AS BIGINT) FROM lineitem
""")
def constraint_audit(spark, sf_dir):
    """F8: enum / range / not-null checks as counts of violating rows (one scan per table)."""
    o = fx.table(spark, sf_dir, "orders")
    li = fx.table(spark, sf_dir, "lineitem")
    a = audit.constraint_counts(o, "orders", {
        "status_enum": F.col("o_orderstatus").isin("O", "F"),
        "total_nonnegative": F.col("o_totalprice") >= 0,
        "custkey_not_null": F.col("o_custkey").isNotNull()})
    b = audit.constraint_counts(li, "lineitem", {
        "qty_positive": F.col("l_quantity") > 0,
        "price_nonnegative": F.col("l_extendedprice") >= 0})
    return a.unionByName(b)


@query("unique_audit", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def unique_audit(spark, sf_dir):
    """F8: (l_orderkey, l_linenumber) is not unique: the repeated pairs."""
    return audit.unique_violations(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
