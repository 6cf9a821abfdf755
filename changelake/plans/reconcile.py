"""Reconciliation of a source table with a target."""

from __future__ import annotations

from pyspark.sql import functions as F

from changelake.functions.scan import running
from changelake.operators import reconcile as R
from changelake.operators.decode import decode, good_events
from changelake.operators.gate import DOC_INPUT, compact
from changelake.plans import fixtures as fx
from changelake.plans.registry import query
from changelake.plans.sql_fixtures import NEXT_ORDERS_CTE, ORDER_COLS, row_text_sql, with_ctes, with_log

BUCKETS = 16
BUCKET_SQL = "CAST(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8)) AS BIGINT) % {n}"
TERM_SQL = "CAST(('0x' || substr(md5({t}), 1, 15)) AS BIGINT)"
TERM2_SQL = "CAST(('0x' || substr(md5({t}), 17, 15)) AS BIGINT)"


def _children_after_cascade(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    nxt = fx.orders_next(spark, sf_dir).select("o_orderkey")
    return li.join(nxt, li.l_orderkey == nxt.o_orderkey, "left_semi")


@query("count_parity", with_ctes(NEXT_ORDERS_CTE, body="""
SELECT table_name, src_count, tgt_count, src_count = tgt_count AS counts_equal FROM (
  SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS src_count, (SELECT count(*) FROM nxt) AS tgt_count
  UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem),
         (SELECT count(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM nxt))
  UNION ALL SELECT 'customer', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer))
"""))
def count_parity(spark, sf_dir):
    """Row counts per table on both sides (target = second snapshot after cascade)."""
    def counts(frames):
        out = None
        for name, df in frames:
            c = df.groupBy().agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
            out = c if out is None else out.unionByName(c)
        return out
    src = counts([("orders", fx.table(spark, sf_dir, "orders")), ("lineitem", fx.table(spark, sf_dir, "lineitem")),
                  ("customer", fx.table(spark, sf_dir, "customer"))])
    tgt = counts([("orders", fx.orders_next(spark, sf_dir)), ("lineitem", _children_after_cascade(spark, sf_dir)),
                  ("customer", fx.table(spark, sf_dir, "customer"))])
    return R.count_parity(src, tgt)


def _md5_sql(name, table):
    return f"""SELECT '{name}' AS table_name, md5(string_agg(m, ',' ORDER BY r)) AS md5, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT floor(o_orderkey / 10000) AS r, count(*) AS n,
         md5(string_agg(md5({row_text_sql(ORDER_COLS)}), ',' ORDER BY o_orderkey)) AS m
  FROM {table} GROUP BY 1)"""


@query("table_md5", with_ctes(NEXT_ORDERS_CTE, body=_md5_sql("orders", "orders") + " UNION ALL " + _md5_sql("orders_next", "nxt")))
def table_md5(spark, sf_dir):
    """Ordered checksum of each side, ranges of keys in parallel."""
    a = R.table_md5(fx.table(spark, sf_dir, "orders"), "o_orderkey", ORDER_COLS).withColumn("table_name", F.lit("orders"))
    b = R.table_md5(fx.orders_next(spark, sf_dir), "o_orderkey", ORDER_COLS).withColumn("table_name", F.lit("orders_next"))
    return a.unionByName(b).select("table_name", "md5", "n")


FAN = 32


def _cut_sql(text, level):
    return f"CAST(('0x' || substr(md5(coalesce({text}, '')), {8 * level - 7}, 8)) AS BIGINT) % {FAN} = 0"


def _merkle_sql(name, rows):
    """CTEs <name>_1, <name>_2: the nodes of two levels over ``rows`` (k, kt, t); struct order is k's."""
    return f"""
{name}_o AS (SELECT k, t, max(CASE WHEN {_cut_sql('kt', 1)} THEN k END) OVER (ORDER BY k) AS o FROM ({rows})),
{name}_1 AS (SELECT o AS k, md5(string_agg(t, ',' ORDER BY k, t)) AS t, count(*) AS n FROM {name}_o GROUP BY o),
{name}_p AS (SELECT *, max(CASE WHEN {_cut_sql(row_text_sql(['k']), 2)} AND k IS NOT NULL THEN k END) OVER (ORDER BY k NULLS FIRST) AS o
             FROM {name}_1),
{name}_2 AS (SELECT o AS k, md5(string_agg(t, ',' ORDER BY k NULLS FIRST, t)) AS t, CAST(sum(n) AS BIGINT) AS n FROM {name}_p GROUP BY o)"""


def _root_sql(label, name):
    return f"SELECT '{label}' AS table_name, md5(string_agg(t, ',' ORDER BY k NULLS FIRST, t)) AS root, CAST(sum(n) AS BIGINT) AS n FROM {name}_2"


CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
MERKLE_SQL = [NEXT_ORDERS_CTE,
              _merkle_sql("c", f"SELECT c_name AS k, {row_text_sql(['c_name'])} AS kt, md5({row_text_sql(CUSTOMER_COLS)}) AS t FROM customer"),
              _merkle_sql("o", f"SELECT o_orderkey * 1000003 AS k, {row_text_sql(['o_orderkey * 1000003'])} AS kt, "
                               f"md5({row_text_sql(ORDER_COLS)}) AS t FROM orders"),
              _merkle_sql("x", f"SELECT o_orderkey * 1000003 AS k, {row_text_sql(['o_orderkey * 1000003'])} AS kt, "
                               f"md5({row_text_sql(ORDER_COLS)}) AS t FROM nxt")]


def _sparse(orders):
    return orders.withColumn("k", F.col("o_orderkey") * 1000003)


@query("table_merkle", with_ctes(*MERKLE_SQL, body=_root_sql("customer", "c") + " UNION ALL " + _root_sql("orders", "o")
                                 + " UNION ALL " + _root_sql("orders_next", "x")))
def table_merkle(spark, sf_dir):
    """Roots of Merkle trees over ranges of a text key and of an integer key with wide gaps."""
    tables = [("customer", fx.table(spark, sf_dir, "customer"), "c_name", CUSTOMER_COLS),
              ("orders", _sparse(fx.table(spark, sf_dir, "orders")), "k", ORDER_COLS),
              ("orders_next", _sparse(fx.orders_next(spark, sf_dir)), "k", ORDER_COLS)]
    out = None
    for name, df, key, cols in tables:
        root = R.merkle_nodes(df, [key], cols, FAN, 2).where("level = 3").select(F.lit(name).alias("table_name"), F.col("node").alias("root"), "n")
        out = root if out is None else out.unionByName(root)
    return out


@query("merkle_drift", with_ctes(*MERKLE_SQL, body="""
SELECT CASE WHEN o.t IS NOT NULL THEN o.k ELSE x.k END AS first_key, o.t IS NOT NULL AS in_src, x.t IS NOT NULL AS in_tgt
FROM o_1 o FULL OUTER JOIN x_1 x ON o.k IS NOT DISTINCT FROM x.k WHERE o.t IS DISTINCT FROM x.t
"""))
def merkle_drift(spark, sf_dir):
    """The ranges of keys in which two tables differ, by descending their Merkle trees."""
    src = R.merkle_nodes(_sparse(fx.table(spark, sf_dir, "orders")), ["k"], ORDER_COLS, FAN, 2)
    tgt = R.merkle_nodes(_sparse(fx.orders_next(spark, sf_dir)), ["k"], ORDER_COLS, FAN, 2)
    d = R.merkle_diff(src, tgt, 2)
    return d.select(F.substring_index("first", ":", -1).cast("bigint").alias("first_key"), "in_src", "in_tgt")


@query("table_digest", f"""
SELECT {BUCKET_SQL.format(k='o_orderkey', n=BUCKETS)} AS bucket, count(*) AS n,
       CAST(sum({TERM_SQL.format(t=row_text_sql(ORDER_COLS))}) AS VARCHAR) AS digest,
       CAST(sum({TERM2_SQL.format(t=row_text_sql(ORDER_COLS))}) AS VARCHAR) AS digest2
FROM orders GROUP BY 1
""")
def table_digest(spark, sf_dir):
    """Scalable order-free digest per hash bucket (partial aggregation, no single reducer)."""
    d = R.table_digest(fx.table(spark, sf_dir, "orders"), "o_orderkey", ORDER_COLS, BUCKETS)
    return d.select(F.col("bucket").cast("bigint").alias("bucket"), "n", F.col("digest").cast("string").alias("digest"),
                    F.col("digest2").cast("string").alias("digest2"))


@query("drift", with_ctes(NEXT_ORDERS_CTE, body=f"""
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN t.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra' ELSE 'changed' END AS drift
FROM orders s FULL OUTER JOIN nxt t ON s.o_orderkey = t.o_orderkey
WHERE s.o_orderkey IS NULL OR t.o_orderkey IS NULL OR md5({row_text_sql(ORDER_COLS, 's')}) <> md5({row_text_sql(ORDER_COLS, 't')})
"""))
def drift_q(spark, sf_dir):
    """Rows missing from, extra in, or changed in the target."""
    return R.drift(fx.table(spark, sf_dir, "orders"), fx.orders_next(spark, sf_dir), "o_orderkey", ORDER_COLS)


def _round_trip(spark, sf_dir):
    """orders -> snapshot change log -> decode -> gate -> typed rows again."""
    ev = good_events(decode(fx.orders_log(spark, sf_dir)))
    w = compact(ev, cols=DOC_INPUT)
    a = F.col("after")
    return w.select(a["o_orderkey"].cast("bigint").alias("o_orderkey"), a["o_custkey"].cast("bigint").alias("o_custkey"),
                    a["o_orderstatus"].alias("o_orderstatus"), a["o_totalprice"].cast("double").alias("o_totalprice"),
                    a["o_orderdate"].cast("timestamp_ntz").alias("o_orderdate"),
                    a["o_orderpriority"].alias("o_orderpriority"))


def _ambiguous(spark, sf_dir):
    """Rows of ``orders`` as two text columns cut at different places around a bar, and nulls
    beside the text \\N: the same when joined by a bar, different row by row."""
    o = fx.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("s"), F.col("o_orderpriority").alias("p"))
    odd = F.col("o_orderkey") % 2 == 1
    src = o.select("o_orderkey", F.when(odd, F.concat("s", F.lit("|x"))).alias("a"),
                   F.when(odd, F.col("p")).otherwise(F.lit("\\N")).alias("b"))
    tgt = o.select("o_orderkey", F.when(odd, F.col("s")).alias("a"), F.when(odd, F.concat(F.lit("x|"), "p")).alias("b"))
    return src, tgt


@query("drift_ambiguous", "SELECT o_orderkey, 'changed' AS drift FROM orders")
def drift_ambiguous(spark, sf_dir):
    """Every row differs, though all look alike with a bar between columns and \\N for null."""
    src, tgt = _ambiguous(spark, sf_dir)
    return R.drift(src, tgt, "o_orderkey", ["a", "b"])


@query("integrity_ambiguous", """
SELECT count(*) AS src_count, count(*) AS tgt_count, FALSE AS content_equal, 'INTEGRITY FAILED' AS verdict FROM orders
""")
def integrity_ambiguous(spark, sf_dir):
    """A10: the same two sides fail the verdict."""
    src, tgt = _ambiguous(spark, sf_dir)
    return R.integrity(src, tgt, "o_orderkey", ["a", "b"])


@query("integrity", with_ctes(NEXT_ORDERS_CTE, body="""
SELECT 'orders_vs_next' AS comparison, (SELECT count(*) FROM orders) AS src_count, (SELECT count(*) FROM nxt) AS tgt_count,
       FALSE AS content_equal, 'INTEGRITY FAILED' AS verdict
UNION ALL
SELECT 'orders_vs_round_trip', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders), TRUE, 'INTEGRITY OK'
"""))
def integrity_q(spark, sf_dir):
    """A10: verdicts: the changed snapshot fails, the change-log round trip of orders passes."""
    o = fx.table(spark, sf_dir, "orders").select(*ORDER_COLS)
    a = R.integrity(o, fx.orders_next(spark, sf_dir), "o_orderkey", ORDER_COLS).withColumn(
        "comparison", F.lit("orders_vs_next"))
    b = R.integrity(o, _round_trip(spark, sf_dir), "o_orderkey", ORDER_COLS).withColumn(
        "comparison", F.lit("orders_vs_round_trip"))
    return a.unionByName(b).select("comparison", "src_count", "tgt_count", "content_equal", "verdict")


@query("sample_reconcile", with_ctes(NEXT_ORDERS_CTE, body=f"""
SELECT side, count(*) AS n, CAST(sum({TERM_SQL.format(t=row_text_sql(ORDER_COLS))}) AS VARCHAR) AS digest FROM (
  SELECT 'src' AS side, * FROM orders UNION ALL SELECT 'tgt', * FROM nxt)
WHERE {BUCKET_SQL.format(k='o_orderkey', n=100)} < 10 GROUP BY side
"""))
def sample_reconcile(spark, sf_dir):
    """10 % key-hash sample — the same keys on both sides — counted and digested."""
    out = None
    for side, df in (("src", fx.table(spark, sf_dir, "orders")), ("tgt", fx.orders_next(spark, sf_dir))):
        s = R.key_sample(df, "o_orderkey", 10)
        d = R.digest_terms(s, "o_orderkey", ORDER_COLS, 1).groupBy().agg(
            F.count("*").alias("n"), F.sum("_h").cast("decimal(38,0)").alias("digest")).withColumn("side", F.lit(side))
        out = d if out is None else out.unionByName(d)
    return out.select("side", "n", F.col("digest").cast("string").alias("digest"))


@query("row_diff", with_ctes(NEXT_ORDERS_CTE, body="""
SELECT *, 'only_src' AS side FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM nxt)
UNION ALL
SELECT *, 'only_tgt' FROM (SELECT * FROM nxt EXCEPT ALL SELECT * FROM orders)
"""))
def row_diff_q(spark, sf_dir):
    """Rows only in the source and rows only in the target."""
    return R.row_diff(fx.table(spark, sf_dir, "orders").select(*ORDER_COLS),
                      fx.orders_next(spark, sf_dir).select(*ORDER_COLS))


POLL_SECONDS = 120

DRAIN_SQL = with_log(f"""
b AS (SELECT min((epoch_us(ts) // 1000)) AS t0 FROM good),
e AS (SELECT CAST(ceil(((epoch_us(ts) // 1000) - t0) / {POLL_SECONDS * 1000}.0) AS BIGINT) AS ps,
             CAST(ceil(((epoch_us(ts) // 1000) + floor(value * 100) - t0) / {POLL_SECONDS * 1000}.0) AS BIGINT) AS pt
      FROM good, b),
sp AS (SELECT range AS k FROM range(0, (SELECT max(pt) FROM e) + 1)),
ns AS (SELECT ps AS k, count(*) AS n FROM e GROUP BY ps),
nt AS (SELECT pt AS k, count(*) AS n FROM e GROUP BY pt),
cum AS (SELECT sp.k, sum(coalesce(ns.n, 0)) OVER (ORDER BY sp.k) AS src_count,
               sum(coalesce(nt.n, 0)) OVER (ORDER BY sp.k) AS tgt_count
        FROM sp LEFT JOIN ns ON ns.k = sp.k LEFT JOIN nt ON nt.k = sp.k),
m AS (SELECT k, src_count = tgt_count AS ok, lag(src_count = tgt_count) OVER (ORDER BY k) AS prev_ok FROM cum),
p AS (SELECT make_timestamp(CAST(((SELECT t0 FROM b) + k * {POLL_SECONDS * 1000}) * 1000 AS BIGINT)) AS poll_ts
      FROM m WHERE ok AND prev_ok)
SELECT CAST(poll_ts AS DATE) AS day, min(poll_ts) AS drained_at FROM p GROUP BY 1
""")


@query("drained_at", DRAIN_SQL)
def drained_at_q(spark, sf_dir):
    """Polls every 2 minutes of source-committed vs target-applied counts; per day, the
    first poll where two consecutive polls matched. Counts are bucketed per poll first, so
    the window runs over the poll series (as long as the time range), not over events."""
    g = fx.good(spark, sf_dir).select("source_ts_ms", "ts_ms")
    t0 = g.agg(F.min("source_ts_ms")).first()[0]
    step = POLL_SECONDS * 1000
    e = g.select(F.ceil((F.col("source_ts_ms") - t0) / F.lit(float(step))).alias("ps"),
                 F.ceil((F.col("ts_ms") - t0) / F.lit(float(step))).alias("pt"))
    ns = e.groupBy(F.col("ps").alias("k")).agg(F.count("*").alias("ns"))
    nt = e.groupBy(F.col("pt").alias("k")).agg(F.count("*").alias("nt"))
    last = e.agg(F.max("pt")).first()[0]
    spine = spark.range(0, last + 1).withColumnRenamed("id", "k")   # one row per poll of the time range
    c = spine.join(ns, "k", "left").join(nt, "k", "left").fillna(0, subset=["ns", "nt"])
    # running counts per block of a day's polls, carried across blocks
    cum = running(c, [], "k", {"src_count": ("sum", "ns"), "tgt_count": ("sum", "nt")}, 86400 // POLL_SECONDS)
    t = F.timestamp_millis(F.lit(t0) + F.col("k") * F.lit(step))
    polls = cum.withColumn("poll_ts", t).withColumn("day", F.to_date(t))
    return R.drained_at(polls, [], "k", "poll_ts", F.col("src_count") == F.col("tgt_count"),
                        report=["day"]).select("day", "drained_at")


# Retention per topic family in days (None = kept forever).
RETENTION_DAYS = {"cdc": 7, "transformed": 3, "dlq": None}


@query("retain", with_log("""
t AS (
  SELECT 'cdc.users' AS topic, ts FROM log
  UNION ALL SELECT 'transformed.users', ts FROM log WHERE reason IS NULL
  UNION ALL SELECT 'dlq.users', ts FROM log WHERE reason IS NOT NULL AND reason <> 'tombstone'),
h AS (SELECT max(ts) AS mx FROM t)
SELECT topic,
       count(*) FILTER (WHERE CASE split_part(topic, '.', 1) WHEN 'cdc' THEN ts >= mx - INTERVAL 7 DAY
                                   WHEN 'transformed' THEN ts >= mx - INTERVAL 3 DAY ELSE TRUE END) AS kept,
       count(*) FILTER (WHERE NOT CASE split_part(topic, '.', 1) WHEN 'cdc' THEN ts >= mx - INTERVAL 7 DAY
                                   WHEN 'transformed' THEN ts >= mx - INTERVAL 3 DAY ELSE TRUE END) AS dropped
FROM t, h GROUP BY topic
"""))
def retain_q(spark, sf_dir):
    """Retention prune by topic policy (7 d change log, 3 d mapped log, DLQ kept)."""
    dec = fx.decoded(spark, sf_dir)
    reason = F.col("error_reason")
    topics = F.array_compact(F.array(
        F.lit("cdc.users"),
        F.when(reason.isNull(), F.lit("transformed.users")),
        F.when(reason.isNotNull() & (reason != "tombstone"), F.lit("dlq.users"))))
    t = dec.select(F.explode(topics).alias("topic"), "timestamp")      # one pass over the log
    mx = t.agg(F.max("timestamp")).first()[0]
    fam = F.substring_index("topic", ".", 1)
    keep = F.lit(True)
    for name, days in RETENTION_DAYS.items():
        if days is not None:
            keep = F.when(fam == name, F.col("timestamp") >= F.lit(mx) - F.expr(f"INTERVAL {days} DAYS")).otherwise(keep)
    return t.groupBy("topic").agg(F.count_if(keep).alias("kept"), F.count_if(~keep).alias("dropped"))
