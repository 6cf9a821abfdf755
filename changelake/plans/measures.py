"""Operational measures (A1-A5, A12-A25, L4) over the decoded events log."""

from __future__ import annotations

from pyspark.sql import functions as F

from changelake.operators import metrics as M
from changelake.operators import slo
from changelake.operators.decode import dead_letters
from changelake.plans import fixtures as fx
from changelake.plans.registry import query
from changelake.plans.sql_fixtures import with_log

LAG_SQL = "(floor(value * 100) / 1000.0)"
WIRE_OP_SQL = "CASE WHEN reason = 'bad_json' THEN NULL WHEN event_id % 71 = 0 THEN 'x' ELSE op END"


@query("events_processed", with_log(f"""
SELECT 'transformer' AS stage, 'users' AS table_name, {WIRE_OP_SQL} AS op, count(*) AS n
FROM log WHERE reason IS NULL OR reason <> 'tombstone' GROUP BY 3
UNION ALL
SELECT 'sink', 'users', op, count(*) FROM good GROUP BY op
"""))
def events_processed(spark, sf_dir):
    """A1: events by (stage, table, op): every mapped record, and every applied event
    (one pass: a good record counts for both stages)."""
    dec = fx.decoded(spark, sf_dir).filter(F.col("error_reason").isNull() | (F.col("error_reason") != "tombstone"))
    stages = F.when(F.col("error_reason").isNull(), F.array(F.lit("transformer"), F.lit("sink"))) \
              .otherwise(F.array(F.lit("transformer")))
    both = dec.select(F.explode(stages).alias("stage"), "table", "op")
    return M.events_processed(both, "stage").withColumnRenamed("table", "table_name")


@query("write_errors", with_log("""
SELECT 'state' AS sink, reason, count(*) AS n FROM log WHERE reason IS NOT NULL AND reason <> 'tombstone' GROUP BY reason
"""))
def write_errors(spark, sf_dir):
    """A2: write errors by (sink, reason)."""
    return M.write_errors(dead_letters(fx.decoded(spark, sf_dir)))


BOUNDS = [0.1, 0.25, 0.5, 1, 2, 5, 10, 30, 60]


def _hist_sql():
    parts = []
    for b in BOUNDS:
        lab = str(int(b)) if float(b).is_integer() else str(b)
        parts.append(f"SELECT 'users' AS table_name, '{lab}' AS le, CAST({float(b)} AS DOUBLE) AS upper, "
                     f"count(*) FILTER (WHERE {LAG_SQL} <= {float(b)}) AS n FROM good")
    parts.append("SELECT 'users', '+Inf', CAST(NULL AS DOUBLE), count(*) FROM good")
    return "\nUNION ALL ".join(parts)


@query("lag_histogram", with_log(_hist_sql()))
def lag_histogram(spark, sf_dir):
    """A3: cumulative replication-lag histogram per table (apply time - source commit time)."""
    g = fx.good(spark, sf_dir)
    return M.lag_histogram(g, M.lag_seconds(g)).withColumnRenamed("table", "table_name")


@query("lag_quantile", with_log(f"""
h AS ({_hist_sql()}),
o AS (SELECT *, coalesce(lag(n) OVER (ORDER BY upper NULLS LAST), 0) AS prev_n,
             coalesce(lag(upper) OVER (ORDER BY upper NULLS LAST), 0.0) AS lower,
             max(n) OVER () AS total FROM h),
r AS (SELECT *, 0.99 * total AS rnk FROM o),
f AS (SELECT * FROM r WHERE n >= rnk AND total > 0 ORDER BY upper NULLS LAST LIMIT 1)
SELECT 'users' AS table_name,
       (SELECT CASE WHEN upper IS NULL THEN lower ELSE lower + (upper - lower) * (rnk - prev_n) / (n - prev_n) END FROM f)
         AS p99_histogram,
       (SELECT quantile_cont({LAG_SQL}, 0.99) FROM good) AS p99_exact,
       (SELECT quantile_cont({LAG_SQL}, 0.5) FROM good) AS p50_exact
"""))
def lag_quantile(spark, sf_dir):
    """A4: p99 lag interpolated inside histogram buckets, and exact p99 / p50."""
    g = fx.good(spark, sf_dir)
    lag = M.lag_seconds(g)
    hq = M.histogram_quantile(M.lag_histogram(g, lag), 0.99).withColumnRenamed("quantile", "p99_histogram")
    ex = M.quantiles(g, lag, (0.99, 0.5), "table").select("table", F.col("q990").alias("p99_exact"), F.col("q500").alias("p50_exact"))
    return hq.join(ex, "table").withColumnRenamed("table", "table_name")


@query("lag_quantile_approx", "SELECT 'users' AS table_name, TRUE AS p50_near, TRUE AS p99_near, TRUE AS p999_near")
def lag_quantile_approx(spark, sf_dir):
    """A4 at scale: p50 / p99 / p999 lag by a bounded-memory sketch; the oracle holds its ranks to
    a thousandth of the events (the share below the value, and the share up to it)."""
    g = fx.good(spark, sf_dir)
    g = g.select("table", M.lag_seconds(g).alias("lag"))
    sketch = M.quantiles(g, F.col("lag"), (0.5, 0.99, 0.999), "table", accuracy=10000)
    found = g.join(sketch, "table").groupBy("table").agg(*(
        F.struct(F.avg((F.col("lag") < F.col(c)).cast("double")).alias("lo"),
                 F.avg((F.col("lag") <= F.col(c)).cast("double")).alias("hi")).alias(c) for c in ("q500", "q990", "q999")))
    return found.select(F.col("table").alias("table_name"), *(
        ((F.col(c)["lo"] <= q + 0.001) & (F.col(c)["hi"] >= q - 0.001)).alias(name)
        for c, q, name in (("q500", 0.5, "p50_near"), ("q990", 0.99, "p99_near"), ("q999", 0.999, "p999_near"))))


APPLY_TS_SQL = "make_timestamp(CAST(((epoch_us(ts) // 1000) + floor(value * 100)) * 1000 AS BIGINT))"


def _stage_rows(spark, sf_dir):
    """(stage, time) per record in one pass: mapped records at record time, applied ones
    also at apply time."""
    dec = fx.decoded(spark, sf_dir).filter(F.col("error_reason").isNull() | (F.col("error_reason") != "tombstone"))
    mapped = F.struct(F.lit("transformer").alias("stage"), F.col("timestamp").alias("t"))
    sink = F.struct(F.lit("sink").alias("stage"), F.timestamp_millis("ts_ms").alias("t"))
    rows = F.when(F.col("error_reason").isNull(), F.array(mapped, sink)).otherwise(F.array(mapped))
    return dec.select(F.inline(rows))


def _stage_sql(width):
    return f"""
s AS (SELECT 'transformer' AS stage, ts AS t FROM log WHERE reason IS NULL OR reason <> 'tombstone'
      UNION ALL SELECT 'sink', {APPLY_TS_SQL} FROM good),
r AS (SELECT date_trunc('{width}', t) AS window_start, stage, count(*) / {60.0 if width == 'minute' else 3600.0} AS rate
      FROM s GROUP BY 1, 2)"""


@query("throughput", with_log(_stage_sql("minute") + "\nSELECT * FROM r"))
def throughput(spark, sf_dir):
    """Events per second per stage in 1-minute windows."""
    s = _stage_rows(spark, sf_dir)
    return M.throughput(s, F.col("t"), F.col("stage"), "1 minute", 60)


@query("bottleneck", with_log(_stage_sql("hour") + """
SELECT window_start, stage, rate FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY rate, stage) AS rn FROM r) WHERE rn = 1
"""))
def bottleneck(spark, sf_dir):
    """Per hour, the stage with the lower rate."""
    s = _stage_rows(spark, sf_dir)
    return M.bottleneck(M.throughput(s, F.col("t"), F.col("stage"), "1 hour", 3600))


AVAILABLE_FROM, AVAILABLE_TO = "2023-12-30", "2024-03-03 12:00:00"


@query("availability", with_log(f"""
m AS (SELECT DISTINCT date_trunc('minute', {APPLY_TS_SQL}) AS mi FROM good),
days AS (SELECT CAST(d AS DATE) AS day, greatest(d, TIMESTAMP '{AVAILABLE_FROM}') AS lo,
                least(d + INTERVAL 1 DAY, TIMESTAMP '{AVAILABLE_TO}') AS hi
         FROM range(TIMESTAMP '{AVAILABLE_FROM}', TIMESTAMP '{AVAILABLE_TO}', INTERVAL 1 DAY) AS r(d)),
up AS (SELECT day, hi, lo, count(mi) AS n FROM days LEFT JOIN m ON mi >= lo AND mi < hi GROUP BY ALL)
SELECT day, n AS up_minutes, CAST(date_diff('minute', lo, hi) - n AS BIGINT) AS down_minutes,
       n / date_diff('minute', lo, hi) AS availability FROM up
"""))
def availability(spark, sf_dir):
    """Share of the minutes of each day of a given range with at least one applied event."""
    g = fx.good(spark, sf_dir)
    return slo.availability(g, F.timestamp_millis("ts_ms"), AVAILABLE_FROM, AVAILABLE_TO)


def _processed_errors(spark, sf_dir):
    dec = fx.decoded(spark, sf_dir).filter(F.col("error_reason").isNull() | (F.col("error_reason") != "tombstone"))
    return dec.groupBy(F.col("table").alias("table_name")).agg(
        F.count("*").alias("processed"), F.count_if(F.col("error_reason").isNotNull()).alias("errors"))


PE_SQL = """
pe AS (SELECT 'users' AS table_name, count(*) AS processed, count(*) FILTER (WHERE reason IS NOT NULL) AS errors
       FROM log WHERE reason IS NULL OR reason <> 'tombstone')"""


@query("success_rate", with_log(PE_SQL + """
SELECT table_name, processed, errors, 1.0 - errors / processed AS success_rate FROM pe
"""))
def success_rate(spark, sf_dir):
    """Write success rate 1 - errors / processed."""
    return slo.success_share(_processed_errors(spark, sf_dir))


@query("error_budget", with_log(PE_SQL + """
SELECT table_name, processed, errors, processed * CAST(0.0005 AS DOUBLE) AS allowed, CAST(errors AS DOUBLE) AS spent,
       errors / (processed * CAST(0.0005 AS DOUBLE)) * 100 AS pct_spent,
       CASE WHEN errors / (processed * CAST(0.0005 AS DOUBLE)) * 100 <= 50 THEN 'normal'
            WHEN errors / (processed * CAST(0.0005 AS DOUBLE)) * 100 <= 80 THEN 'approval-required'
            WHEN errors / (processed * CAST(0.0005 AS DOUBLE)) * 100 <= 100 THEN 'feature-freeze' ELSE 'slo-violated' END AS tier
FROM pe
"""))
def error_budget(spark, sf_dir):
    """Error budget of the 99.95 % write-success SLO: allowed, spent, share, tier."""
    return slo.error_budget(_processed_errors(spark, sf_dir), 0.9995)


@query("burn_rate", with_log("""
pm AS (SELECT 'users' AS table_name, CAST(floor(epoch(ts) / 60) AS BIGINT) AS m, count(*) AS total,
              count(*) FILTER (WHERE reason IS NOT NULL) AS bad
       FROM log WHERE reason IS NULL OR reason <> 'tombstone' GROUP BY 2)
SELECT table_name, m, total, bad,
       sum(bad) OVER w60 / sum(total) OVER w60 / CAST(0.01 AS DOUBLE) AS burn_60m,
       sum(bad) OVER w60 / sum(total) OVER w60 / CAST(0.01 AS DOUBLE) >= 14.4 AS page_60m,
       sum(bad) OVER w360 / sum(total) OVER w360 / CAST(0.01 AS DOUBLE) AS burn_360m,
       sum(bad) OVER w360 / sum(total) OVER w360 / CAST(0.01 AS DOUBLE) >= 6.0 AS page_360m
FROM pm
WINDOW w60 AS (PARTITION BY table_name ORDER BY m RANGE BETWEEN 59 PRECEDING AND CURRENT ROW),
       w360 AS (PARTITION BY table_name ORDER BY m RANGE BETWEEN 359 PRECEDING AND CURRENT ROW)
"""))
def burn_rate(spark, sf_dir):
    """Budget burn rate over the trailing hour and six hours (99 % SLO), per minute."""
    dec = fx.decoded(spark, sf_dir).filter(F.col("error_reason").isNull() | (F.col("error_reason") != "tombstone"))
    pm = dec.groupBy(F.col("table").alias("table_name"), slo.minute_index(F.col("timestamp")).alias("m")).agg(
        F.count("*").alias("total"), F.count_if(F.col("error_reason").isNotNull()).alias("bad"))
    return slo.burn_rate(pm, 0.99, "table_name")


def _multi_topic_offsets(spark, sf_dir):
    """The log plus its dead-letter topic, in one pass: a rejected record is emitted a
    second time under ``dlq.users`` (explode), so the derived log is computed once."""
    dec = fx.decoded(spark, sf_dir)
    rej = F.col("error_reason").isNotNull() & (F.col("error_reason") != "tombstone")
    topics = F.when(rej, F.array(F.col("topic"), F.lit("dlq.users"))).otherwise(F.array(F.col("topic")))
    return dec.select(F.explode(topics).alias("topic"), "partition", "offset", "timestamp")


@query("dlq_depth", with_log("""
SELECT 'dlq.users' AS topic, CAST(sum(mx - mn + 1) AS BIGINT) AS depth FROM (
  SELECT part, min(off) AS mn, max(off) AS mx FROM log WHERE reason IS NOT NULL AND reason <> 'tombstone' GROUP BY part)
"""))
def dlq_depth(spark, sf_dir):
    """Unprocessed dead letters per DLQ topic = sum(current - oldest offset)."""
    return M.dlq_depth(M.offsets_of(_multi_topic_offsets(spark, sf_dir)))


# Fixed values of the derived consumer groups: how far behind the newest record each one
# has committed.
GROUP_BEHIND = {"sink": "1 DAY", "transformer": "2 HOURS"}


def _commits(spark, sf_dir):
    """End offsets and every group's committed offset per (topic, partition), in one
    aggregation over the log (conditional maxima), instead of one pass per group."""
    log = _multi_topic_offsets(spark, sf_dir)
    mx = log.agg(F.max("timestamp")).first()[0]
    aggs = [(F.max("offset") + 1).alias("current")]
    for g, behind in GROUP_BEHIND.items():
        cut = F.col("timestamp") < F.lit(mx) - F.expr(f"INTERVAL {behind}")
        aggs.append((F.max(F.when(cut, F.col("offset"))) + 1).alias(f"c_{g}"))
    per = log.groupBy("topic", "partition").agg(*aggs)
    stack = ", ".join(f"'{g}', c_{g}" for g in GROUP_BEHIND)
    commits = per.selectExpr("topic", "partition", "current",
                             f"stack({len(GROUP_BEHIND)}, {stack}) AS (group_id, committed)") \
                 .filter(F.col("committed").isNotNull())
    return commits


LAG_SQL_CTE = """
l AS (SELECT 'cdc.users' AS topic, part, off, ts FROM log
      UNION ALL SELECT 'dlq.users', part, off, ts FROM log WHERE reason IS NOT NULL AND reason <> 'tombstone'),
mx AS (SELECT max(ts) AS m FROM l),
ends AS (SELECT topic, part, max(off) + 1 AS cur FROM l GROUP BY 1, 2),
commits AS (
  SELECT 'sink' AS group_id, topic, part, max(off) + 1 AS committed FROM l, mx WHERE ts < m - INTERVAL 1 DAY GROUP BY 2, 3
  UNION ALL
  SELECT 'transformer', topic, part, max(off) + 1 FROM l, mx WHERE ts < m - INTERVAL 2 HOUR GROUP BY 2, 3),
pl AS (SELECT c.group_id, c.topic, c.part, e.cur - c.committed AS lag FROM commits c JOIN ends e USING (topic, part))"""


@query("consumer_lag", with_log(LAG_SQL_CTE + """
SELECT group_id, topic, CAST(sum(lag) AS BIGINT) AS lag FROM pl GROUP BY 1, 2
"""))
def consumer_lag(spark, sf_dir):
    """Consumer lag per group and topic = sum over partitions of (end - committed)."""
    c = _commits(spark, sf_dir)
    return c.groupBy("group_id", "topic").agg(F.sum(F.col("current") - F.col("committed")).alias("lag"))


@query("laggards", with_log(LAG_SQL_CTE + """
SELECT group_id, topic, part, lag FROM pl WHERE lag > 1000 ORDER BY lag DESC, group_id, topic, part LIMIT 5
"""))
def laggards(spark, sf_dir):
    """L4: the five (group, topic, partition) with the largest lag above 1,000."""
    c = _commits(spark, sf_dir)
    pl = c.select("group_id", "topic", F.col("partition").alias("part"), (F.col("current") - F.col("committed")).alias("lag"))
    return pl.filter(F.col("lag") > 1000).orderBy(F.col("lag").desc(), "group_id", "topic", "part").limit(5)


@query("checkpoint_staleness", with_log(f"""
ck AS (SELECT date_trunc('hour', ts) AS batch, max({APPLY_TS_SQL}) AS t FROM good GROUP BY 1)
SELECT 'users' AS table_name,
       (epoch_us((SELECT max(ts) FROM log) + INTERVAL 1 HOUR) - epoch_us(max(t))) / 1e6 AS staleness_s FROM ck
"""))
def checkpoint_staleness(spark, sf_dir):
    """Seconds since the last checkpoint write (as of one hour after the newest record)."""
    dec = fx.decoded(spark, sf_dir)
    now = dec.agg(F.max("timestamp")).first()[0]
    g = dec.filter(F.col("error_reason").isNull())
    ck = g.groupBy("table", F.date_trunc("hour", "timestamp").alias("batch")).agg(
        F.max(F.timestamp_millis("ts_ms")).alias("ts"))
    out = M.checkpoint_staleness(ck, F.lit(now) + F.expr("INTERVAL 1 HOUR"))
    return out.withColumnRenamed("table", "table_name")


@query("retained_wal", """
WITH p AS (SELECT user_id % 4 AS s, event_id * 16777216 + user_id AS pos FROM events)
SELECT 'slot_' || CAST(s AS VARCHAR) AS slot_name, CAST((SELECT max(pos) FROM p) - min(pos) AS BIGINT) AS retained_bytes
FROM p GROUP BY s
""")
def retained_wal(spark, sf_dir):
    """WAL retained by each slot = newest position - the slot's restart position."""
    from changelake.functions.scalar import lsn_to_long
    from changelake.plans.mapping import wal_positions
    w = wal_positions(spark, sf_dir).withColumn("pos", lsn_to_long("current_lsn"))
    cur = w.agg(F.max("pos")).first()[0]
    slots = w.groupBy(F.concat(F.lit("slot_"), (F.col("user_id") % 4).cast("string")).alias("slot_name")) \
             .agg(F.min("pos").alias("restart"))
    return slots.select("slot_name", (F.lit(cur) - F.col("restart")).cast("bigint").alias("retained_bytes"))


REQUEST_OP = "CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' WHEN 'view' THEN 'read' ELSE 'update' END"


@query("request_summary", f"""
SELECT op, count(*) AS requests, avg(value) AS avg_ms, quantile_cont(value, 0.95) AS p95_ms,
       quantile_cont(value, 0.99) AS p99_ms, max(value) AS max_ms,
       count(*) FILTER (WHERE value > 300) / count(*) AS failed_share,
       count(*) FILTER (WHERE value > 300) / count(*) < 0.01 AS failed_ok,
       CASE op WHEN 'insert' THEN quantile_cont(value, 0.99) < 100 WHEN 'update' THEN quantile_cont(value, 0.99) < 150 END
         AS p99_ok
FROM (SELECT {REQUEST_OP} AS op, value FROM events) GROUP BY op
""")
def request_summary(spark, sf_dir):
    """Request-log summary (events as requests, value as latency, > 300 ms failed)."""
    ev = fx.table(spark, sf_dir, "events")
    op = F.expr(REQUEST_OP)
    ev = ev.select(op.alias("op"), "value")
    tails = M.quantiles(ev, F.col("value"), (0.95, 0.99), "op").select("op", F.col("q950").alias("p95_ms"), F.col("q990").alias("p99_ms"))
    g = ev.groupBy("op").agg(
        F.count("*").alias("requests"), F.avg("value").alias("avg_ms"),
        F.max("value").alias("max_ms"), (F.count_if(F.col("value") > 300) / F.count("*")).alias("failed_share"))
    g = g.join(tails, "op").select("op", "requests", "avg_ms", "p95_ms", "p99_ms", "max_ms", "failed_share")
    return g.withColumn("failed_ok", F.col("failed_share") < 0.01).withColumn(
        "p99_ok", F.when(F.col("op") == "insert", F.col("p99_ms") < 100)
                   .when(F.col("op") == "update", F.col("p99_ms") < 150))


@query("capacity", """
SELECT 'cdc.users' AS topic, count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6) AS rows_per_s,
       avg(strlen(props)) AS bytes_per_event
FROM events
""")
def capacity(spark, sf_dir):
    """rows/s and bytes/event of a log, with the throughput, IOPS and disk estimates."""
    ev = fx.table(spark, sf_dir, "events").withColumn("topic", F.lit("cdc.users"))
    c = M.capacity(ev, F.col("ts").cast("timestamp"), F.col("props"))
    return c.select("topic", "rows_per_s", "bytes_per_event")


@query("capacity_plan")
def capacity_plan(spark, sf_dir):
    """Full capacity estimate per topic of the change log (bus bytes, IOPS, disk)."""
    log = fx.events_log(spark, sf_dir)
    return M.capacity(log, F.col("timestamp"), F.col("value"))
