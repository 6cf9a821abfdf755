"""Alert rules with hold times (W7), evaluated on a per-minute series of the log.

The series has one row per minute of the log's time range (a spine from
``spark.range``), so a minute without data is a real sample. Every measure is
aggregated per minute first; windows then run over the minute series, whose
length is the time range, not the number of events.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from changelake.functions.scan import running
from changelake.operators.metrics import LAG_BUCKETS, lag_seconds
from changelake.operators.slo import alert_episodes, group_lag, histogram_rate_quantile, minute_index
from changelake.plans import fixtures as fx
from changelake.plans.registry import query
from changelake.plans.sql_fixtures import with_log
from changelake.session import scratch_dir, written

APPLY_MS = "((epoch_us(ts) // 1000) + floor(value * 100))"
SERIES_SQL = f"""
rec AS (SELECT CAST(floor(epoch(ts) / 60) AS BIGINT) AS m, count(*) AS n_rec,
               count(*) FILTER (WHERE reason IS NOT NULL) AS n_bad,
               count(*) FILTER (WHERE reason IS NULL) AS n_good
        FROM log WHERE reason IS NULL OR reason <> 'tombstone' GROUP BY 1),
app AS (SELECT CAST(floor({APPLY_MS} / 60000) AS BIGINT) AS m, count(*) AS n_app, max({APPLY_MS}) AS last_ms,
               quantile_cont(floor(value * 100) / 1000.0, 0.99) AS p99
        FROM good GROUP BY 1),
b AS (SELECT (SELECT min(m) FROM rec) AS m0, greatest((SELECT max(m) FROM rec), (SELECT max(m) FROM app)) AS m1),
sp AS (SELECT range AS m FROM range((SELECT m0 FROM b), (SELECT m1 FROM b) + 1)),
series AS (
  SELECT sp.m, coalesce(n_rec, 0) AS n_rec, coalesce(n_bad, 0) AS n_bad, coalesce(n_good, 0) AS n_good,
         coalesce(n_app, 0) AS n_app, p99,
         sum(coalesce(n_good, 0)) OVER (ORDER BY sp.m) - sum(coalesce(n_app, 0)) OVER (ORDER BY sp.m) AS consumer_lag,
         sum(coalesce(n_bad, 0)) OVER (ORDER BY sp.m) AS dlq_depth,
         (sp.m + 1) * 60000 - max(last_ms) OVER (ORDER BY sp.m) AS staleness_ms,
         sum(coalesce(n_bad, 0)) OVER w5 / nullif(sum(coalesce(n_rec, 0)) OVER w5, 0) AS error_rate
  FROM sp LEFT JOIN rec ON rec.m = sp.m LEFT JOIN app ON app.m = sp.m
  WINDOW w5 AS (ORDER BY sp.m RANGE BETWEEN 4 PRECEDING AND CURRENT ROW))"""


def minute_counts(spark, sf_dir):
    """One row per minute with data, from one decode: a record counts at its own minute, a good
    one also at the minute it is applied. Written once; all rules and bounds read it."""
    dec = fx.decoded(spark, sf_dir)
    recs = dec.filter(F.col("error_reason").isNull() | (F.col("error_reason") != "tombstone"))
    good = F.col("error_reason").isNull()
    seen = F.struct(minute_index(F.col("timestamp")).alias("m"), F.lit(False).alias("app"))
    applied = F.struct(F.floor(F.col("ts_ms") / 60000).cast("bigint").alias("m"), F.lit(True).alias("app"))
    rows = recs.select(good.alias("good"), "ts_ms", lag_seconds(recs).alias("lag"),
                       F.inline(F.when(good, F.array(seen, applied)).otherwise(F.array(seen))))
    per = rows.groupBy("m").agg(
        F.count_if(~F.col("app")).alias("n_rec"), F.count_if(~F.col("app") & ~F.col("good")).alias("n_bad"),
        F.count_if(~F.col("app") & F.col("good")).alias("n_good"), F.count_if("app").alias("n_app"),
        F.max(F.when(F.col("app"), F.col("ts_ms"))).alias("last_ms"),
        F.percentile(F.when(F.col("app"), F.col("lag")), 0.99).alias("p99"))
    path = scratch_dir(spark, "minutes")
    per.write.parquet(path)
    return spark.read.parquet(path)


def minute_series(spark, sf_dir):
    per = minute_counts(spark, sf_dir)
    m0, m1 = per.agg(F.min(F.when(F.col("n_rec") > 0, F.col("m"))), F.max("m")).first()
    spine = spark.range(m0, m1 + 1).withColumnRenamed("id", "m")   # one row per minute
    s = spine.join(per, "m", "left").fillna(0, subset=["n_rec", "n_bad", "n_good", "n_app"])
    # running totals per day-block with a carry (no single-task window over the series)
    s = running(s, [], "m", {"_good": ("sum", "n_good"), "_app": ("sum", "n_app"), "_bad": ("sum", "n_bad"),
                             "_last": ("max", "last_ms")}, 1440)
    # trailing 5-minute sums: each minute contributes to itself and the next four
    # (the expansion Spark's sliding window() performs), then one aggregate per minute
    w5 = (s.select(F.explode(F.sequence(F.col("m"), F.col("m") + 4)).alias("m"), "n_bad", "n_rec")
          .groupBy("m").agg(F.sum("n_bad").alias("_bad5"), F.sum("n_rec").alias("_rec5")))
    s = s.join(w5, "m", "left")
    return s.select(
        "m", "n_rec", "n_bad", "n_good", "n_app", "p99",
        (F.col("_good") - F.col("_app")).alias("consumer_lag"),
        F.col("_bad").alias("dlq_depth"),
        ((F.col("m") + 1) * 60000 - F.col("_last")).alias("staleness_ms"),
        F.try_divide(F.col("_bad5").cast("double"), F.col("_rec5").cast("double")).alias("error_rate"))


# The six alert rules — condition on the minute series and hold time.
ALERTS = {
    "alerts_replication_lag": ("ReplicationLagHigh", "p99 > 10", 5),
    "alerts_consumer_lag": ("ConsumerLagHigh", "consumer_lag > 10000", 2),
    "alerts_dlq_nonempty": ("DLQNonEmpty", "dlq_depth > 0", 1),
    "alerts_checkpoint_staleness": ("CheckpointStaleness", "staleness_ms > 60000", 2),
    "alerts_write_error_rate": ("WriteErrorRateHigh", "error_rate > 0.001", 5),
    "alerts_slot_inactive": ("ReplicationSlotInactive", "n_rec = 0", 2),
}
# The two rules that the test log does not reach, with thresholds it does.
LOWER = {
    "alerts_replication_lag_low": ("ReplicationLagHigh", "p99 > 4", 0),
    "alerts_consumer_lag_low": ("ConsumerLagHigh", "consumer_lag > 0", 0),
}


def _alert_sql(name, cond, hold):
    return with_log(SERIES_SQL + f""",
c AS (SELECT m FROM series WHERE coalesce({cond}, FALSE)),
i AS (SELECT m, m - row_number() OVER (ORDER BY m) AS isl FROM c),
e AS (SELECT min(m) AS s, max(m) AS e FROM i GROUP BY isl)
SELECT '{name}' AS alert, make_timestamp(s * 60000000) AS pending_since,
       make_timestamp((s + {hold}) * 60000000) AS fired_at, e - s + 1 AS held_minutes
FROM e WHERE e - s + 1 > {hold}
""")


def _alert_query(name, cond, hold):
    def build(spark, sf_dir):
        s = minute_series(spark, sf_dir)
        ep = alert_episodes(s, F.coalesce(F.expr(cond), F.lit(False)), hold)
        return ep.select(F.lit(name).alias("alert"), "pending_since", "fired_at", "held_minutes")
    build.__doc__ = f"W7: {name} — {cond} held for {hold} minute(s)."
    return build


for _key, (_name, _cond, _hold) in (ALERTS | LOWER).items():
    query(_key, _alert_sql(_name, _cond, _hold))(_alert_query(_name, _cond, _hold))


def _bucket_sql():
    return ", ".join(f"count(*) FILTER (WHERE floor(value * 100) / 1000.0 <= {float(b)}) AS b{i}" for i, b in enumerate(LAG_BUCKETS))


def _quantile_sql(q):
    out, below, lower = "CASE", "0", 0.0
    for i, b in enumerate(LAG_BUCKETS):
        out += f" WHEN b{i} >= {q} * n THEN {lower} + ({float(b)} - {lower}) * ({q} * n - {below}) / nullif(b{i} - {below}, 0)"
        below, lower = f"b{i}", float(b)
    return out + f" ELSE {lower} END"


_SUMS = ", ".join(f"CAST(sum(b{i}) AS BIGINT) AS b{i}" for i in range(len(LAG_BUCKETS)))


@query("alerts_lag_histogram", with_log(f"""
h AS (SELECT user_id % 2 AS shard, CAST(floor({APPLY_MS} / 60000) AS BIGINT) AS m, {_bucket_sql()}, count(*) AS n FROM good GROUP BY 1, 2),
t AS (SELECT shard, m + d AS m, {_SUMS}, CAST(sum(n) AS BIGINT) AS n FROM h, range(0, 5) AS r(d) GROUP BY 1, 2),
c AS (SELECT shard, m FROM t WHERE n > 0 AND {_quantile_sql(0.99)} > 4.5),
i AS (SELECT shard, m, m - row_number() OVER (PARTITION BY shard ORDER BY m) AS isl FROM c),
e AS (SELECT shard, min(m) AS s, max(m) AS e FROM i GROUP BY shard, isl)
SELECT CASE shard WHEN 0 THEN 'even' ELSE 'odd' END AS series, make_timestamp(s * 60000000) AS pending_since,
       make_timestamp((s + 2) * 60000000) AS fired_at, e - s + 1 AS held_minutes FROM e WHERE e - s + 1 > 2
"""))
def alerts_lag_histogram(spark, sf_dir):
    """Replication lag per series, p99 by interpolation in the buckets of the last five minutes."""
    g = fx.good(spark, sf_dir)
    g = g.withColumn("series", F.when(F.col("pk").cast("bigint") % 2 == 0, "even").otherwise("odd"))
    p99 = histogram_rate_quantile(g, lag_seconds(g), F.floor(F.col("ts_ms") / 60000).cast("bigint"), 0.99, ["series"])
    return alert_episodes(p99, F.col("quantile") > 4.5, 2, ["series"]).select("series", "pending_since", "fired_at", "held_minutes")


@query("alerts_lag_by_group", with_log("""
r AS (SELECT CAST(floor(epoch(ts) / 60) AS BIGINT) AS m, count(*) AS n FROM log GROUP BY 1),
sp AS (SELECT range AS m FROM range((SELECT min(m) FROM r), (SELECT max(m) FROM r) + 1)),
p AS (SELECT sp.m, coalesce(n, 0) AS n FROM sp LEFT JOIN r ON r.m = sp.m),
l AS (SELECT 'sink' AS grp, m, sum(n) OVER (ORDER BY m RANGE BETWEEN 1439 PRECEDING AND CURRENT ROW) AS lag FROM p
      UNION ALL SELECT 'transformer', m, sum(n) OVER (ORDER BY m RANGE BETWEEN 119 PRECEDING AND CURRENT ROW) FROM p),
c AS (SELECT grp, m FROM l WHERE lag > (SELECT sum(n) / 80 FROM r)),
i AS (SELECT grp, m, m - row_number() OVER (PARTITION BY grp ORDER BY m) AS isl FROM c),
e AS (SELECT grp, min(m) AS s, max(m) AS e FROM i GROUP BY grp, isl)
SELECT grp AS "group", make_timestamp(s * 60000000) AS pending_since, make_timestamp((s + 2) * 60000000) AS fired_at,
       e - s + 1 AS held_minutes FROM e WHERE e - s + 1 > 2
"""))
def alerts_lag_by_group(spark, sf_dir):
    """Consumer lag as one series per group (one is a day behind, one two hours); the limit is an
    eightieth of all records, which only one of them exceeds."""
    per = fx.events_log(spark, sf_dir).groupBy(minute_index(F.col("timestamp")).alias("m")).agg(F.count(F.lit(1)).alias("n"))
    per = written(per, "group-lag")
    m0, m1, total = per.agg(F.min("m"), F.max("m"), F.sum("n")).first()
    series = spark.range(m0, m1 + 1).withColumnRenamed("id", "m").join(per, "m", "left").fillna(0, subset=["n"])
    lag = group_lag(series, {"sink": 1440, "transformer": 120})
    return alert_episodes(lag, F.col("lag") > F.lit(total / 80), 2, ["group"]).select("group", "pending_since", "fired_at", "held_minutes")
