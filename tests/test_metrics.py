"""Measures: counters, histogram buckets and quantile, alerts with hold times."""

from pyspark.sql import functions as F

from changelake.operators import metrics as M
from changelake.operators import slo


def test_event_counters(spark):
    df = spark.createDataFrame([("sink", "users", "c"), ("sink", "users", "c"), ("sink", "users", "u"),
                                ("sink", "orders", "d")], "stage string, table string, op string")
    got = {(r["stage"], r["table"], r["op"]): r["n"] for r in M.events_processed(df, "stage").collect()}
    assert got == {("sink", "users", "c"): 2, ("sink", "users", "u"): 1, ("sink", "orders", "d"): 1}


def test_lag_histogram_single_observation(spark):
    df = spark.createDataFrame([("users", 1.2)], "table string, lag double")
    h = {r["le"]: r["n"] for r in M.lag_histogram(df, F.col("lag")).collect()}
    assert h["1"] == 0 and h["2"] == 1 and h["+Inf"] == 1 and h["0.1"] == 0


def test_histogram_quantile_interpolation_and_inf(spark):
    df = spark.createDataFrame([("t", x) for x in [0.05, 0.3, 0.3, 1.5]], "table string, lag double")
    q = M.histogram_quantile(M.lag_histogram(df, F.col("lag")), 0.5).first()["quantile"]
    assert abs(q - 0.375) < 1e-9        # rank 2 of 4: 0.25 + 0.25 * (2 - 1) / (3 - 1)
    big = spark.createDataFrame([("t", 100.0), ("t", 200.0)], "table string, lag double")
    assert M.histogram_quantile(M.lag_histogram(big, F.col("lag")), 0.99).first()["quantile"] == 60.0


def test_alert_hold_and_missing_samples(spark):
    # minutes 0..9 true except a missing sample at minute 4; hold 2 minutes
    rows = [(m, True) for m in range(10) if m != 4]
    s = spark.createDataFrame(rows, "m long, c boolean")
    ep = slo.alert_episodes(s, F.col("c"), 2).orderBy("pending_since").collect()
    assert [(r["held_minutes"]) for r in ep] == [4, 5]
    assert str(ep[0]["fired_at"]) == "1970-01-01 00:02:00"


def test_error_budget_tiers(spark):
    df = spark.createDataFrame([(100000, 10), (100000, 45), (100000, 60)], "processed long, errors long")
    tiers = [r["tier"] for r in slo.error_budget(df, 0.9995).orderBy("errors").collect()]
    assert tiers == ["normal", "feature-freeze", "slo-violated"]


def test_recommended_conf_scales_with_data():
    from changelake.session import recommended_conf
    small = recommended_conf(10 << 20, 1 << 20, 8)
    big = recommended_conf(100 << 40, 20 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 24 and int(small["state_buckets"]) == 16
    assert 24_000 <= int(big["spark.sql.shuffle.partitions"]) <= 40_000 and int(big["state_buckets"]) > 40_000


def test_exact_quantiles_equal_percentile(spark):
    rows = spark.range(5000).select((F.col("id") % 3).cast("string").alias("g"), F.when(F.col("id") % 11 == 0, F.lit(None))
                                    .when(F.col("id") % 3 == 1, F.lit(7.0)).otherwise(F.rand(3) * 100).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([("one", 4.5), ("none", None), (None, 1.0), (None, 2.0)], "g string, v double"))
    qs = (0.0, 0.25, 0.5, 0.99, 1.0)
    want = rows.groupBy("g").agg(*[F.percentile("v", q).alias(f"q{int(q * 1000)}") for q in qs])
    got = M.quantiles(rows, F.col("v"), qs, "g")
    key = lambda r: str(r.g)
    near = lambda a, b: a is b is None or abs(a - b) < 1e-9
    for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key)):
        assert a.g == b.g and all(near(a[f"q{int(q * 1000)}"], b[f"q{int(q * 1000)}"]) for q in qs)
    assert M.quantiles(rows.where("false"), F.col("v"), qs, "g").count() == 0


def test_availability_of_a_range_that_cuts_minutes(spark):
    df = spark.sql("SELECT timestamp '2024-01-02 00:00:10' AS ts UNION ALL SELECT timestamp '2024-01-01 23:59:59'")
    rows = slo.availability(df, F.col("ts"), "2024-01-01 00:00:00", "2024-01-02 00:00:30").orderBy("day").collect()
    assert [(r.up_minutes, r.down_minutes, r.availability) for r in rows] == [(1, 1439, 1 / 1440), (1, 0, 1.0)]
    rows = slo.availability(df, F.col("ts"), "2024-01-01 23:58:30", "2024-01-02 00:00:00").collect()
    assert [(r.up_minutes, r.down_minutes, r.availability) for r in rows] == [(1, 1, 0.5)]
