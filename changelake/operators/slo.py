"""Service-level measures: availability, success rate, error budget, burn rate,
alerts with hold times (A14, A15, A18, A19, W7).

Everything here is computed on per-minute aggregates first, so the windows
run over a series as long as the time range, not over raw events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.operators.metrics import LAG_BUCKETS


def minute_index(ts: Column) -> Column:
    return F.floor(F.unix_seconds(ts) / F.lit(60)).cast("bigint")


def availability(df: DataFrame, ts: Column, start: str | None = None, end: str | None = None) -> DataFrame:
    """Per day of [``start``, ``end``) the minutes with at least one event, the minutes
    without, and the share of the former. Minutes that the range cuts count whole. Days without
    any event are there with 0. Without bounds the range is that of the events, in whole days."""
    minutes = df.select(minute_index(ts).alias("m")).filter("m is not null").distinct()
    lo = F.unix_seconds(F.lit(start).cast("timestamp")) if start else \
        F.unix_seconds(F.date_trunc("day", F.timestamp_seconds(F.min("m") * 60)))
    hi = F.unix_seconds(F.lit(end).cast("timestamp")) if end else \
        F.unix_seconds(F.date_trunc("day", F.timestamp_seconds(F.max("m") * 60))) + 86400
    bounds = minutes.agg(lo.alias("lo"), hi.alias("hi"))
    day_of = lambda s: F.floor(s / 86400)
    spine = bounds.filter("lo < hi").select("lo", "hi", F.explode(F.sequence(day_of(F.col("lo")), day_of(F.col("hi") - 1))).alias("d"))
    first = F.greatest(F.floor(F.col("lo") / 60), F.col("d") * 1440)
    last = F.least(F.ceil(F.col("hi") / 60), (F.col("d") + 1) * 1440)
    spine = spine.select("d", first.alias("first"), last.alias("last"), (last - first).alias("minutes"))
    up = minutes.select("m", F.floor(F.col("m") / 1440).alias("d"))
    joined = spine.join(up, "d", "left").withColumn("inside", (F.col("m") >= F.col("first")) & (F.col("m") < F.col("last")))
    return joined.groupBy("d", "minutes").agg(F.count_if("inside").alias("up_minutes")).select(
        F.to_date(F.timestamp_seconds(F.col("d") * 86400)).alias("day"), "up_minutes",
        (F.col("minutes") - F.col("up_minutes")).cast("bigint").alias("down_minutes"),
        (F.col("up_minutes").cast("double") / F.col("minutes")).alias("availability"))


def success_share(counts: DataFrame) -> DataFrame:
    """``success_rate`` = 1 - errors / processed (null when nothing was processed)."""
    return counts.withColumn("success_rate", F.lit(1.0) - F.try_divide(F.col("errors").cast("double"),
                                                                       F.col("processed").cast("double")))


# Budget tiers by share of the budget consumed.
BUDGET_TIERS = ((0.5, "normal"), (0.8, "approval-required"), (1.0, "feature-freeze"))
BUDGET_OVER = "slo-violated"


def error_budget(totals: DataFrame, slo: float, total_col: str = "processed", bad_col: str = "errors") -> DataFrame:
    """Allowed bad events, spent, share spent and the resulting tier."""
    allowed = F.col(total_col) * F.lit(round(1.0 - slo, 12))
    spent = F.col(bad_col).cast("double")
    pct = F.try_divide(spent, allowed) * 100
    tier = None
    for bound, name in BUDGET_TIERS:
        c = pct <= bound * 100
        tier = F.when(c, F.lit(name)) if tier is None else tier.when(c, F.lit(name))
    tier = tier.otherwise(F.lit(BUDGET_OVER))
    return totals.withColumn("allowed", allowed).withColumn("spent", spent) \
                 .withColumn("pct_spent", pct).withColumn("tier", tier)


def burn_rate(per_minute: DataFrame, slo: float, by: str = "table", windows=((60, 14.4), (360, 6.0))) -> DataFrame:
    """Bad share over the trailing window divided by (1 - SLO), per minute with data.

    ``per_minute`` has ``(by, m, total, bad)``; a window of W minutes covers
    minutes m-W+1..m. ``page_<W>m`` is set when the rate reaches its threshold.
    Trailing sums are computed per (table, day) with halo rows (``scan.trailing``).
    """
    from changelake.functions.scan import trailing
    out = per_minute
    budget = F.lit(round(1.0 - slo, 12))
    for mins, threshold in windows:
        out = trailing(out, [by], "m", {f"_bad{mins}": ("sum", "bad"), f"_tot{mins}": ("sum", "total")},
                       mins, 1440)
        rate = F.try_divide(F.col(f"_bad{mins}").cast("double"), F.col(f"_tot{mins}").cast("double")) / budget
        out = out.withColumn(f"burn_{mins}m", rate).withColumn(f"page_{mins}m", rate >= F.lit(threshold)) \
                 .drop(f"_bad{mins}", f"_tot{mins}")
    return out


def histogram_rate_quantile(samples: DataFrame, lag: Column, minute: Column, q: float, by: list[str], minutes: int = 5,
                            bounds=LAG_BUCKETS) -> DataFrame:
    """The ``q`` quantile of a lag histogram over the trailing ``minutes``, per series ``by`` and
    minute: (by, m, n, quantile). Cumulative bucket counts are kept per minute (one ``count_if`` a
    bound, map-side), added up over the window, and the quantile interpolates inside its bucket
    from the bound below (0 for the first); beyond the last bound that bound is returned."""
    per = samples.select(*by, minute.alias("m"), lag.alias("_lag")).groupBy(*by, "m").agg(
        *[F.count_if(F.col("_lag") <= float(b)).alias(f"_b{i}") for i, b in enumerate(bounds)], F.count("_lag").alias("n"))
    names = [f"_b{i}" for i in range(len(bounds))] + ["n"]
    # Each minute feeds its own window and those of the next minutes.
    spread = per.select(*by, F.explode(F.sequence(F.col("m"), F.col("m") + minutes - 1)).alias("m"), *names)
    total = spread.groupBy(*by, "m").agg(*[F.sum(c).alias(c) for c in names])
    rank, out, below, lower = F.lit(q) * F.col("n"), None, F.lit(0), 0.0
    for name, bound in zip(names, bounds):
        inside = F.lit(lower) + F.lit(float(bound) - lower) * F.try_divide(rank - below, F.col(name) - below)
        out = F.when(F.col(name) >= rank, inside) if out is None else out.when(F.col(name) >= rank, inside)
        below, lower = F.col(name), float(bound)
    return total.where("n > 0").select(*by, "m", "n", out.otherwise(F.lit(lower)).alias("quantile"))


def group_lag(per_minute: DataFrame, behind: dict[str, int]) -> DataFrame:
    """(group, m, lag): records that a consumer group ``behind`` minutes late has still to read at
    each minute of a series (m, n): a trailing sum, by day with halo rows."""
    from changelake.functions.scan import trailing
    out = None
    for group, minutes in behind.items():
        one = trailing(per_minute.select("m", "n"), [], "m", {"lag": ("sum", "n")}, minutes, 1440).select(F.lit(group).alias("group"), "m", "lag")
        out = one if out is None else out.unionByName(one)
    return out


def alert_episodes(series: DataFrame, cond: Column, hold_minutes: int, by: list[str] | None = None,
                   block_minutes: int = 1440) -> DataFrame:
    """Firing episodes of an alert with a ``for`` hold time.

    ``series`` has one row per evaluated minute ``m``; minutes without a row
    are missing samples and end an episode. An episode is a run of consecutive
    minutes where ``cond`` holds; it fires once the condition has held for
    ``hold_minutes`` (at ``start + hold``). A run starts where the previous
    minute did not hold (a join on ``m - 1``); every minute of a run finds its
    start as the running maximum of run starts (a blocked scan, one task per day).
    """
    from changelake.functions.scan import running
    by = by or []
    t = series.filter(cond).select(*by, "m")
    prev = t.select(*by, (F.col("m") + 1).alias("m"), F.lit(True).alias("_prev"))
    t = t.join(prev, [*by, "m"], "left").withColumn(
        "_start", F.when(F.col("_prev").isNull(), F.col("m")))
    t = running(t, by, "m", {"_island": ("max", "_start")}, block_minutes)
    isl = t.groupBy(*by, "_island").agg(F.min("m").alias("start_m"), F.max("m").alias("end_m"))
    isl = isl.withColumn("held_minutes", F.col("end_m") - F.col("start_m") + 1) \
             .filter(F.col("held_minutes") > F.lit(hold_minutes))
    return isl.select(*by, F.timestamp_seconds(F.col("start_m") * 60).alias("pending_since"),
                      F.timestamp_seconds((F.col("start_m") + hold_minutes) * 60).alias("fired_at"),
                      "held_minutes")
