"""Operational measures over change logs and decode results.

Counters are group-bys; the lag histogram is one ``count_if`` per bucket in a
single pass; quantiles interpolate inside buckets like a histogram quantile
or are exact, found by range partitioning and selection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelake.functions.scan import in_ranges

# Lag histogram bucket bounds (seconds); +Inf is implied.
LAG_BUCKETS = (0.1, 0.25, 0.5, 1, 2, 5, 10, 30, 60)


def events_processed(df: DataFrame, stage: str | Column = "stage") -> DataFrame:
    """A1: events by (stage, table, op)."""
    s = F.lit(stage) if isinstance(stage, str) and stage not in df.columns else F.col(stage) \
        if isinstance(stage, str) else stage
    return df.groupBy(s.alias("stage"), "table", "op").agg(F.count("*").alias("n"))


def write_errors(rejects: DataFrame, sink: str = "state", reason: Column | None = None) -> DataFrame:
    """A2: write errors by (sink, reason)."""
    r = reason if reason is not None else F.col("error_reason")
    return rejects.groupBy(F.lit(sink).alias("sink"), r.alias("reason")).agg(F.count("*").alias("n"))


def lag_seconds(df: DataFrame) -> Column:
    """Apply time minus source commit time, seconds (definition of replication lag)."""
    return (F.col("ts_ms") - F.col("source_ts_ms")) / F.lit(1000.0)


def bucket_label(b) -> str:
    return "+Inf" if b is None else (str(int(b)) if float(b).is_integer() else str(b))


def lag_histogram(df: DataFrame, lag: Column, by: str = "table", bounds=LAG_BUCKETS) -> DataFrame:
    """A3: cumulative bucket counts ``(by, le, n)``; one pass, one ``count_if`` per bound."""
    aggs = [F.count_if(lag <= F.lit(float(b))).alias(f"b{i}") for i, b in enumerate(bounds)]
    aggs.append(F.count("*").alias(f"b{len(bounds)}"))
    wide = df.groupBy(by).agg(*aggs)
    labels = [bucket_label(b) for b in bounds] + ["+Inf"]
    stack = ", ".join(f"'{lab}', CAST({float(b) if b is not None else 'NULL'} AS DOUBLE), b{i}"
                      for i, (lab, b) in enumerate(zip(labels, list(bounds) + [None])))
    return wide.selectExpr(by, f"stack({len(labels)}, {stack}) AS (le, upper, n)") \
               .select(by, "le", "upper", F.col("n").cast("bigint"))


def histogram_quantile(hist: DataFrame, q: float, by: str = "table") -> DataFrame:
    """A4: quantile from cumulative buckets, linear inside the bucket (lower bound of the
    first bucket is 0); when the rank falls in +Inf the last finite bound is returned."""
    w = Window.partitionBy(by).orderBy(F.col("upper").asc_nulls_last())
    h = (hist.withColumn("prev_n", F.coalesce(F.lag("n").over(w), F.lit(0)))
             .withColumn("lower", F.coalesce(F.lag("upper").over(w), F.lit(0.0)))
             .withColumn("total", F.max("n").over(Window.partitionBy(by))))
    h = h.withColumn("rank", F.lit(q) * F.col("total"))
    hit = h.filter((F.col("n") >= F.col("rank")) & (F.col("total") > 0))
    first = hit.groupBy(by).agg(F.min_by(F.struct("upper", "lower", "n", "prev_n", "rank"),
                                         F.coalesce(F.col("upper"), F.lit(float("inf")))).alias("b"))
    val = F.when(F.col("b.upper").isNull(), F.col("b.lower")).otherwise(
        F.col("b.lower") + (F.col("b.upper") - F.col("b.lower")) *
        F.try_divide(F.col("b.rank") - F.col("b.prev_n"), F.col("b.n") - F.col("b.prev_n")))
    return first.select(by, val.alias("quantile"))


def quantiles(df: DataFrame, value: Column, qs, by: str, accuracy: int | None = None) -> DataFrame:
    """A4: quantiles per group — exact (by selection) or, with ``accuracy``, the bounded-memory
    sketch ``percentile_approx`` (relative rank error about 1 / accuracy)."""
    if not accuracy:
        return exact_quantiles(df, value, qs, by)
    return df.groupBy(by).agg(*[F.percentile_approx(value, float(q), accuracy).alias(f"q{int(q * 1000)}") for q in qs])


def exact_quantiles(df: DataFrame, value: Column, qs, by: str) -> DataFrame:
    """A4: (``by``, q<1000 q>...): exact quantiles of each group, interpolated between the two
    nearest values, by distributed selection.

    Equal values are counted first (map-side). The (group, value, count) rows are dealt by range;
    the counts per range, one small row each, tell in which range a rank lies and how deep; only
    those ranges are read again, each summed up in order. No task holds more than a range, however
    many values a group has. Nulls do not count; a group of nulls only has null quantiles."""
    counted = df.select(F.col(by).alias("_g"), value.cast("double").alias("_v")).groupBy("_g", "_v").agg(F.count("_v").alias("_c"))
    ranged = in_ranges(counted, ["_g", "_v"], "quantiles")
    group = Window.partitionBy("_g")
    per = ranged.groupBy("_g", "_rng").agg(F.sum("_c").alias("n")) \
        .withColumn("total", F.sum("n").over(group)).withColumn("before", F.sum("n").over(group.orderBy("_rng")) - F.col("n"))
    place = [F.lit(float(q)) * (F.col("total") - 1) for q in qs]
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), part.alias("part"), whole(p).cast("bigint").alias("rank"), p.alias("place"))
                      for i, p in enumerate(place) for part, whole in ((F.lit("lo"), F.floor), (F.lit("hi"), F.ceil))])
    inside = F.filter(ranks, lambda r: (r["rank"] >= F.col("before")) & (r["rank"] < F.col("before") + F.col("n")))
    wanted = per.where("total > 0").select(F.col("_g").alias("g"), F.col("_rng").alias("r"), "before", F.explode(inside).alias("w"))
    held = ranged.join(wanted.select("g", "r").distinct(), F.col("_g").eqNullSafe(F.col("g")) & (F.col("_rng") == F.col("r")), "left_semi")
    summed = held.withColumn("_upto", F.sum("_c").over(Window.partitionBy("_g", "_rng").orderBy("_v")))
    at = F.col("w.rank") - F.col("before")
    hit = summed.join(wanted, F.col("_g").eqNullSafe(F.col("g")) & (F.col("_rng") == F.col("r"))
                      & (F.col("_upto") > at) & (F.col("_upto") - F.col("_c") <= at))
    pick = lambda i, part: F.max(F.when((F.col("w.i") == i) & (F.col("w.part") == part), F.col("_v")))
    at_place = lambda i: F.max(F.when(F.col("w.i") == i, F.col("w.place")))
    found = hit.groupBy("_g").agg(*[F.when(at_place(i) == F.floor(at_place(i)), pick(i, "lo")).otherwise(
        (F.ceil(at_place(i)) - at_place(i)) * pick(i, "lo") + (at_place(i) - F.floor(at_place(i))) * pick(i, "hi")).alias(f"q{int(q * 1000)}")
        for i, q in enumerate(qs)]).withColumnRenamed("_g", "g")
    groups = per.select("_g").distinct()
    return groups.join(found, F.col("_g").eqNullSafe(F.col("g")), "left").drop("g").withColumnRenamed("_g", by)


def throughput(df: DataFrame, ts: Column, stage: Column, width: str = "1 minute", seconds: int = 60) -> DataFrame:
    """Events per second per stage in tumbling windows."""
    return (df.groupBy(F.window(ts, width).start.alias("window_start"), stage.alias("stage"))
            .agg((F.count("*") / F.lit(float(seconds))).alias("rate")))


def bottleneck(rates: DataFrame) -> DataFrame:
    """Per window, the stage with the lowest rate (ties: first stage name)."""
    return rates.groupBy("window_start").agg(F.min(F.struct("rate", "stage")).alias("m")) \
                .select("window_start", F.col("m.stage").alias("stage"), F.col("m.rate").alias("rate"))


def offsets_of(log: DataFrame) -> DataFrame:
    """Oldest and next offset per (topic, partition) of a log."""
    return log.groupBy("topic", "partition").agg(F.min("offset").alias("oldest"),
                                                 (F.max("offset") + 1).alias("current"))


def dlq_depth(offsets: DataFrame, pattern: str = r"^dlq\.") -> DataFrame:
    """Unprocessed dead letters = sum(current - oldest) per DLQ topic."""
    return (offsets.filter(F.col("topic").rlike(pattern)).groupBy("topic")
            .agg(F.sum(F.col("current") - F.col("oldest")).alias("depth")))


def consumer_lag(ends: DataFrame, commits: DataFrame) -> DataFrame:
    """Per group and topic, sum over partitions of (end offset - committed offset)."""
    j = commits.join(ends, ["topic", "partition"])
    return j.groupBy("group_id", "topic").agg(F.sum(F.col("current") - F.col("committed")).alias("lag"))


def capacity(df: DataFrame, ts: Column, value: Column, by: str = "topic") -> DataFrame:
    """rows/s, bytes per event and the derived throughput, IOPS and disk estimates."""
    g = df.groupBy(by).agg(F.count("*").alias("n"),
                           (F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))).alias("span_us"),
                           F.avg(F.octet_length(value)).alias("bytes_per_event"))
    r = F.try_divide(F.col("n"), F.col("span_us") / F.lit(1e6))
    b = F.col("bytes_per_event")
    return g.select(by, r.alias("rows_per_s"), b.alias("bytes_per_event"),
                    (r * b * 2).alias("bus_bytes_per_s"), (r * b * 2 * 3).alias("bus_bytes_per_s_replicated"),
                    (r / F.lit(750.0)).alias("write_iops"),
                    (r * b * F.lit(86400 * 7) * F.lit(1.5)).alias("disk_bytes"))


def checkpoint_staleness(ck: DataFrame, now: Column, ts: str = "ts", by: str = "table") -> DataFrame:
    """Seconds since the last checkpoint write, per table."""
    return ck.groupBy(by).agg(F.max(ts).alias("last")) \
             .select(by, (F.unix_micros(now) - F.unix_micros(F.col("last"))).cast("double") / 1e6) \
             .toDF(by, "staleness_s")
