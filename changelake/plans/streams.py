"""Structured Streaming queries (T1, T2, T5, T8, T9, T13, G10): a change log written as
time-ordered files is consumed with ``availableNow`` (drain then stop)."""

from __future__ import annotations

from pyspark.sql import functions as F

from changelake.plans import fixtures as fx
from changelake.plans.core import LATEST_SQL
from changelake.plans.registry import query
from changelake.plans.sql_fixtures import LATEST_CTE, TYPED_DOC_SELECT, with_log
from changelake.session import scratch_dir, written
from changelake.sources.state_store import StateStore
from changelake.streaming.apply import stream_apply
from changelake.streaming.gate_stream import (ROCKSDB, collect_updates, dedup_batch, dedup_keyed, gate_stream, stream_source,
                                              sum_of_batches, windowed_counts)

CHUNKS = 4
#: Text that a file of a slice holds at most, about.
FILE_TEXT = 1 << 29


def log_slices(spark, sf_dir):
    """The events change log as files, appended in time order in CHUNKS slices: the path, given after
    each. How many files a slice is in follows its text, and they are in no order among themselves."""
    log = written(fx.events_log(spark, sf_dir), "log")
    path = scratch_dir(spark, "log-files")
    lo, hi, size = log.agg(F.unix_micros(F.min("timestamp")), F.unix_micros(F.max("timestamp")), F.sum(F.octet_length("value"))).first()
    files = max(1, -(-(size or 0) // (CHUNKS * FILE_TEXT)))
    step = (hi - lo) // CHUNKS + 1
    us = F.unix_micros("timestamp")
    for k in range(CHUNKS):
        part = log.filter((us >= lo + k * step) & (us < lo + (k + 1) * step))
        part.repartition(files).write.mode("append").parquet(path)
        yield path


def log_files(spark, sf_dir):
    """All slices of the events change log as files, for readers that no order of records changes."""
    return list(log_slices(spark, sf_dir))[-1]


@query("stream_apply", with_log(LATEST_CTE + f"SELECT {TYPED_DOC_SELECT} FROM latest WHERE op <> 'd'"))
def stream_apply_q(spark, sf_dir):
    """File stream -> foreachBatch (decode, compact, merge touched buckets) -> state."""
    src = log_files(spark, sf_dir)
    store = StateStore(spark, scratch_dir(spark, "stream-state"), buckets=16)
    q = stream_apply(spark, src, store, scratch_dir(spark, "stream-ck"), max_files_per_trigger=1)
    q.awaitTermination()
    return fx.typed_docs(store.current())


def _run_gate(spark, sf_dir):
    store = StateStore(spark, scratch_dir(spark, "gate-state"), buckets=16)
    for q in gate_stream(spark, log_files(spark, sf_dir), store, scratch_dir(spark, "gate-ck"), max_files_per_trigger=8):
        q.awaitTermination()
    return store


@query("gate_stream", LATEST_SQL)
def gate_stream_q(spark, sf_dir):
    """Streaming max_by per key (update mode) merged into the state store."""
    st = _run_gate(spark, sf_dir).read()
    return st.select("_id", "sourceLsn", F.col("lastOp").alias("op"), F.col("_srcOffset").alias("off"))


@query("gate_stream_sides", with_log("""
SELECT 'rejected' AS what, reason AS name, CAST(count(*) AS BIGINT) AS n FROM log
WHERE reason IS NOT NULL AND reason <> 'tombstone' GROUP BY reason
UNION ALL SELECT 'applied', CAST(part AS VARCHAR), CAST(count(*) AS BIGINT) FROM good GROUP BY part
"""))
def gate_stream_sides(spark, sf_dir):
    """The streaming gate's dead letters by reason and its checkpointed events by partition."""
    store = _run_gate(spark, sf_dir)
    bad = store.read_side("dlq").groupBy(F.lit("rejected").alias("what"), F.col("error_reason").alias("name")) \
        .agg(F.count("*").alias("n"))
    good = store.read_side("checkpoints").groupBy(F.lit("applied").alias("what"), F.col("partition").cast("string").alias("name")) \
        .agg(F.sum("events").alias("n"))
    return bad.unionByName(good)


def _by_batch(spark, sf_dir, purpose, transform):
    """Each micro-batch's ``transform`` in a directory of its own; returns the path."""
    out = scratch_dir(spark, purpose)
    q = (stream_source(spark, log_files(spark, sf_dir), 8).writeStream
         .option("checkpointLocation", scratch_dir(spark, f"{purpose}-ck"))
         .foreachBatch(lambda df, bid: collect_updates(transform(df), out, bid)).trigger(availableNow=True).start())
    q.awaitTermination()
    return out


@query("stream_windows", with_log("""
SELECT date_trunc('hour', ts) AS window_start, op, count(*) AS n FROM good GROUP BY 1, 2
"""))
def stream_windows_q(spark, sf_dir):
    """Hourly counts per op, added up over the micro-batches."""
    out = _by_batch(spark, sf_dir, "windows", windowed_counts)
    return sum_of_batches(spark, out, ["window_start", "op"], "n").select("window_start", "op", "n")


@query("stream_sliding_windows", with_log("""
SELECT time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(5 * k) AS window_start, op, count(*) AS n
FROM good, range(0, 3) AS r(k) GROUP BY 1, 2
"""))
def stream_sliding_windows_q(spark, sf_dir):
    """15-minute counts per op every 5 minutes, the sliding form of rates."""
    out = _by_batch(spark, sf_dir, "sliding", lambda df: windowed_counts(df, "15 minutes", "5 minutes"))
    return sum_of_batches(spark, out, ["window_start", "op"], "n").select("window_start", "op", "n")


@query("stream_dedup", with_log("""
SELECT DISTINCT CAST(user_id AS VARCHAR) AS pk, lsn FROM good
"""))
def stream_dedup_q(spark, sf_dir):
    """Repeats dropped within each micro-batch before the gate; every (key, LSN) survives."""
    out = _by_batch(spark, sf_dir, "dedup", dedup_batch)
    return spark.read.parquet(out).select("pk", "lsn").distinct()


@query("stream_progress", with_log("""
SELECT count(*) AS records, count(*) FILTER (WHERE reason IS NULL) AS good,
       count(*) FILTER (WHERE reason IS NOT NULL AND reason <> 'tombstone') AS rejected,
       count(*) FILTER (WHERE reason = 'tombstone') AS tombstones
FROM log
"""))
def stream_progress_q(spark, sf_dir):
    """Counters observed on the decoded stream, gathered per micro-batch by a listener."""
    import uuid
    from changelake.streaming.progress import collect_progress, observed_decode
    src = log_files(spark, sf_dir)
    name = f"decode_progress_{uuid.uuid4().hex[:8]}"
    collector = collect_progress(spark, name)
    try:
        d = observed_decode(stream_source(spark, src), name)
        q = (d.writeStream.option("checkpointLocation", scratch_dir(spark, "progress-ck"))
             .foreachBatch(lambda df, bid: df.write.mode("overwrite").parquet(scratch_dir(spark, f"decoded-{bid}")))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        reported = [p["batchId"] for p in q.recentProgress if name in (p.get("observedMetrics") or {})]
        if reported:
            collector.wait_for(max(reported))
    finally:
        spark.streams.removeListener(collector)
    rows = [(r["batch_id"], r["records"], r["good"], r["rejected"], r["tombstones"]) for r in collector.rows]
    per_batch = spark.createDataFrame(rows, "batch_id long, records long, good long, rejected long, tombstones long")
    return per_batch.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
                           for c in ("records", "good", "rejected", "tombstones")])


@query("stream_dedup_keyed", with_log("""
SELECT DISTINCT CAST(user_id AS VARCHAR) AS pk, lsn, ts AS event_time FROM good
"""))
def stream_dedup_keyed_q(spark, sf_dir):
    """T13 (keyed): replays of a record dropped in the stream, state evicted by watermark. The stream
    goes on from its checkpoint after each slice of the log and takes the slice's files as one batch:
    file by file, the watermark of the first would drop the others' records as late."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)   # a slice's keys, off the heap
    out, checkpoint = scratch_dir(spark, "dedup-keyed"), scratch_dir(spark, "dedup-keyed-ck")
    for src in log_slices(spark, sf_dir):
        d = dedup_keyed(stream_source(spark, src, None)).select("pk", "lsn", F.col("timestamp").alias("event_time"))
        q = (d.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
             .format("parquet").option("path", out).trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(out)
