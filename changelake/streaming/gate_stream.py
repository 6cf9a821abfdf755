"""Streaming forms of the gate and of the metric windows.

``gate_stream`` keeps the winning change per key in the streaming state
(``max_by`` is a streaming aggregate; update mode emits only keys a batch
touched) and merges those rows into the state store in ``foreachBatch``; a
second query on the same source writes its dead letters and checkpoint rows.
Metric windows and the duplicate filter work batch by batch and keep no state,
so nothing here has a watermark and no late record is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.operators.decode import dead_letters, decode, good_events
from changelake.operators.gate import KEY, to_documents, win_order
from changelake.schemas import CHANGELOG_SCHEMA
from changelake.sources.changelog import spread
from changelake.sources.state_store import StateStore, checkpoint_rows
from changelake.streaming.apply import stream_id


def stream_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """Without ``max_files_per_trigger`` a batch is all files that are there and not yet read."""
    files = spark.readStream.schema(CHANGELOG_SCHEMA)
    if max_files_per_trigger:
        files = files.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return spread(files.parquet(path))


def stream_winners(log: DataFrame) -> DataFrame:
    """Streaming aggregation: the winning change per key so far."""
    ev = good_events(decode(log))
    rest = [c for c in ev.columns if c not in KEY]
    return ev.groupBy(*KEY).agg(F.max_by(F.struct(*rest), win_order()).alias("_w")).select(*KEY, "_w.*")


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def gate_stream(spark: SparkSession, path: str, store: StateStore, checkpoint: str,
                max_files_per_trigger: int = 1) -> list:
    """Streaming gate in update mode, merged into the state store per batch, and its side
    outputs. Returns both queries. The per-key state is kept in RocksDB, off the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    source = stream_source(spark, path, max_files_per_trigger)
    gate = (stream_winners(source).writeStream.outputMode("update").option("checkpointLocation", f"{checkpoint}/gate")
            .foreachBatch(lambda df, bid: store.apply(to_documents(df), bid, writer=stream_id(df)))
            .trigger(availableNow=True).start())

    def write_sides(df, bid):
        slim = decode(df).persist()
        try:
            store.write_side("dlq", dead_letters(slim), bid, stream_id(df))
            store.write_side("checkpoints", checkpoint_rows(good_events(slim)), bid, stream_id(df))
        finally:
            slim.unpersist()

    sides = (source.writeStream.option("checkpointLocation", f"{checkpoint}/sides").foreachBatch(write_sides)
             .trigger(availableNow=True).start())
    return [gate, sides]


def windowed_counts(batch: DataFrame, width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Counts per op of one batch in tumbling or sliding windows. The batches' counts add
    up to the windows' counts (``sum_of_batches``), late records included."""
    return (good_events(decode(batch))
            .groupBy(F.window("timestamp", width, slide).start.alias("window_start"), "op")
            .agg(F.count("*").alias("n")))


def dedup_batch(batch: DataFrame) -> DataFrame:
    """One event per (table, pk, lsn) of a batch, the first delivered: a cheap filter before
    the gate, which settles what repeats across batches."""
    ev = good_events(decode(batch))
    keys = ["table", "pk", "lsn"]
    rest = [c for c in ev.columns if c not in keys]
    return ev.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct("partition", "offset")).alias("_f")) \
        .select(*keys, "_f.*")


def dedup_keyed(log: DataFrame, delay: str = "1 hour") -> DataFrame:
    """T13 for append-only outputs: exact replays (same table, key, LSN and event time) dropped
    across batches with bounded state. Records later than the watermark are dropped, so this
    never stands before the gate."""
    ev = good_events(decode(log))
    return ev.withWatermark("timestamp", delay).dropDuplicates(["table", "pk", "lsn", "timestamp"])


def collect_updates(df: DataFrame, path: str, batch_id: int) -> None:
    """foreachBatch sink for update-mode results: one directory per batch (overwrite on re-run)."""
    df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def sum_of_batches(spark: SparkSession, path: str, keys: list[str], value: str) -> DataFrame:
    """Totals of per-batch counts written by ``collect_updates``."""
    return spark.read.parquet(path).groupBy(*keys).agg(F.sum(value).alias(value))
