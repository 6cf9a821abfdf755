"""Streaming apply: commit after side effect; a failed batch is re-run with the same id."""

import os
import tempfile

import pytest
from conftest import envelope, key, log_df
from pyspark.sql import functions as F

from changelake.sources.state_store import StateStore
from changelake.streaming import apply as A


def test_failed_batch_redelivered_same_result(spark, monkeypatch):
    src = tempfile.mkdtemp(dir="/tmp")
    steps = [[(1, 100, "c", {"id": 1, "v": "a"})], [(1, 200, "u", {"id": 1, "v": "b"})],
             [(2, 100, "c", {"id": 2, "v": "c"})]]
    for i, batch in enumerate(steps):
        log_df(spark, [("cdc.users", 0, i, key(pk), envelope(op, lsn, after=after))
                       for pk, lsn, op, after in batch]).write.mode("append").parquet(src)
    store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=4)
    ck = os.path.join(tempfile.mkdtemp(dir="/tmp"), "ck")
    seen = []
    real = A.apply_batch

    def flaky(store_, df, bid, rules=None, **kw):
        seen.append(bid)
        if bid == 1 and seen.count(1) == 1:
            real(store_, df, bid, rules, fail_after_state=True)
        real(store_, df, bid, rules, **kw)

    monkeypatch.setattr(A, "apply_batch", flaky)
    q = A.stream_apply(spark, src, store, ck, max_files_per_trigger=1)
    try:
        q.awaitTermination()
    except Exception:  # noqa: BLE001 - the injected failure stops the query
        pass
    q = A.stream_apply(spark, src, store, ck, max_files_per_trigger=1)   # restart from the checkpoint
    q.awaitTermination()
    assert seen[:2] == [0, 1] and seen.count(1) == 2
    live = {r["_id"]: dict(r["doc"])["v"] for r in store.current().collect()}
    assert live == {"users:1": "b", "users:2": "c"}


def test_bounded_read_by_pattern_and_offsets(spark):
    from changelake.sources.changelog import read_changelog
    src = tempfile.mkdtemp(dir="/tmp")
    log_df(spark, [("cdc.users", 0, i, key(i), envelope("c", i, after={"id": i})) for i in range(10)] +
           [("cdc.orders", 0, i, key(i), envelope("c", i, after={"id": i}, table="orders")) for i in range(5)]) \
        .write.mode("overwrite").parquet(src)
    got = read_changelog(spark, src, pattern=r"cdc\.users", offset_range=(2, 6))
    assert sorted(r["offset"] for r in got.collect()) == [2, 3, 4, 5]


def test_stream_apply_set_mode_merges_partial_images(spark):
    src = tempfile.mkdtemp(dir="/tmp")
    batches = [[(1, 1, "c", {"id": 1, "a": "x", "b": "y"})], [(1, 2, "u", {"id": 1, "b": "z"})],
               [(1, 3, "u", {"id": 1, "c": None})]]
    for i, batch in enumerate(batches):
        log_df(spark, [("cdc.users", 0, i, key(pk), envelope(op, lsn, after=after))
                       for pk, lsn, op, after in batch]).write.mode("append").parquet(src)
    store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=4)
    q = A.stream_apply(spark, src, store, os.path.join(tempfile.mkdtemp(dir="/tmp"), "ck"),
                       max_files_per_trigger=1, mode="set")
    q.awaitTermination()
    (doc,) = [dict(r["doc"]) for r in store.current().collect()]
    assert doc == {"id": "1", "a": "x", "b": "z", "c": None}


class _Kafka:
    """Stands in for the Kafka reader, whose package is not installed: loads the given rows."""

    def __init__(self, rows):
        self.read, self.rows, self.options = self, rows, {}

    def format(self, name):
        assert name == "kafka"
        return self

    def option(self, name, value):
        self.options[name] = value
        return self

    def load(self):
        return self.rows


def test_kafka_reads_honour_tables_and_offset_range(spark):
    from changelake.sources.changelog import read_changelog
    rows = spark.createDataFrame([(t, 0, i, "k", f"{t}{i}") for t in ("cdc.users", "cdc.orders") for i in range(6)],
                                 "topic string, partition int, offset long, key string, value string") \
        .withColumn("timestamp", F.current_timestamp())
    got = read_changelog(_Kafka(rows), "host:1", fmt="kafka", tables=["users"], offset_range=(2, 4)).collect()
    assert sorted(r.value for r in got) == ["cdc.users2", "cdc.users3"]
    with pytest.raises(ValueError, match="max_files_per_trigger"):
        read_changelog(_Kafka(rows), "host:1", fmt="kafka", max_files_per_trigger=5)


def test_apply_caches_nothing_and_keeps_no_lookup_rows(spark, monkeypatch):
    from changelake.rules import DEFAULT_RULES
    cached, rows = [], []
    real, side = StateStore.apply, StateStore.write_side
    before = spark.sparkContext._jsc.getPersistentRDDs().size()

    def spy(self, *args, **kw):
        cached.append(spark.sparkContext._jsc.getPersistentRDDs().size())
        return real(self, *args, **kw)

    def side_spy(self, kind, df, *args, **kw):
        rows.append((kind, df.count()))
        return side(self, kind, df, *args, **kw)
    monkeypatch.setattr(StateStore, "apply", spy)
    monkeypatch.setattr(StateStore, "write_side", side_spy)
    store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=4)
    good = [("cdc.order_items", 0, i, key(i), envelope("c", 5, table="order_items", after={"id": i})) for i in range(5)]
    A.apply_batch(store, log_df(spark, [*good, ("cdc.order_items", 0, 9, key(9), "{not json"),
                                        ("cdc.users", 0, 1, key(1), envelope("c", 5, after={"id": 1}))]), 0, rules=DEFAULT_RULES)
    assert [r["_id"] for r in store.current().collect()] == ["users:1"]
    assert rows == [("dlq", 1), ("checkpoints", 1)]
    assert max(cached) <= before


def _tasks_of_batches(spark, log):
    seen = []
    q = log.writeStream.option("checkpointLocation", os.path.join(tempfile.mkdtemp(dir="/tmp"), "ck")) \
        .foreachBatch(lambda df, _: seen.append(df.select(F.spark_partition_id()).distinct().count())).trigger(availableNow=True).start()
    q.awaitTermination()
    return seen


def _one_file(spark):
    src = tempfile.mkdtemp(dir="/tmp")
    log_df(spark, [("cdc.users", 0, i, key(i), envelope("c", i, after={"id": i})) for i in range(200)]).coalesce(1).write.mode("append").parquet(src)
    return src


def test_stream_source_spreads_a_file_over_tasks(spark):
    from changelake.streaming.gate_stream import stream_source
    assert min(_tasks_of_batches(spark, stream_source(spark, _one_file(spark)))) > 1


def test_streamed_changelog_spreads_a_file_over_tasks(spark):
    from changelake.sources.changelog import read_changelog
    assert min(_tasks_of_batches(spark, read_changelog(spark, _one_file(spark), stream=True, max_files_per_trigger=1))) > 1


def test_log_files_do_not_multiply_with_tasks(spark, monkeypatch):
    """The log is derived once, and a small slice is a few files however many tasks derive it."""
    from changelake.plans import streams
    sf = tempfile.mkdtemp(dir="/tmp")
    spark.range(400).select(F.col("id").alias("event_id"), F.timestamp_micros(F.col("id") * 1000000).alias("ts"),
                            (F.col("id") % 9).alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.5).alias("value"),
                            F.lit('{"k":1}').alias("props")).write.parquet(f"{sf}/events.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        path = streams.log_files(spark, sf)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) <= streams.CHUNKS
    assert spark.read.parquet(path).count() == 440


def test_dedup_keyed_keeps_every_event_whatever_files_a_slice_is_in(spark, monkeypatch):
    """Events over four days: with a slice in several files, the first file's watermark passed the others' records."""
    from changelake.plans import fixtures, streams
    sf = tempfile.mkdtemp(dir="/tmp")
    spark.range(400).select(F.col("id").alias("event_id"), F.timestamp_micros(F.col("id") * 864000000).alias("ts"),
                            (F.col("id") % 9).alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.5).alias("value"),
                            F.lit('{"k":1}').alias("props")).write.parquet(f"{sf}/events.parquet")
    want = fixtures.good(spark, sf).select("pk", "lsn", "timestamp").distinct().collect()
    assert len(want) > 300
    for text in (streams.FILE_TEXT, 4000):
        monkeypatch.setattr(streams, "FILE_TEXT", text)
        got = streams.stream_dedup_keyed_q(spark, sf).select("pk", "lsn", "event_time").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want)), text
