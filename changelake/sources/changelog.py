"""Change-log sources and sinks.

A change log is a DataFrame with the record columns of a Kafka source
(``topic, partition, offset, timestamp, key, value``). It can come from
Kafka when its package is on the class path, or from files of the same
schema, batch or streaming; from a table snapshot (every row an ``r``
event); or from two versions of a table (a full outer join).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.functions.scalar import table_of
from changelake.schemas import CHANGELOG_SCHEMA


def kafka_options(servers: str, pattern: str, stream: bool = False, starting_offsets: str | None = None,
                  ending_offsets: str | None = None, max_offsets_per_trigger: int | None = None,
                  offset_range: dict | None = None) -> dict[str, str]:
    """Options of a Kafka source. ``offset_range`` ({(topic, partition): (start, end)}, a bounded
    read) becomes start and end offsets of exactly these partitions."""
    opts = {"kafka.bootstrap.servers": servers}
    if offset_range:
        if stream:
            raise ValueError("offset_range is for bounded reads; a stream has no end")
        parts: dict[str, list[int]] = {}
        ends: list[dict] = [{}, {}]
        for (topic, partition), bounds in sorted(offset_range.items()):
            parts.setdefault(topic, []).append(partition)
            for side, offset in zip(ends, bounds):
                side.setdefault(topic, {})[str(partition)] = offset
        return opts | {"assign": json.dumps(parts), "startingOffsets": json.dumps(ends[0]), "endingOffsets": json.dumps(ends[1])}
    opts["subscribePattern"] = pattern
    if starting_offsets:
        opts["startingOffsets"] = starting_offsets
    if ending_offsets:
        if stream:
            raise ValueError("a stream has no ending_offsets")
        opts["endingOffsets"] = ending_offsets
    if max_offsets_per_trigger:                          # T5: bounded batch size
        if not stream:
            raise ValueError("max_offsets_per_trigger is for streams")
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def read_changelog(spark: SparkSession, path_or_servers: str, pattern: str = ".*",
                   stream: bool = False, fmt: str = "parquet", starting_offsets: str | None = None,
                   ending_offsets: str | None = None, max_files_per_trigger: int | None = None,
                   offset_range: tuple[int, int] | dict | None = None, tables=None,
                   max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Every topic matching ``pattern`` as one log (stream or bounded).

    ``fmt="kafka"`` subscribes by pattern (needs the Kafka package); other
    formats read change-log files and keep the matching topics. ``tables`` and
    ``offset_range`` hold for both. A range [start, end) of offsets is one for all partitions, or
    {(topic, partition): (start, end)}, which reads no other partition; a stream with a range
    is an error.
    """
    if offset_range is not None and stream:
        raise ValueError("offset_range is for bounded reads; a stream has no end")
    if fmt == "kafka":
        if max_files_per_trigger:
            raise ValueError("max_files_per_trigger counts files; a Kafka source has none")
        r = (spark.readStream if stream else spark.read).format("kafka")
        for name, value in kafka_options(path_or_servers, pattern, stream, starting_offsets, ending_offsets, max_offsets_per_trigger,
                                         offset_range if isinstance(offset_range, dict) else None).items():
            r = r.option(name, value)
        df = r.load().select("topic", "partition", "offset", "timestamp",
                             F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    else:
        r = (spark.readStream if stream else spark.read).schema(CHANGELOG_SCHEMA).format(fmt)
        if stream and max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))   # T5: bounded batch size
        df = r.load(path_or_servers)
    if tables is not None:
        # a log published per table (``write_changelog``) is pruned by directory
        col = F.col("table") if "table" in df.columns else table_of("topic")
        df = df.filter(col.isin(*tables))
    if fmt != "kafka" and pattern not in (".*", ".+"):
        df = df.filter(F.col("topic").rlike(f"^(?:{pattern})$"))
    if isinstance(offset_range, dict):            # S2: a bounded slice [start, end) of each partition
        keep = F.lit(False)
        for (topic, partition), (start, end) in offset_range.items():
            keep = keep | ((F.col("topic") == topic) & (F.col("partition") == partition)
                           & (F.col("offset") >= start) & (F.col("offset") < end))
        df = df.filter(keep)
    elif offset_range is not None:                # one slice for all
        df = df.filter((F.col("offset") >= offset_range[0]) & (F.col("offset") < offset_range[1]))
    return spread(df) if stream and fmt != "kafka" else df


def spread(log: DataFrame) -> DataFrame:
    """A stream's records dealt evenly over the cluster's cores by their position. A batch of few
    files, each of one row group, would else be parsed by as many tasks."""
    return log.repartition(log.sparkSession.sparkContext.defaultParallelism, "topic", "partition", "offset")


def only_tables(df: DataFrame, names, topic_col: str = "topic") -> DataFrame:
    """Keep the records of an include-list of tables."""
    return df.filter(table_of(topic_col).isin(*names))


def _envelope(before: Column, after: Column, lsn: Column, table: str, op: Column, ts_ms: Column) -> Column:
    payload = F.struct(before.alias("before"), after.alias("after"),
                       F.struct(lsn.alias("lsn"), F.lit(table).alias("table"), ts_ms.alias("ts_ms")).alias("source"),
                       op.alias("op"), ts_ms.alias("ts_ms"))
    return F.to_json(F.struct(F.create_map().cast("map<string,string>").alias("schema"), payload.alias("payload")))


def _key(pk: Column) -> Column:
    return F.to_json(F.struct(F.create_map().cast("map<string,string>").alias("schema"),
                              F.struct(pk.alias("id")).alias("payload")))


def _key_of(row: str | None, pk: str | list[str]) -> Column:
    """A record's key: ``id`` for one key column, each column under its name for several."""
    col = lambda c: F.col(f"{row}.{c}" if row else c)
    if isinstance(pk, str):
        return _key(col(pk))
    return F.to_json(F.struct(F.create_map().cast("map<string,string>").alias("schema"),
                              F.struct(*[col(c).alias(c) for c in pk]).alias("payload")))


def _place(row: str | None, pk: str | list[str], partitions: int) -> tuple[Column, Column]:
    """(partition, offset) of a derived record; equal keys share both."""
    cols = [F.col(f"{row}.{c}" if row else c) for c in ([pk] if isinstance(pk, str) else pk)]
    offset = cols[0].cast("long") if isinstance(pk, str) else F.xxhash64(*cols).bitwiseAND((1 << 62) - 1)
    return F.pmod(F.xxhash64(*cols), F.lit(partitions)).cast("int"), offset


def snapshot_to_changelog(df: DataFrame, table: str, pk: str | list[str], lsn: int, topic_prefix: str = "cdc",
                          partitions: int = 6, ts=None) -> DataFrame:
    """S3: a table snapshot as ``r`` records at one LSN; image = all columns. ``pk``: the key
    column, or several."""
    partition, offset = _place(None, pk, partitions)
    cols = [c for c in df.columns]
    image = F.struct(*[F.col(c) for c in cols])
    ts_col = F.lit(ts).cast("timestamp") if ts is not None else F.current_timestamp()
    ts_ms = F.unix_millis(ts_col)
    return df.select(
        F.lit(f"{topic_prefix}.{table}").alias("topic"),
        partition.alias("partition"),
        offset.alias("offset"),
        ts_col.alias("timestamp"),
        _key_of(None, pk).alias("key"),
        _envelope(F.lit(None).cast("map<string,string>"), image,
                  F.lit(lsn).cast("long"), table, F.lit("r"), ts_ms).alias("value"))


def diff_to_changelog(old: DataFrame, new: DataFrame, pk: str | list[str], lsn: int, table: str,
                      topic_prefix: str = "cdc", partitions: int = 6, ts=None) -> DataFrame:
    """Two versions of a table -> ``c``/``u``/``d`` records with before/after images.

    One full outer join on the key; a row is updated when any column differs
    (null-safe). Unchanged rows emit nothing. ``pk``: the key column, or several.
    """
    keys = [pk] if isinstance(pk, str) else pk
    cols = [c for c in new.columns if c not in keys]
    key = F.struct(*[F.col(c) for c in keys])
    o = old.select(key.alias("_k"), F.struct(*[F.col(c) for c in old.columns]).alias("_o"))
    n = new.select(key.alias("_k"), F.struct(*[F.col(c) for c in new.columns]).alias("_n"))
    j = o.join(n, "_k", "full_outer")
    partition, offset = _place("_k", pk, partitions)
    changed = None
    for c in cols:
        cond = ~F.col(f"_o.{c}").eqNullSafe(F.col(f"_n.{c}"))
        changed = cond if changed is None else (changed | cond)
    op = (F.when(F.col("_o").isNull(), F.lit("c"))
           .when(F.col("_n").isNull(), F.lit("d"))
           .when(changed, F.lit("u")))
    j = j.withColumn("_op", op).filter(F.col("_op").isNotNull())
    ts_col = F.lit(ts).cast("timestamp") if ts is not None else F.current_timestamp()
    ts_ms = F.unix_millis(ts_col)
    return j.select(
        F.lit(f"{topic_prefix}.{table}").alias("topic"),
        partition.alias("partition"),
        offset.alias("offset"),
        ts_col.alias("timestamp"),
        _key_of("_k", pk).alias("key"),
        _envelope(F.col("_o"), F.col("_n"), F.lit(lsn).cast("long"), table, F.col("_op"), ts_ms).alias("value"))


def write_changelog(df: DataFrame, base: str, mode: str = "overwrite") -> None:
    """Publish a (mapped) change log, one directory per table."""
    df.withColumn("table", table_of("topic")).write.mode(mode).partitionBy("table").parquet(base)


def replay_from(events: DataFrame, lsn) -> DataFrame:
    """The part of a decoded log at or after an LSN (re-applied through the gate)."""
    return events.filter(F.col("lsn") >= F.lit(lsn))
