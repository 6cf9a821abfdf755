"""The mapping stage as a running stream (S6, T1): change log in, mapped change log out.

Mapping is a projection of each record, so the stream needs no state: records go through
``map_changelog`` and are appended by Spark's own file sink, one directory per table. The
sink's log lists the files of each committed batch, and batch and streaming readers of the
directory follow it: a batch that dies is run again with the same records, its half-written
files are never listed, and every record is published once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changelake.functions.scalar import table_of
from changelake.operators.mapping import emit_filter, map_changelog
from changelake.rules import Rule
from changelake.sources.changelog import read_changelog


def publish(log: DataFrame, rules: dict[str, Rule], lookup_only: bool = True) -> DataFrame:
    """Mapped records with ``table``, the directory they go to. ``lookup_only``: also those of
    tables whose rule says that they are looked up and not written."""
    mapped = map_changelog(log, rules).withColumn("table", table_of("topic"))
    return mapped if lookup_only else emit_filter(mapped, rules)


def stream_map(spark: SparkSession, source: str, out: str, checkpoint: str, rules: dict[str, Rule], fmt: str = "parquet",
               pattern: str = ".*", max_files_per_trigger: int | None = None, available_now: bool = True):
    """Start the mapping stream from ``source`` to the Parquet log ``out``; returns the query."""
    log = read_changelog(spark, source, pattern=pattern, stream=True, fmt=fmt, max_files_per_trigger=max_files_per_trigger)
    writer = publish(log, rules).writeStream.format("parquet").partitionBy("table") \
        .option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    return writer.start(out)
