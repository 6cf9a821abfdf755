"""Retention of change-log records by topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_flag(log: DataFrame, policies: dict[str, int | None], now: Column, compacted: tuple[str, ...] = ()) -> DataFrame:
    """``log`` with ``keep``: whether a record outlives the retention of its topic.

    ``policies``: days by topic family (the text before the first dot); None, or a family that
    is not named, keeps all. Of a topic in ``compacted`` the newest record of each key (highest
    offset of its partition) is kept whatever its age, unless it is a tombstone, as log
    compaction does; the newest are found by an aggregate (map-side) and joined back."""
    horizon = F.lit(None).cast("timestamp")
    for family, days in policies.items():
        if days is not None:
            horizon = F.when(F.substring_index("topic", ".", 1) == family, now - F.expr(f"INTERVAL {int(days)} DAYS")).otherwise(horizon)
    fresh = horizon.isNull() | (F.col("timestamp") >= horizon)
    if not compacted:
        return log.withColumn("keep", F.coalesce(fresh, F.lit(True)))
    newest = log.where(F.col("topic").isin(*compacted)).groupBy("topic", "partition", "key") \
        .agg(F.max("offset").alias("offset")).withColumn("_newest", F.lit(True))
    marked = log.join(newest.withColumnRenamed("key", "_key"), (log["topic"] == newest["topic"]) & (log["partition"] == newest["partition"])
                      & (log["offset"] == newest["offset"]) & log["key"].eqNullSafe(F.col("_key")), "left") \
        .select(log["*"], "_newest")
    last = F.col("_newest") & F.col("value").isNotNull()
    return marked.withColumn("keep", F.coalesce(fresh, F.lit(True)) | F.coalesce(last, F.lit(False))).drop("_newest")


def retain(log: DataFrame, policies: dict[str, int | None], now: Column, compacted: tuple[str, ...] = ()) -> DataFrame:
    """The records that retention keeps."""
    return keep_flag(log, policies, now, compacted).where("keep").drop("keep")
