"""Sort, limit and sample operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def peek(df: DataFrame, n: int, by: list[str], order: list[str]) -> DataFrame:
    """L1: the first ``n`` records per group. ``row_number() <= n`` lets Spark insert a
    partial per-group limit before the shuffle, so a hot group ships at most n rows per task."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def first_row(df: DataFrame, key: str) -> DataFrame:
    """L2: the row with the smallest key (top-1, no full sort)."""
    return df.orderBy(key).limit(1)


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """L3: random sample of a fraction of rows (Bernoulli per row)."""
    return df.sample(fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, key: str, percent: int) -> DataFrame:
    """L3, deterministic twin: keys whose md5 bucket (of 100) is below ``percent``."""
    h = F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(100))
    return df.filter(h < percent)


def topics(df: DataFrame) -> DataFrame:
    """Topic list with record counts, sorted."""
    return df.groupBy("topic").agg(F.count("*").alias("n")).orderBy("topic")


def pick_row(df: DataFrame, key: str, percent: int) -> DataFrame:
    """L2 + L3: one row from a key-hash sample, or the smallest-key row when the sample is
    empty — one plan: sample rows rank before the fallback, then top-1."""
    sampled = hash_sample(df, key, percent).withColumn("_prio", F.lit(0))
    fallback = first_row(df, key).withColumn("_prio", F.lit(1))
    return sampled.unionByName(fallback).orderBy("_prio", key).limit(1).drop("_prio")
