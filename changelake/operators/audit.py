"""Audits of logs and tables.

Ordered per-key checks use the blocked scans of ``functions.scan`` so one hot
key does not end up in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.functions.scan import DEFAULT_BLOCK, lag_by_key
from changelake.operators.mapping import SPARK_TYPES, cast_value
from changelake.rules import Rule


def constraint_counts(df: DataFrame, table: str, checks: dict[str, Column]) -> DataFrame:
    """F8: one row per named check with the number of rows violating it (one scan)."""
    aggs = [F.count_if(~F.coalesce(cond, F.lit(False))).alias(name) for name, cond in checks.items()]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{n}', `{n}`" for n in checks)
    return wide.selectExpr(f"stack({len(checks)}, {stack}) AS (check_name, violations)") \
               .select(F.lit(table).alias("table_name"), "check_name", F.col("violations").cast("bigint"))


def rule_checks(rule: Rule, image, required=(), at_least: dict | None = None) -> dict[str, Column]:
    """F8: the checks that a rule and a table's constraints imply for a map image, by name:
    ``<field>_type`` (its text converts), ``<field>_enum``, ``<field>_not_null`` for ``required``
    fields and ``<field>_min`` for bounds of ``at_least``. Only a required field may not be null."""
    img = F.col(image) if isinstance(image, str) else image
    get = lambda n: F.try_element_at(img, F.lit(n))
    checks = {}
    for n, f in rule.fields.items():
        value = F.try_parse_json(get(n)) if f.embed else cast_value(get(n), f.type)
        if f.embed or SPARK_TYPES.get(f.type, "string") != "string":
            checks[f"{n}_type"] = get(n).isNull() | value.isNotNull()
        if f.enum:
            checks[f"{n}_enum"] = get(n).isNull() | get(n).isin(*f.enum)
        if n in required:
            checks[f"{n}_not_null"] = get(n).isNotNull()
        if n in (at_least or {}):
            checks[f"{n}_min"] = value.isNull() | (value >= at_least[n])
    return checks


def unique_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """F8: values of ``cols`` that occur more than once, with their count."""
    return df.groupBy(*cols).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def order_violations(events: DataFrame, keys=("table", "pk"), pos: str = "offset",
                     block_size: int | None = DEFAULT_BLOCK) -> DataFrame:
    """Deliveries whose LSN is below the previous delivery's LSN for the key."""
    d = lag_by_key(events, list(keys), pos, ["lsn"], "prev_", block_size)
    return d.filter(F.col("prev_lsn") > F.col("lsn"))


def partition_violations(events: DataFrame, keys=("table", "pk")) -> DataFrame:
    """Keys whose records arrive on more than one partition."""
    return (events.groupBy(*keys).agg(F.count_distinct("partition").alias("n_partitions"))
            .filter(F.col("n_partitions") > 1))


def checkpoint_monotonic(ck: DataFrame, keys=("table", "partition"), pos: str = "batch",
                         value: str = "max_lsn") -> DataFrame:
    """Per key, whether the checkpointed value never goes down across batches."""
    d = lag_by_key(ck, list(keys), pos, [value], "prev_", None)
    return d.groupBy(*keys).agg(
        F.bool_and(F.col("prev_" + value).isNull() | (F.col("prev_" + value) <= F.col(value))).alias("monotonic"),
        F.count("*").alias("batches"))


def changed_fields(before, after) -> Column:
    """Sorted names of fields whose value differs between two map images
    (a field missing on one side counts as changed); null when an image is null."""
    b = F.col(before) if isinstance(before, str) else before
    a = F.col(after) if isinstance(after, str) else after
    keys = F.array_sort(F.array_distinct(F.concat(F.map_keys(b), F.map_keys(a))))
    diff = F.filter(keys, lambda k: ~(F.try_element_at(b, k).eqNullSafe(F.try_element_at(a, k))
                                      & F.map_contains_key(b, k) & F.map_contains_key(a, k))
                    | ~(F.map_contains_key(b, k) & F.map_contains_key(a, k)))
    return F.when(b.isNull() | a.isNull(), F.lit(None)).otherwise(diff)


def image_digest(img) -> Column:
    """Order-free text of a map image (sorted entries) for equality checks."""
    i = F.col(img) if isinstance(img, str) else img
    return F.to_json(F.array_sort(F.map_entries(i)))


def chain_violations(events: DataFrame, keys=("table", "pk"), pos: str = "offset",
                     block_size: int | None = DEFAULT_BLOCK, full_images: bool = False) -> DataFrame:
    """updates/deletes whose before image differs from the previous after image of the key;
    with ``full_images`` (the source promises before images) also those without one although
    the key has a previous after image."""
    d = events.withColumn("_after_d", image_digest("after"))
    d = lag_by_key(d, list(keys), pos, ["_after_d"], "prev", block_size)
    broken = F.col("before").isNotNull() & ~image_digest("before").eqNullSafe(F.col("prev_after_d"))
    if full_images:
        broken = broken | (F.col("before").isNull() & F.col("prev_after_d").isNotNull())
    return d.filter(F.col("op").isin("u", "d") & broken) \
            .drop("_after_d", "prev_after_d")
