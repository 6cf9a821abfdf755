"""Spark-side inputs every query builds on: the test tables and the change
logs derived from them (see ``changelake.sources.testlog``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.operators.decode import decode, good_events
from changelake.operators.mapping import typed_fields
from changelake.session import read_table
from changelake.sources.testlog import EVENTS_RULE, events_changelog


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def events_log(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return events_changelog(table(spark, sf_dir, "events"), **kw)


def decoded(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return decode(events_log(spark, sf_dir, **kw))


def good(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return good_events(decoded(spark, sf_dir, **kw))


def typed_docs(docs: DataFrame, extra=()) -> DataFrame:
    """State rows of the events log -> typed columns by the events rule."""
    return docs.select("_id", "pk", *typed_fields("doc", EVENTS_RULE), "sourceLsn", "schemaVersion", *extra)


TYPED_DOC_COLS = "_id, pk, _pkId, eventType, amount, props, isActive, sourceLsn, schemaVersion"


SNAPSHOT_TS = "2024-02-01 00:00:00"


def orders_log(spark, sf_dir):
    from changelake.sources.changelog import snapshot_to_changelog
    return snapshot_to_changelog(table(spark, sf_dir, "orders"), "orders", "o_orderkey", lsn=1, ts=SNAPSHOT_TS)


def multi_table_log(spark, sf_dir):
    """Events log (cdc.users) + orders snapshot (cdc.orders) + lineitem snapshot (cdc.order_items)."""
    from changelake.sources.changelog import snapshot_to_changelog
    li = table(spark, sf_dir, "lineitem").withColumn("id", F.col("l_orderkey"))
    items = snapshot_to_changelog(li, "order_items", "id", lsn=1, ts=SNAPSHOT_TS)
    return events_log(spark, sf_dir).unionByName(orders_log(spark, sf_dir)).unionByName(items)


# Write-error messages of the derived sink error log, by props.k % 3.
ERROR_MESSAGES = ("context deadline exceeded", "connection reset by peer", "write conflict")


def error_log(spark, sf_dir):
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    k = F.get_json_object("props", "$.k").cast("bigint")
    msg = F.when(k % 3 == 0, F.lit(ERROR_MESSAGES[0])).when(k % 3 == 1, F.lit(ERROR_MESSAGES[1])) \
           .otherwise(F.lit(ERROR_MESSAGES[2]))
    return ev.select("event_id", F.col("ts").cast("timestamp").alias("ts"), msg.alias("message"))


def orders_next(spark, sf_dir):
    from changelake.sources.testlog import orders_next_snapshot
    return orders_next_snapshot(table(spark, sf_dir, "orders"))


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def orders_diff_events(spark, sf_dir):
    """Decoded change events between the two orders snapshots (LSN 2)."""
    from changelake.operators.decode import decode, good_events
    from changelake.sources.changelog import diff_to_changelog
    log = diff_to_changelog(table(spark, sf_dir, "orders"), orders_next(spark, sf_dir), "o_orderkey",
                            lsn=2, table="orders", ts=SNAPSHOT_TS)
    return good_events(decode(log))
