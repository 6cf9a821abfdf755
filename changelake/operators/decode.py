"""Strict decoding of change records into normalized events.

One parse per record: ``from_json`` in permissive mode with a corrupt-record
column, so malformed input is detected without a second parse. Every record
gets an ``error_reason`` (null when good); good rows and dead letters are two
filters of the same decode, never an exception that blocks the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.functions.scalar import table_of
from changelake.schemas import COMPOSITE_KEY_SCHEMA, JSON_OPTS, KEY_SCHEMA, OPS, VALUE_SCHEMA
from changelake.session import prepare

INT_TOKEN = r"^-?[0-9]+$"
NUMBER_TOKEN = r"^-?[0-9]+([.][0-9]+)?([eE][+-]?[0-9]+)?$"
WS = " \t\n\r"


def is_tombstone(value) -> Column:
    """value null, empty, or the text ``null`` with white space around it. White space
    alone is not JSON and is rejected as such."""
    v = F.col(value) if isinstance(value, str) else value
    return v.isNull() | (v == "") | (F.btrim(v, F.lit(WS)) == "null")


def valid_lsn(lsn_text) -> Column:
    """an integer token (quoted digits accepted) that fits 64 bits."""
    t = F.col(lsn_text) if isinstance(lsn_text, str) else lsn_text
    return F.coalesce(t.rlike(INT_TOKEN) & t.try_cast("bigint").isNotNull(), F.lit(False))


def valid_pk(pk_text) -> Column:
    """a non-empty number token."""
    t = F.col(pk_text) if isinstance(pk_text, str) else pk_text
    return F.coalesce(t.rlike(NUMBER_TOKEN), F.lit(False))


def valid_after(op, after) -> Column:
    """every op except delete needs an after image."""
    o = F.col(op) if isinstance(op, str) else op
    a = F.col(after) if isinstance(after, str) else after
    return (o == "d") | a.isNotNull()


def composite_pk(payload: Column, columns) -> Column:
    """a key of several number columns as one text, its parts in the given order between bars
    (number tokens hold none, so no two keys share a text); null unless all are valid."""
    parts = [F.try_element_at(payload, F.lit(c)) for c in columns]
    ok = valid_pk(parts[0])
    for part in parts[1:]:
        ok = ok & valid_pk(part)
    return F.when(ok, F.concat_ws("|", *parts))


def decode(log: DataFrame, max_value_bytes: int | None = None, keys: dict[str, list[str]] | None = None) -> DataFrame:
    """Change records -> normalized events with ``error_reason``.

    ``keys``: key columns of the tables whose key is not the one column ``id``.

    Output: topic, partition, offset, timestamp, table, pk, lsn, op, before,
    after, source_ts_ms, ts_ms, error_reason, key, value. Reasons, first match
    wins: tombstone, oversize, bad_json, bad_key, bad_lsn, bad_pk,
    after_missing, bad_op.
    """
    # duplicate keys inside an image keep the last value (JSON object semantics), times are UTC
    prepare(log.sparkSession)
    v = F.from_json(F.col("value"), VALUE_SCHEMA, JSON_OPTS)
    k = F.from_json(F.col("key"), COMPOSITE_KEY_SCHEMA if keys else KEY_SCHEMA, JSON_OPTS)
    # The parsed structs come out of a one-row generator: a filter on the decode result
    # (e.g. ``error_reason IS NULL``) cannot be pushed below it, so Catalyst never
    # inlines ``from_json`` into each branch of the reason CASE — one parse per record.
    d = log.select("topic", "partition", "offset", "timestamp", "key", "value",
                   F.inline(F.array(F.struct(v.alias("_v"), k.alias("_k")))))
    p = F.col("_v.payload")
    lsn_txt = p["source"]["lsn"]
    op = p["op"]
    after = p["after"]
    table = F.coalesce(p["source"]["table"], table_of("topic"))
    pk = F.col("_k.payload.id")
    if keys:
        pk = F.when(valid_pk(F.try_element_at("_k.payload", F.lit("id"))), F.try_element_at("_k.payload", F.lit("id")))
        for name, columns in keys.items():
            pk = F.when(table == name, composite_pk(F.col("_k.payload"), columns)).otherwise(pk)
    reason = F.when(is_tombstone("value"), F.lit("tombstone"))
    if max_value_bytes is not None:
        reason = reason.when(F.octet_length("value") > max_value_bytes, F.lit("oversize"))
    reason = (reason
              .when(F.col("_v._corrupt").isNotNull() | F.col("_v").isNull(), F.lit("bad_json"))
              .when(F.col("_k._corrupt").isNotNull(), F.lit("bad_key"))
              .when(~valid_lsn(lsn_txt), F.lit("bad_lsn"))
              .when(pk.isNull() if keys else ~valid_pk(pk), F.lit("bad_pk"))
              .when(~F.coalesce(valid_after(op, after), F.lit(False)), F.lit("after_missing"))
              .when(~F.coalesce(op.isin(*OPS), F.lit(False)), F.lit("bad_op")))
    return d.select(
        "topic", "partition", "offset", "timestamp",
        table.alias("table"),
        pk.alias("pk"),
        lsn_txt.try_cast("bigint").alias("lsn"),
        op.alias("op"),
        p["before"].alias("before"),
        after.alias("after"),
        p["source"]["ts_ms"].alias("source_ts_ms"),
        p["ts_ms"].alias("ts_ms"),
        reason.alias("error_reason"),
        "key", "value")


EVENT_COLS = ["topic", "partition", "offset", "timestamp", "table", "pk", "lsn", "op",
              "before", "after", "source_ts_ms", "ts_ms"]


def good_events(decoded: DataFrame) -> DataFrame:
    """Decoded rows that passed every check, without raw payloads."""
    return decoded.filter(F.col("error_reason").isNull()).select(*EVENT_COLS)


def dead_letters(decoded: DataFrame) -> DataFrame:
    """Rejected rows with their raw key/value and error headers (tombstones excluded)."""
    return decoded.filter(F.col("error_reason").isNotNull() & (F.col("error_reason") != "tombstone")) \
        .select("key", "value", "error_reason",
                F.col("topic").alias("source_topic"), F.col("partition").alias("source_partition"),
                F.col("offset").alias("source_offset"), F.col("timestamp").alias("ts"))


def dlq_to_log(dlq: DataFrame) -> DataFrame:
    """Dead letters back in change-record shape (their original position kept)."""
    return dlq.select(F.col("source_topic").alias("topic"), F.col("source_partition").alias("partition"),
                      F.col("source_offset").alias("offset"), F.col("ts").alias("timestamp"), "key", "value")


def reprocess_dlq(dlq: DataFrame, fix=None, max_value_bytes: int | None = None) -> DataFrame:
    """Dead letters back through the same decode after an optional fix of key/value."""
    log = dlq_to_log(dlq)
    if fix is not None:
        log = fix(log)
    return decode(log, max_value_bytes)
