"""Scalar column functions: routing, ids, stamping, rendering, WAL arithmetic.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def table_of(topic) -> Column:
    """``cdc.users`` -> ``users`` (text after the last dot)."""
    return F.substring_index(_c(topic), ".", -1)


def table_of_source(src) -> Column:
    """``public.users`` -> ``users``."""
    return F.substring_index(_c(src), ".", -1)


def target_topic(topic) -> Column:
    """``cdc.x`` -> ``transformed.x``; any other topic -> ``transformed.<topic>``."""
    t = _c(topic)
    return F.when(t.startswith("cdc."), F.concat(F.lit("transformed."), F.substring(t, 5, 1 << 30))) \
            .otherwise(F.concat(F.lit("transformed."), t))


def route(topic, regex: str, replacement: str) -> Column:
    """Regex topic router; topics that do not match whole are kept as is."""
    t = _c(topic)
    return F.when(t.rlike(f"^(?:{regex})$"), F.regexp_replace(t, f"^(?:{regex})$", replacement)).otherwise(t)


def doc_id(table, pk) -> Column:
    """Document id ``<table>:<pk>``."""
    return F.concat(_c(table), F.lit(":"), _c(pk))


def write_action(op) -> Column:
    """``d`` deletes, every other op upserts."""
    return F.when(_c(op) == "d", F.lit("delete")).otherwise(F.lit("upsert"))


def classify_error(msg) -> Column:
    """First match wins: context, connection, else other."""
    m = _c(msg)
    return (F.when(m.contains("context"), F.lit("context"))
             .when(m.contains("connection"), F.lit("connection"))
             .otherwise(F.lit("other")))


def iso8601(ts) -> Column:
    """ISO-8601 rendering with milliseconds and offset (session zone)."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")


def row_text(*cols: str) -> Column:
    """Engine-neutral row text that no two different rows share: each value as text after its
    length and a colon, nulls as ``-``."""
    def one(c):
        text = F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.concat(*map(one, cols))


def row_json(*cols: str) -> Column:
    """Row as JSON text over the named columns (in the given order)."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def build_json(**fields) -> Column:
    """JSON object text from named column expressions."""
    return F.to_json(F.struct(*[_c(v).alias(k) for k, v in fields.items()]))


def epoch_seconds(ts) -> Column:
    """P20: seconds since the epoch."""
    return F.unix_timestamp(_c(ts))


def lsn_to_long(lsn_text) -> Column:
    """``X/Y`` WAL position text -> 64-bit byte position (X high word, Y low word)."""
    t = _c(lsn_text)
    hi = F.conv(F.substring_index(t, "/", 1), 16, 10).cast("decimal(20,0)")
    lo = F.conv(F.substring_index(t, "/", -1), 16, 10).cast("decimal(20,0)")
    return (hi * F.lit(4294967296) + lo).cast("decimal(20,0)")


def lsn_diff(current, restart) -> Column:
    """Bytes between two WAL positions (``pg_wal_lsn_diff``)."""
    return (lsn_to_long(current) - lsn_to_long(restart)).cast("decimal(20,0)")


def size_pretty(nbytes) -> Column:
    """Readable size like ``pg_size_pretty``: bytes, kB, MB, GB, TB with 1024 steps.

    A unit is used once the value reaches 10240 of the one below; halves round up.
    """
    b = _c(nbytes).cast("decimal(38,0)")
    def scaled(p):
        return F.round(b / F.lit(1024 ** p), 0).cast("decimal(38,0)").cast("string")
    lim = 10 * 1024
    return (F.when(F.abs(b) < lim, F.concat(b.cast("string"), F.lit(" bytes")))
             .when(F.abs(b) < lim * 1024, F.concat(scaled(1), F.lit(" kB")))
             .when(F.abs(b) < lim * 1024 ** 2, F.concat(scaled(2), F.lit(" MB")))
             .when(F.abs(b) < lim * 1024 ** 3, F.concat(scaled(3), F.lit(" GB")))
             .otherwise(F.concat(scaled(4), F.lit(" TB"))))


def md5_number(text, start: int = 1) -> Column:
    """15 hex digits of md5 from place ``start`` as a non-negative number (order-free digest term)."""
    return F.conv(F.substring(F.md5(_c(text)), start, 15), 16, 10).cast("decimal(38,0)")
