"""Change data derived from the test tables, by fixed, data-independent rules.

``events`` becomes the change log of a ``users`` table: the key is
``user_id``, the log position is ``event_id`` (dense, in time order) and the
event type decides the operation. Some events are made stale (an older log
sequence number delivered later), some are replayed at later offsets and a
few are poisoned, so that every path of decode and gate is exercised on the
whole table. The same rules are written in SQL for the DuckDB oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.functions.scan import lag_by_key
from changelake.rules import FieldRule, Rule

# ---------------------------------------------------------------------------
# Fixed values of the derivation (mirrored in plans.sql_fixtures).
# ---------------------------------------------------------------------------
EVENTS_TOPIC = "cdc.users"
EVENTS_TABLE = "users"
TOPIC_PARTITIONS = 6
OP_OF_EVENT = {"signup": "c", "view": "r", "click": "u", "purchase": "u", "error": "d"}
STALE_MOD, STALE_REM, STALE_SHIFT = 7, 3, 700     # lsn = event_id - 700 when event_id % 7 == 3 and event_id > 700
REPLAY_MOD = 10                                   # events with event_id % 10 == 0 are delivered twice
REPLAY_OFFSET = 1 << 40                           # ... the second time at offset event_id + 2^40
BAD_JSON_MOD = 97                                 # value is not JSON
BAD_LSN_MOD = 89                                  # lsn is 5.5
BAD_PK_MOD = 83                                   # key has no id
TOMBSTONE_MOD = 79                                # value is null
AFTER_MISSING_MOD = 73                            # a non-delete arrives without its after image
BAD_OP_MOD = 71                                   # op is "x"
LAG_MS_PER_UNIT = 100                             # payload.ts_ms = source.ts_ms + floor(value * 100)

# Mapping rule for the events-derived users log (our fixture, same style as
# the shipped rules): rename, cast, enum, JSON embed and a default.
EVENTS_RULE = Rule(
    source="public.users", target="users", schema_version=1, id_strategy="pk",
    fields={
        "id": FieldRule(type="bigint", target="_pkId"),
        "event_type": FieldRule(type="string", target="eventType",
                                enum=("signup", "view", "click", "purchase", "error")),
        "value": FieldRule(type="double", target="amount"),
        "props": FieldRule(type="jsonb", target="props", embed=True),
        "is_active": FieldRule(type="boolean", target="isActive", default=True),
    })


def event_op(event_type: Column) -> Column:
    e = event_type
    out = None
    for k, v in OP_OF_EVENT.items():
        out = (F.when(e == k, F.lit(v)) if out is None else out.when(e == k, F.lit(v)))
    return out.otherwise(F.lit("u"))


def event_lsn(event_id: Column) -> Column:
    return F.when((event_id % STALE_MOD == STALE_REM) & (event_id > STALE_SHIFT),
                  event_id - STALE_SHIFT).otherwise(event_id)


def events_changelog(events: DataFrame, replays: bool = True, poison: bool = True,
                     before_images: bool = True) -> DataFrame:
    """``events`` -> change-log records ``(topic, partition, offset, timestamp, key, value)``.

    ``before`` of an update or delete is the previous image of the same key
    in log order (full before images); creates and reads carry none.
    """
    eid = F.col("event_id")
    ev = events.select(
        eid, F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", "props",
        event_op(F.col("event_type")).alias("op"),
        event_lsn(eid).alias("lsn"))
    image = F.struct(F.col("user_id").alias("id"), "event_type", "value", "props")
    ev = ev.withColumn("image", image)
    if before_images:
        # previous image of the same key, by a blocked scan (a hot key is not sorted in one task)
        ev = lag_by_key(ev, ["user_id"], "event_id", ["image"], "prev_")
        ev = ev.withColumn("before", F.when(F.col("op").isin("u", "d"), F.col("prev_image"))).drop("prev_image")
    else:
        ev = ev.withColumn("before", F.lit(None).cast(ev.schema["image"].dataType))
    src_ms = F.unix_millis(F.col("ts"))
    after_ok = F.col("op") != "d"
    wire_op = F.col("op")
    if poison:
        after_ok = after_ok & (eid % AFTER_MISSING_MOD != 0)
        wire_op = F.when(eid % BAD_OP_MOD == 0, F.lit("x")).otherwise(F.col("op"))
    payload = F.struct(
        F.col("before"),
        F.when(after_ok, F.col("image")).alias("after"),
        F.struct(F.col("lsn"), F.lit(EVENTS_TABLE).alias("table"), src_ms.alias("ts_ms")).alias("source"),
        wire_op.alias("op"),
        (src_ms + F.floor(F.col("value") * LAG_MS_PER_UNIT)).alias("ts_ms"))
    value = F.to_json(F.struct(F.create_map().cast("map<string,string>").alias("schema"), payload.alias("payload")))
    key = F.to_json(F.struct(F.create_map().cast("map<string,string>").alias("schema"),
                             F.struct(F.col("user_id").alias("id")).alias("payload")))
    if poison:
        value = (F.when(eid % TOMBSTONE_MOD == 0, F.lit(None).cast("string"))
                  .when(eid % BAD_JSON_MOD == 0, F.lit("{not json"))
                  .when(eid % BAD_LSN_MOD == 0, F.regexp_replace(value, '"lsn":-?[0-9]+', '"lsn":5.5'))
                  .otherwise(value))
        key = F.when(eid % BAD_PK_MOD == 0, F.lit('{"schema":{},"payload":{}}')).otherwise(key)
    # replays: one pass that emits a second copy of every tenth record (no self-union,
    # which would compute the before-image window twice)
    copies = F.when(F.lit(replays) & (eid % REPLAY_MOD == 0), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    log = ev.select(
        F.lit(EVENTS_TOPIC).alias("topic"),
        F.pmod(F.col("user_id"), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        eid.alias("event_id"), F.explode(copies).alias("_copy"),
        F.col("ts").alias("timestamp"),
        key.alias("key"), value.alias("value"))
    return log.select("topic", "partition", (F.col("event_id") + F.col("_copy") * F.lit(REPLAY_OFFSET)).alias("offset"),
                      "timestamp", "key", "value")


def orders_next_snapshot(orders: DataFrame) -> DataFrame:
    """Second snapshot of ``orders``: drop keys % 11 == 0, change status of keys % 13 == 0
    (O->F, F->O, P->F), add 500 keys shifted past the largest one."""
    k = F.col("o_orderkey")
    kept = orders.filter(k % 11 != 0).withColumn(
        "o_orderstatus",
        F.when(k % 13 == 0, F.when(F.col("o_orderstatus") == "O", "F")
               .when(F.col("o_orderstatus") == "F", "O").otherwise("F"))
         .otherwise(F.col("o_orderstatus")))
    mx = orders.agg(F.max("o_orderkey")).first()[0]   # one number
    added = orders.filter(k < 500).withColumn("o_orderkey", k + F.lit(mx + 1))
    return kept.unionByName(added)
