"""The mapping stage as a stream, bounded replay, composite keys, retention."""

import datetime as dt
import json
import os

import pytest
from conftest import envelope, key, log_df
from pyspark.sql import functions as F

from changelake.operators.decode import decode, good_events
from changelake.operators.mapping import map_changelog
from changelake.operators.retention import retain
from changelake.rules import USERS_RULE
from changelake.sources.changelog import kafka_options, read_changelog
from changelake.streaming.mapped import stream_map

RULES = {"users": USERS_RULE}


def users(spark, lo, hi):
    return log_df(spark, [("cdc.users", 0, i, key(i), envelope("c", i, after={"id": i, "full_name": f"n{i}"})) for i in range(lo, hi)])


def test_killed_and_restarted_stream_publishes_each_record_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    users(spark, 1, 20).write.mode("append").parquet(src)
    stream_map(spark, src, out, ck, RULES).awaitTermination()
    users(spark, 20, 40).write.mode("append").parquet(src)
    stream_map(spark, src, out, ck, RULES).awaitTermination()
    # The last batch's files and sink log are there, but the stream died before it noted the batch.
    last = max((int(f) for f in os.listdir(f"{ck}/commits") if f.isdigit()))
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{ck}/commits/{name}"):
            os.rename(f"{ck}/commits/{name}", tmp_path / f"gone-{name}")
    users(spark, 40, 45).write.mode("append").parquet(src)
    stream_map(spark, src, out, ck, RULES).awaitTermination()
    rows = good_events(decode(read_changelog(spark, out, tables=["users"]))).collect()
    assert sorted(int(r.pk) for r in rows) == list(range(1, 45))
    assert all(r.after == {"_pkId": r.pk, "fullName": f"n{r.pk}"} and r.topic == "transformed.users" for r in rows)


def test_repeated_keys_numbers_and_rule_by_topic(spark):
    twice = envelope("c", 1, after={"id": 1}).replace('"after": {"id": 1}', '"after": {"full_name": "a", "id": 1, "full_name": "b"}')
    odd = envelope("c", 2, after={"id": 2}).replace('"id": 2', '"id": 2, "x": 1.10, "y": 1e2, "z": 12345678901234567890123456789012345678901234567')
    other = envelope("c", 3, after={"full_name": "c"}, table="users")
    rows = map_changelog(log_df(spark, [("cdc.users", 0, 1, key(1), twice), ("cdc.users", 0, 2, key(2), odd), ("cdc.orders", 0, 3, key(3), other)]), RULES) \
        .orderBy("offset").collect()
    assert json.loads(rows[0].value)["payload"]["after"] == {"_pkId": 1, "fullName": "b"}
    assert '"x":1.1,"y":100.0,"z":1.2345678901234568E46' in rows[1].value
    assert rows[2].value == other                      # the topic's table has no rule


def test_ranges_by_partition_and_kafka_options(spark, tmp_path):
    log = log_df(spark, [(t, p, o, key(1), "x") for t in ("cdc.a", "cdc.b") for p in (0, 1) for o in range(10)])
    log.write.parquet(str(tmp_path / "log"))
    ranges = {("cdc.a", 0): (2, 5), ("cdc.b", 1): (9, 20)}
    got = read_changelog(spark, str(tmp_path / "log"), offset_range=ranges).select("topic", "partition", "offset").collect()
    assert sorted(map(tuple, got)) == [("cdc.a", 0, 2), ("cdc.a", 0, 3), ("cdc.a", 0, 4), ("cdc.b", 1, 9)]
    with pytest.raises(ValueError):
        read_changelog(spark, str(tmp_path / "log"), stream=True, offset_range=(0, 5))
    opts = kafka_options("h:1", ".*", offset_range=ranges)
    assert json.loads(opts["assign"]) == {"cdc.a": [0], "cdc.b": [1]}
    assert json.loads(opts["startingOffsets"])["cdc.b"] == {"1": 9} and json.loads(opts["endingOffsets"])["cdc.a"] == {"0": 5}
    assert kafka_options("h:1", "cdc.*", stream=True, max_offsets_per_trigger=1000)["maxOffsetsPerTrigger"] == "1000"
    for bad in ({"stream": True, "offset_range": ranges}, {"max_offsets_per_trigger": 5}, {"stream": True, "ending_offsets": "latest"}):
        with pytest.raises(ValueError):
            kafka_options("h:1", ".*", **bad)


def test_composite_keys(spark):
    k = lambda text: '{"payload":%s}' % text
    ok = envelope("c", 1, after={"a": 1}, table="items")
    rows = decode(log_df(spark, [("cdc.items", 0, 1, k('{"o":12,"l":3}'), ok), ("cdc.items", 0, 2, k('{"o":1,"l":23}'), ok),
                                 ("cdc.items", 0, 3, k('{"o":1}'), ok), ("cdc.items", 0, 4, k('{"o":1,"l":"x"}'), ok),
                                 ("cdc.users", 0, 5, key(7), envelope("c", 1, after={"a": 1}))]), keys={"items": ["o", "l"]}).orderBy("offset").collect()
    assert [(r.pk, r.error_reason) for r in rows] == [("12|3", None), ("1|23", None), (None, "bad_pk"), (None, "bad_pk"), ("7", None)]


def test_retention_keeps_the_newest_record_of_a_key(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    rows = [("cdc.a", 0, 1, day(1), "x", "1"), ("cdc.a", 0, 2, day(2), "x", "2"), ("cdc.a", 0, 3, day(2), "y", None), ("cdc.a", 0, 4, day(9), "z", "1"),
            ("cdc.a", 0, 5, day(3), None, "n"), ("dlq.a", 0, 1, day(1), "x", "1"), ("other", 0, 1, day(1), "x", "1")]
    log = spark.createDataFrame(rows, "topic string, partition int, offset long, timestamp timestamp, key string, value string")
    now = F.lit(day(10)).cast("timestamp")
    kept = lambda **k: sorted((r.topic, r.offset) for r in retain(log, {"cdc": 3, "dlq": None}, now, **k).collect())
    assert kept() == [("cdc.a", 4), ("dlq.a", 1), ("other", 1)]
    assert kept(compacted=("cdc.a",)) == [("cdc.a", 2), ("cdc.a", 4), ("cdc.a", 5), ("dlq.a", 1), ("other", 1)]
