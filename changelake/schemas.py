"""Schemas shared across the engine."""

from pyspark.sql import types as T

OPS = ("c", "u", "d", "r")

# Change-log record: the same columns a Kafka source gives, with text payloads.
CHANGELOG_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

# Change envelope. Row images are read as string maps: every JSON scalar keeps
# its exact text (numbers above 2^53 included), nested values stay JSON text,
# and an absent field stays distinct from an explicit null. Rules type them.
IMAGE_TYPE = "map<string,string>"
VALUE_SCHEMA = (
    "payload struct<before: map<string,string>, after: map<string,string>, "
    "source: struct<lsn: string, `table`: string, ts_ms: bigint>, op: string, ts_ms: bigint>, "
    "_corrupt string")
KEY_SCHEMA = "payload struct<id: string>, _corrupt string"
#: Keys of several columns, each number by its exact text.
COMPOSITE_KEY_SCHEMA = "payload map<string,string>, _corrupt string"
JSON_OPTS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
