import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from changelake.session import get_spark
    s = get_spark("local[4]", app="changelake-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s


def envelope(op, lsn, after=None, before=None, table="users", ts_ms=123, raw_lsn=None):
    """A change envelope as JSON text (``raw_lsn`` is spliced in verbatim)."""
    import json
    payload = {"before": before, "after": after,
               "source": {"lsn": "__LSN__", "table": table, "ts_ms": ts_ms}, "op": op, "ts_ms": 456}
    text = json.dumps({"schema": {}, "payload": payload})
    return text.replace('"__LSN__"', raw_lsn if raw_lsn is not None else str(lsn))


def key(pk):
    return '{"schema":{},"payload":{"id":%s}}' % pk


def log_df(spark, records):
    """records: (topic, partition, offset, key, value)."""
    import datetime as dt
    rows = [(t, p, o, dt.datetime(2024, 1, 1), k, v) for t, p, o, k, v in records]
    from changelake.schemas import CHANGELOG_SCHEMA
    return spark.createDataFrame(rows, CHANGELOG_SCHEMA)
