"""Physical-plan properties the design relies on (guards against regressions)."""

import tempfile

from conftest import SF_SMALL, envelope, key, log_df

from changelake.operators.decode import decode, good_events
from changelake.operators.gate import DOC_INPUT, compact
from changelake.sources.state_store import StateStore, bucket_of, merge_parts


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _log(spark):
    return log_df(spark, [("cdc.users", 0, i, key(i), envelope("c", i, after={"id": i})) for i in range(3)])


def test_one_parse_per_record_even_when_filtered(spark):
    p = _plan(good_events(decode(_log(spark))))
    assert p.count("from_json(") == 2          # value and key, once each
    assert "Generate" in p


def test_compaction_is_partially_aggregated_before_one_shuffle(spark):
    p = _plan(compact(good_events(decode(_log(spark))), cols=DOC_INPUT))
    assert "partial_max_by" in p
    assert p.count("Exchange hashpartitioning") == 1


def test_peek_limits_groups_before_the_shuffle(spark):
    import __spark_entry__ as E
    df = E.queries()["peek"](spark, SF_SMALL)
    df.collect()
    assert "WindowGroupLimit" in _plan(df)


def test_state_merge_is_one_bucket_shuffle(spark):
    from changelake.operators.gate import to_documents
    docs = to_documents(compact(good_events(decode(_log(spark))), cols=DOC_INPUT)) \
        .withColumn("bucket", bucket_of("_id", 4))
    store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=4)
    p = _plan(merge_parts(store._dealt(store._empty().unionByName(docs), range(4))))
    assert p.count("Exchange shufflepartitionidpassthrough") == 1 and "hashpartitioning(bucket" not in p and "hashpartitioning(_part" not in p
    assert "SortMergeJoin" not in p
