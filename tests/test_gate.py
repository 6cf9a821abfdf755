"""LSN gate: the reference's six-step ordering case, our added cases, and
properties against a plain-Python model of the gate."""

import json

from conftest import envelope, key, log_df
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from changelake.functions.scan import lag_by_key, lead_by_key, prefix_max_before
from changelake.operators import gate
from changelake.operators.decode import decode, good_events


def _events(spark, steps):
    """steps: (pk, lsn, op, after dict or None); offsets in list order, partition 0."""
    recs = [("cdc.users", 0, i, key(pk), envelope(op, lsn, after=after))
            for i, (pk, lsn, op, after) in enumerate(steps)]
    return good_events(decode(log_df(spark, recs)))


def _state(df):
    return {r["_id"]: (r["sourceLsn"], r["_deleted"], dict(r["doc"]) if r["doc"] is not None else None)
            for r in df.collect()}


def test_six_step_ordering(spark):
    s1 = (1, 100, "c", {"id": 1, "email": "alice@a.b"})
    s3 = (1, 200, "u", {"id": 1, "email": "alice@updated.com"})
    s4 = (1, 150, "u", {"id": 1, "email": "STALE@wrong.com"})
    s5 = (1, 300, "d", None)
    s6 = (1, 400, "c", {"id": 1, "email": "alice-v2@a.b"})
    expect = [(100, "alice@a.b"), (100, "alice@a.b"), (200, "alice@updated.com"),
              (200, "alice@updated.com"), None, (400, "alice-v2@a.b")]
    steps = [s1, s1, s3, s4, s5, s6, s5]
    prefixes = [1, 2, 3, 4, 5, 7]
    for n, exp in zip(prefixes, expect):
        live = gate.current_state(_events(spark, steps[:n])).collect()
        if exp is None:
            assert live == []
        else:
            assert len(live) == 1
            assert (live[0]["sourceLsn"], live[0]["doc"]["email"]) == exp


def test_delete_then_stale_upsert_stays_deleted(spark):
    ev = _events(spark, [(1, 100, "c", {"id": 1}), (1, 300, "d", None), (1, 200, "u", {"id": 1})])
    assert gate.current_state(ev).count() == 0
    # the original sequential behaviour (no delete memory) resurrects the row
    f = gate.fold_reference(ev).collect()
    assert len(f) == 1 and f[0]["sourceLsn"] == 200


def test_equal_lsn_first_delivery_wins(spark):
    ev = _events(spark, [(1, 100, "c", {"id": 1, "v": "first"}), (1, 100, "u", {"id": 1, "v": "second"})])
    r = gate.current_state(ev).collect()[0]
    assert r["doc"]["v"] == "first"


def test_merge_set_partial_images_and_null(spark):
    ev = _events(spark, [(1, 1, "c", {"id": 1, "a": "x", "b": "y"}), (1, 2, "u", {"id": 1, "a": "z"}),
                         (1, 3, "u", {"id": 1, "b": None}), (2, 1, "c", {"id": 2, "a": "q"}),
                         (2, 2, "d", None), (2, 3, "c", {"id": 2, "b": "new"})])
    st_ = _state(gate.merge_set(ev))
    assert st_["users:1"] == (3, False, {"id": "1", "a": "z", "b": None})
    # after a delete only later images count
    assert st_["users:2"] == (3, False, {"id": "2", "b": "new"})


def test_merge_set_with_stored_state(spark):
    stored = gate.merge_set(_events(spark, [(1, 1, "c", {"id": 1, "a": "x", "b": "y"})]))
    batch = _events(spark, [(1, 2, "u", {"id": 1, "b": "w"}), (1, 1, "u", {"id": 1, "a": "stale"})])
    st_ = _state(gate.merge_set(batch, stored))
    assert st_["users:1"] == (2, False, {"id": "1", "a": "x", "b": "w"})


def test_classify_duplicate_and_stale(spark):
    ev = _events(spark, [(1, 5, "c", {"id": 1}), (1, 5, "c", {"id": 1}), (1, 3, "u", {"id": 1}), (1, 7, "u", {"id": 1})])
    got = [r["status"] for r in gate.classify_events(ev).orderBy("offset").collect()]
    assert got == ["applied", "duplicate", "stale", "applied"]


# ---------------------------------------------------------------------------
# properties against a Python model
# ---------------------------------------------------------------------------
def model_gate(events):
    """events: (pk, lsn, op, part, off). Winner per key: max (lsn, -part, -off)."""
    best = {}
    for pk, lsn, op, part, off in events:
        k = (lsn, -part, -off)
        if pk not in best or k > best[pk][0]:
            best[pk] = (k, op)
    return {pk: (k[0], op == "d") for pk, (k, op) in best.items()}


def _df(spark, events):
    rows = [("users", str(pk), lsn, op, part, off, None if op == "d" else {"id": str(pk), "v": str(lsn)}, 0)
            for pk, lsn, op, part, off in events]
    return spark.createDataFrame(rows, "table string, pk string, lsn long, op string, partition int, offset long, "
                                       "after map<string,string>, ts_ms long")


def _gate(spark, events):
    d = gate.to_documents(gate.compact(_df(spark, events)))
    return {int(r["pk"]): (r["sourceLsn"], r["_deleted"]) for r in d.collect()}


event_lists = st.lists(st.tuples(st.integers(0, 4), st.integers(1, 30), st.sampled_from(["c", "u", "d", "r"])),
                       min_size=1, max_size=25)


@settings(max_examples=12, deadline=None)
@given(event_lists)
def test_gate_matches_model_and_replays(spark, raw):
    events = [(pk, lsn, op, 0, i) for i, (pk, lsn, op) in enumerate(raw)]
    assert _gate(spark, events) == model_gate(events)
    # the whole log delivered again later changes nothing
    again = events + [(pk, lsn, op, 0, i + 1000) for pk, lsn, op, _, i in events]
    assert _gate(spark, again) == model_gate(events)


@settings(max_examples=8, deadline=None)
@given(event_lists, st.integers(1, 24))
def test_batch_split_invariance(spark, raw, cut):
    from changelake.operators.gate import gate_merge
    events = [(pk, lsn, op, 0, i) for i, (pk, lsn, op) in enumerate(raw)]
    a, b = events[:cut], events[cut:]
    first = gate.to_documents(gate.compact(_df(spark, a)))
    if b:
        merged = gate_merge(first, gate.to_documents(gate.compact(_df(spark, b))))
    else:
        merged = first
    got = {int(r["pk"]): (r["sourceLsn"], r["_deleted"]) for r in merged.collect()}
    assert got == model_gate(events)


def model_fold(events):
    """The original sequential apply, no delete memory, $set merge."""
    store = {}
    for pk, lsn, op, part, off in sorted(events, key=lambda e: (e[3], e[4])):
        cur = store.get(pk)
        if op == "d":
            if cur is not None and cur[0] < lsn:
                del store[pk]
        elif cur is None or cur[0] < lsn:
            doc = dict(cur[1]) if cur else {}
            doc.update({"id": str(pk), "v": str(lsn)})
            store[pk] = (lsn, doc)
    return {pk: v[0] for pk, v in store.items()}


@settings(max_examples=8, deadline=None)
@given(event_lists)
def test_fold_reference_matches_python_fold(spark, raw):
    events = [(pk, lsn, op, 0, i) for i, (pk, lsn, op) in enumerate(raw)]
    for bs in (None, 1, 3):   # one block per key, and histories cut into many blocks
        got = {int(r["pk"]): r["sourceLsn"] for r in gate.fold_reference(_df(spark, events), bs).collect()}
        assert got == model_fold(events)


def test_blocked_scans_equal_plain_windows(spark):
    import random
    rnd = random.Random(7)
    rows = [("t", str(rnd.randint(0, 2)), rnd.randint(1, 50), rnd.randint(0, 1), i) for i in range(300)]
    df = spark.createDataFrame(rows, "table string, pk string, lsn long, partition int, offset long")
    keys = ["table", "pk"]
    for bs in (3, 7, 64):
        a = prefix_max_before(df, keys, "offset", "lsn", "pm", group=["partition"], block_size=bs)
        b = prefix_max_before(df, keys, "offset", "lsn", "pm", group=["partition"], block_size=None)
        assert sorted(a.collect()) == sorted(b.collect())
        a = lag_by_key(df, keys, "offset", ["lsn"], block_size=bs)
        b = lag_by_key(df, keys, "offset", ["lsn"], block_size=None)
        assert sorted(a.collect()) == sorted(b.collect())
        a = lead_by_key(df, keys, "offset", ["lsn"], block_size=bs)
        b = lead_by_key(df, keys, "offset", ["lsn"], block_size=None)
        assert sorted(a.collect()) == sorted(b.collect())


def test_hot_key_classification_blocked(spark):
    # one key holds most rows: the blocked scan must give the same labels as a plain window
    rows = [("t", "hot" if i % 5 else str(i), (i * 7919) % 200, 0, i, None, 0) for i in range(2000)]
    df = spark.createDataFrame(rows, "table string, pk string, lsn long, partition int, offset long, "
                                     "op string, ts_ms long")
    a = gate.classify_events(df, block_size=16).select("offset", "status")
    b = gate.classify_events(df, block_size=None).select("offset", "status")
    assert sorted(a.collect()) == sorted(b.collect())
    assert json.dumps(sorted(a.collect())[:1])


def test_fold_reference_long_histories(spark):
    import random
    rnd = random.Random(11)
    events = [(rnd.randint(0, 2), rnd.randint(1, 400), rnd.choice("cudr" if i % 9 else "d"), 0, i)
              for i in range(1800)]
    want = model_fold(events)
    for bs in (7, 50, 100000):
        got = {int(r["pk"]): r["sourceLsn"] for r in gate.fold_reference(_df(spark, events), bs).collect()}
        assert got == want


def test_running_aggregates_equal_plain_windows(spark):
    import random

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from changelake.functions.scan import running
    rnd = random.Random(5)
    rows = [(k, m, rnd.randint(0, 9), rnd.choice([None, rnd.randint(0, 99)])) for k in ("a", "b") for m in range(200)]
    df = spark.createDataFrame(rows, "k string, m long, x long, y long")
    w = Window.partitionBy("k").orderBy("m").rowsBetween(Window.unboundedPreceding, 0)
    want = sorted(df.select("k", "m", F.sum("x").over(w).alias("s"), F.max("y").over(w).alias("mx")).collect())
    for bs in (1, 7, 64, 1000):
        got = running(df, ["k"], "m", {"s": ("sum", "x"), "mx": ("max", "y")}, bs).select("k", "m", "s", "mx")
        assert sorted(got.collect()) == want
    single = running(df.filter("k = 'a'"), [], "m", {"s": ("sum", "x")}, 13).select("m", "s")
    assert sorted(single.collect()) == sorted((r["m"], r["s"]) for r in want if r["k"] == "a")


def test_trailing_equals_plain_range_window(spark):
    import random

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from changelake.functions.scan import trailing
    rnd = random.Random(9)
    rows = [(k, m, rnd.randint(0, 5)) for k in ("a", "b") for m in sorted(rnd.sample(range(500), 150))]
    df = spark.createDataFrame(rows, "k string, m long, x long")
    for width, bs in ((1, 10), (5, 7), (60, 100), (11, 10)):
        w = Window.partitionBy("k").orderBy("m").rangeBetween(-(width - 1), 0)
        want = sorted(df.select("k", "m", F.sum("x").over(w).alias("s")).collect())
        got = sorted(trailing(df, ["k"], "m", {"s": ("sum", "x")}, width, bs).select("k", "m", "s").collect())
        assert got == want


def test_history_of_byte_positions_uses_few_blocks(spark):
    from changelake.operators.history import history
    ev = spark.range(2000).select(F.lit("t").alias("table"), F.lit("1").alias("pk"), (F.col("id") * 70_000).alias("lsn"),
                                  F.lit("u").alias("op"), F.create_map(F.lit("a"), F.col("id").cast("string")).alias("after"),
                                  F.lit(0).alias("partition"), F.col("id").alias("offset"))
    rows = history(ev, block_rows=100).orderBy("valid_from").collect()
    assert len(rows) == 2000 and all(r.valid_to == r.valid_from + 70_000 for r in rows[:-1])
    assert rows[-1].is_current and rows[5].after == {"a": "5"}


def test_history_cuts_long_keys_by_rank_whatever_the_gaps(spark):
    """One far outlier: with blocks by position nearly all rows of the key would share one."""
    from pyspark.sql import Window

    from changelake.functions.scan import in_ranges
    from changelake.operators.history import history
    pos = F.when(F.col("id") == 2999, F.lit(1 << 60)).otherwise(F.col("id") * 3)
    ev = spark.range(3000).select(F.lit("t").alias("table"), F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(99).cast("string").alias("pk"),
                                  pos.alias("lsn"), F.lit("u").alias("op"), F.create_map(F.lit("a"), F.col("id").cast("string")).alias("after"),
                                  F.lit(0).alias("partition"), F.col("id").alias("offset"))
    w = Window.partitionBy("table", "pk").orderBy("lsn")
    want = sorted(ev.select("pk", "lsn", F.lead("lsn").over(w).alias("n"), F.col("after")["a"].alias("a")).collect(), key=str)
    got = history(ev, block_rows=100).select("pk", F.col("valid_from").alias("lsn"), F.col("valid_to").alias("n"), F.col("after")["a"].alias("a"))
    assert sorted(got.collect(), key=str) == want
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        again = history(ev, block_rows=100).select("pk", F.col("valid_from").alias("lsn"), F.col("valid_to").alias("n"), F.col("after")["a"].alias("a"))
        assert sorted(again.collect(), key=str) == want
        hot = in_ranges(ev.where("pk = '99'"), ["table", "pk", "lsn"], "t")
        parts = [r.n for r in hot.groupBy("_rng").agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) == 8 and max(parts) < 3 * min(parts)


def test_fold_keeps_lsns_exact(spark):
    from changelake.operators.fold import fold_reference
    big = 9007199254740993
    ev = spark.createDataFrame([("t", "1", 0, 0, big - 2, "c", {"a": "x"}), ("t", "1", 0, 1, big, "u", {"a": "y"}), ("t", "2", 0, 2, 5, "d", None)],
                               "table string, pk string, partition int, offset long, lsn long, op string, after map<string,string>")
    (row,) = fold_reference(ev, block_size=1).collect()
    assert row["sourceLsn"] == big and row["doc"] == {"a": "y"}


def test_fold_composes_blocks_in_rounds(spark, monkeypatch):
    from changelake.operators import fold
    import random
    rnd = random.Random(21)
    events = [(rnd.choice([1, 1, 1, 2]), rnd.randint(1, 400), rnd.choice("cud"), 0, i) for i in range(700)]
    monkeypatch.setattr(fold, "FAN", 3)
    for bs in (5, 40):
        got = {int(r["pk"]): r["sourceLsn"] for r in gate.fold_reference(_df(spark, events), bs).collect()}
        assert got == model_fold(events)


def test_step_functions_compose():
    from changelake.operators import fold
    f = [(None, 5, False, 9, "a"), (5, 9, False, None, None), (9, None, True, None, None)]
    g = [(None, 7, False, 7, "b"), (7, 12, False, 12, "c"), (12, None, True, None, None)]
    whole = fold._then(f, g)
    for state in (None, 0, 4, 5, 6, 8, 9, 11, 12, 30):
        p = fold._at(f, state)
        middle, doc = (state, "own") if p[2] else p[3:]
        q = fold._at(g, middle)
        w = fold._at(whole, state)
        assert ((state, "own") if w[2] else w[3:]) == ((middle, doc) if q[2] else q[3:])


def test_fold_blocks_hold_events_not_offsets(spark, monkeypatch):
    """Keys whose events lie far apart in the log are cut into full blocks all the same."""
    from changelake.operators import fold
    blocks, real = [], fold.written

    def counted(df, purpose):
        out = real(df, purpose)
        if purpose == "fold-blocks":
            blocks.append(out.select("table", "pk", "_blk").distinct().count())
        return out
    monkeypatch.setattr(fold, "written", counted)
    events = [(pk, 10 * i + pk, "d" if i % 7 == 3 else "u", 0, 1000 * i + pk) for i in range(40) for pk in range(1, 6)]
    got = {int(r["pk"]): r["sourceLsn"] for r in gate.fold_reference(_df(spark, events), 16).collect()}
    assert got == model_fold(events)
    assert blocks[0] < 60     # 200 events of 5 keys in blocks of 16, a few more where ranges end
