"""State store: batches, replays, crashes between state and side outputs, vacuum."""

import tempfile

import pytest
from conftest import envelope, key, log_df

from changelake.sources.state_store import StateStore
from changelake.streaming.apply import apply_batch


def _log(spark, steps, start=0):
    return log_df(spark, [("cdc.users", 0, start + i, key(pk), envelope(op, lsn, after=after))
                          for i, (pk, lsn, op, after) in enumerate(steps)])


def _live(store):
    return {r["_id"]: (r["sourceLsn"], dict(r["doc"])) for r in store.current().collect()}


B1 = [(1, 100, "c", {"id": 1, "email": "a"}), (2, 100, "c", {"id": 2, "email": "b"}),
      (3, 100, "c", {"id": 3, "email": "c"})]
B2 = [(1, 200, "u", {"id": 1, "email": "a2"}), (2, 300, "d", None), (3, 50, "u", {"id": 3, "email": "stale"})]


def test_two_batches_and_replay(spark):
    store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=4)
    apply_batch(store, _log(spark, B1), 0)
    apply_batch(store, _log(spark, B2, 10), 1)
    want = {"users:1": (200, {"id": "1", "email": "a2"}), "users:3": (100, {"id": "3", "email": "c"})}
    assert _live(store) == want
    # the same batch id re-run (redelivery) and an older log replayed as a new batch change nothing
    apply_batch(store, _log(spark, B2, 10), 1)
    apply_batch(store, _log(spark, B1 + B2), 2)
    assert _live(store) == want
    # an older version stays readable
    assert set(_live_v(store, 0)) == {"users:1", "users:2", "users:3"}


def _live_v(store, v):
    return {r["_id"] for r in store.current(version=v).collect()}


def test_crash_after_state_then_rerun(spark):
    store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=4)
    apply_batch(store, _log(spark, B1), 0)
    with pytest.raises(RuntimeError):
        apply_batch(store, _log(spark, B2, 10), 1, fail_after_state=True)
    apply_batch(store, _log(spark, B2, 10), 1)     # the stream re-runs the batch with the same id
    assert set(_live(store)) == {"users:1", "users:3"}
    assert store.read_side("checkpoints").filter("batch = 1").count() == 1


def test_dead_letters_written_per_batch(spark):
    store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=4)
    log = log_df(spark, [("cdc.users", 0, 1, key(1), "{not json"),
                         ("cdc.users", 0, 2, key(2), envelope("c", 1, after={"id": 2}))])
    apply_batch(store, log, 0)
    apply_batch(store, log, 0)   # re-run overwrites, does not double
    dlq = store.read_side("dlq").collect()
    assert [(r["source_offset"], r["error_reason"]) for r in dlq] == [(1, "bad_json")]
    assert set(_live(store)) == {"users:2"}


def test_vacuum_drops_old_markers(spark):
    store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=4)
    apply_batch(store, _log(spark, B1 + B2), 0)
    assert store.read().filter("_deleted").count() == 1
    store.vacuum(horizon_lsn=1000)
    assert store.read().filter("_deleted").count() == 0
    assert set(_live(store)) == {"users:1", "users:3"}


def test_apply_with_rules_renames_and_skips_lookup_only(spark):
    from changelake.rules import DEFAULT_RULES
    store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=4)
    log = log_df(spark, [
        ("cdc.users", 0, 1, key(1), envelope("c", 1, after={"id": 1, "full_name": "Ann"}, table="users")),
        ("cdc.order_items", 0, 2, key(5), envelope("c", 1, after={"id": 5, "sku": "s"}, table="order_items")),
        ("cdc.orders", 0, 3, key(7), envelope("c", 1, after={"id": 7, "user_id": 1}, table="orders"))])
    apply_batch(store, log, 0, rules=DEFAULT_RULES)
    live = {r["_id"]: (dict(r["doc"]), r["schemaVersion"]) for r in store.current().collect()}
    assert live == {"users:1": ({"_pkId": "1", "fullName": "Ann"}, 1),
                    "orders:7": ({"_pkId": "7", "userId": "1"}, 1)}


def test_set_mode_merges_partial_images_across_batches(spark):
    store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=4)
    b1 = [(1, 1, "c", {"id": 1, "a": "x", "b": "y"}), (2, 1, "c", {"id": 2, "a": "p"})]
    b2 = [(1, 2, "u", {"id": 1, "b": "z"}), (1, 1, "u", {"id": 1, "a": "stale"}), (2, 3, "d", None),
          (2, 2, "u", {"id": 2, "a": "late"})]
    apply_batch(store, _log(spark, b1), 0, mode="set")
    apply_batch(store, _log(spark, b2, 10), 1, mode="set")
    assert _live(store) == {"users:1": (2, {"id": "1", "a": "x", "b": "z"})}
    apply_batch(store, _log(spark, b2, 10), 1, mode="set")      # re-run of the same batch id
    assert _live(store) == {"users:1": (2, {"id": "1", "a": "x", "b": "z"})}


def test_cast_failures_go_to_dlq_with_rules(spark):
    from changelake.rules import DEFAULT_RULES
    store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=4)
    log = log_df(spark, [
        ("cdc.orders", 0, 1, key(7), envelope("c", 1, after={"id": 7, "user_id": "not-a-number"}, table="orders")),
        ("cdc.orders", 0, 2, key(8), envelope("c", 1, after={"id": 8, "user_id": 3}, table="orders"))])
    apply_batch(store, log, 0, rules=DEFAULT_RULES)
    assert set(_live(store)) == {"orders:8"}
    assert [(r["source_offset"], r["error_reason"]) for r in store.read_side("dlq").collect()] == [(1, "bad_cast")]


def test_vacuum_can_empty_a_bucket(spark):
    store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=2)
    apply_batch(store, _log(spark, [(1, 1, "c", {"id": 1}), (1, 2, "d", None)]), 0)
    store.vacuum(horizon_lsn=100)
    assert store.read().count() == 0 and store.current().count() == 0
    apply_batch(store, _log(spark, [(1, 5, "c", {"id": 1, "v": "again"})], 10), 2)
    assert _live(store) == {"users:1": (5, {"id": "1", "v": "again"})}


def _step(pk, lsn, op="c", **doc):
    return (pk, lsn, op, {"id": pk, **doc} if op != "d" else None)


def test_a_writer_that_starts_anew_loses_nothing(spark):
    store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=4)
    for batch in range(3):
        apply_batch(store, _log(spark, [_step(batch + 1, 10)], batch), batch, writer="one")
    for batch in range(3):     # batch ids begin again
        apply_batch(store, _log(spark, [_step(batch + 4, 10)], 10 + batch), batch, writer="two")
    assert set(_live(store)) == {f"users:{i}" for i in range(1, 7)}
    apply_batch(store, _log(spark, [_step(9, 10)], 20), 1)          # no writer: a hand-numbered batch
    assert len(_live(store)) == 7


def test_vacuum_between_batches_of_a_stream(spark):
    store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=4)
    apply_batch(store, _log(spark, B1 + B2), 0, writer="s")
    for _ in range(3):
        store.vacuum(horizon_lsn=1000)
    apply_batch(store, _log(spark, [_step(7, 10)], 10), 1, writer="s")
    assert store.read().filter("_deleted").count() == 0             # the vacuum is not undone
    assert set(_live(store)) == {"users:1", "users:3", "users:7"}   # and the batch is not hidden


def test_a_committed_batch_is_recognised(spark):
    store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=4)
    with pytest.raises(RuntimeError):
        apply_batch(store, _log(spark, B1), 0, writer="s", fail_after_state=True)
    before = store.versions()
    apply_batch(store, _log(spark, B1), 0, writer="s")
    assert store.versions() == before and store.read_side("checkpoints").count() == 1
    # dead letters and checkpoints of another writer's batch 0 stand beside
    apply_batch(store, _log(spark, B1), 0, writer="t")
    assert store.read_side("checkpoints").count() == 2


def test_an_attempt_without_commit_is_invisible(spark, monkeypatch):
    store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=4)
    apply_batch(store, _log(spark, B1), 0)
    want = _live(store)
    monkeypatch.setattr(store, "_commit", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        apply_batch(store, _log(spark, B2, 10), 1)
    monkeypatch.undo()
    assert _live(store) == want
    apply_batch(store, _log(spark, B2, 10), 1)
    assert set(_live(store)) == {"users:1", "users:3"}


def test_a_transform_can_empty_a_bucket(spark):
    store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=2)
    apply_batch(store, _log(spark, B1), 0, transform=lambda ev: ev.filter("pk = '1'"))
    assert set(_live(store)) == {"users:1"}


def test_set_mode_stamps_the_rule_version(spark):
    from dataclasses import replace

    from changelake.rules import DEFAULT_RULES
    rules = {t: replace(r, schema_version=3) if t == "users" else r for t, r in DEFAULT_RULES.items()}
    for mode in ("full", "set"):
        store = StateStore(spark, tempfile.mkdtemp(dir="/tmp"), buckets=2)
        apply_batch(store, _log(spark, B1), 0, rules=rules, mode=mode)
        assert {r["schemaVersion"] for r in store.current().collect()} == {3}


def test_lww_on_an_lsn_tie(spark):
    from changelake.operators.decode import decode, good_events
    from changelake.operators.gate import merge_lww
    ev = good_events(decode(_log(spark, [(1, 5, "u", {"id": 1, "a": "x"}), (1, 5, "d", None)])))
    (row,) = merge_lww(ev).collect()
    assert not row["_deleted"] and dict(row["doc"]) == {"id": "1", "a": "x"}
    (again,) = merge_lww(ev, merge_lww(ev)).collect()
    assert dict(again["doc"]) == {"id": "1", "a": "x"}
