"""$set merge of partial images against a Python model, whole and split in two batches."""

from hypothesis import given, settings
from hypothesis import strategies as st

from changelake.operators import gate

FIELDS = ["a", "b", "c"]


def model(events, stored=None):
    """events: (pk, lsn, op, off, image dict). stored: {pk: (lsn, deleted, doc)}."""
    stored = stored or {}
    out = dict(stored)
    for pk in sorted({e[0] for e in events}):
        evs = sorted([e for e in events if e[0] == pk], key=lambda e: e[3])
        s_lsn, s_del, s_doc = stored.get(pk, (None, None, None))
        bar = s_lsn
        applied = []
        for e in evs:
            if bar is None or e[1] > bar:
                applied.append(e)
            bar = e[1] if bar is None else max(bar, e[1])
        if not applied:
            continue
        dels = [e[1] for e in applied if e[2] == "d"]
        last_del = max(dels) if dels else None
        win = max(applied, key=lambda e: e[1])
        if win[2] == "d":
            out[pk] = (win[1], True, None)
            continue
        doc = dict(s_doc) if (last_del is None and s_doc is not None and not s_del) else {}
        for e in sorted(applied, key=lambda e: e[1]):
            if e[2] != "d" and (last_del is None or e[1] > last_del):
                doc.update(e[4])
        out[pk] = (win[1], False, doc)
    return out


def _df(spark, events):
    rows = [("users", str(pk), lsn, op, 0, off, None if op == "d" else img, 0)
            for pk, lsn, op, off, img in events]
    return spark.createDataFrame(rows, "table string, pk string, lsn long, op string, partition int, offset long, "
                                       "after map<string,string>, ts_ms long")


def _as_dict(df):
    return {int(r["pk"]): (r["sourceLsn"], r["_deleted"], dict(r["doc"]) if r["doc"] is not None else None)
            for r in df.collect()}


image = st.dictionaries(st.sampled_from(FIELDS), st.one_of(st.none(), st.sampled_from(["x", "y", "z"])),
                        max_size=3)
logs = st.lists(st.tuples(st.integers(0, 3), st.integers(1, 20), st.sampled_from(["c", "u", "u", "d"]), image),
                min_size=1, max_size=20)


@settings(max_examples=10, deadline=None)
@given(logs, st.integers(0, 20))
def test_merge_set_model_and_batch_split(spark, raw, cut):
    events = [(pk, lsn, op, i, img) for i, (pk, lsn, op, img) in enumerate(raw)]
    want = model(events)
    assert _as_dict(gate.merge_set(_df(spark, events), block_size=4)) == want
    a, b = events[:cut], events[cut:]
    first = gate.merge_set(_df(spark, a)) if a else None
    if not b:
        got = _as_dict(first)
    elif first is None:
        got = _as_dict(gate.merge_set(_df(spark, b)))
    else:
        got = _as_dict(gate.merge_set(_df(spark, b), first))
    assert got == want


def model_lww(events):
    """Per-field LWW: (pk) -> (lsn, deleted, doc) from the set of events."""
    out = {}
    for pk in sorted({e[0] for e in events}):
        evs = [e for e in events if e[0] == pk]
        win = max(evs, key=lambda e: (e[1], -e[3]))
        dels = [e[1] for e in evs if e[2] == "d"]
        d = max(dels) if dels else None
        doc = {}
        for f in FIELDS:
            cands = [e for e in evs if e[2] != "d" and f in e[4]]
            if cands:
                b = max(cands, key=lambda e: (e[1], -e[3]))
                if d is None or b[1] > d:
                    doc[f] = b[4][f]
        out[pk] = (win[1], win[2] == "d", None if win[2] == "d" else doc)
    return out


@settings(max_examples=10, deadline=None)
@given(logs, st.integers(0, 20), st.randoms())
def test_merge_lww_order_free_and_batch_split(spark, raw, cut, rnd):
    events = [(pk, lsn, op, i, img) for i, (pk, lsn, op, img) in enumerate(raw)]
    want = model_lww(events)
    assert _as_dict(gate.merge_lww(_df(spark, events))) == want
    # any delivery order with the same positions, cut into two batches through stored state
    shuffled = list(events)
    rnd.shuffle(shuffled)
    a, b = shuffled[:cut], shuffled[cut:]
    if a and b:
        got = _as_dict(gate.merge_lww(_df(spark, b), gate.merge_lww(_df(spark, a))))
    else:
        got = _as_dict(gate.merge_lww(_df(spark, a or b)))
    assert got == want
