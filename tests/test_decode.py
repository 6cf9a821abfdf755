"""Decode: the reference's decoder cases plus our added edge cases."""

from conftest import envelope, key, log_df

from changelake.operators.decode import dead_letters, decode, good_events


def _decode(spark, recs, **kw):
    return {r["offset"]: r for r in decode(log_df(spark, recs), **kw).collect()}


def test_insert(spark):
    v = envelope("c", 1000, after={"id": 42, "email": "alice@example.com", "full_name": "Alice"})
    r = _decode(spark, [("cdc.users", 0, 1, key(42), v)])[1]
    assert r["error_reason"] is None
    assert (r["table"], r["pk"], r["lsn"], r["op"]) == ("users", "42", 1000, "c")
    assert r["before"] is None and r["after"]["email"] == "alice@example.com"
    assert r["source_ts_ms"] == 123 and r["ts_ms"] == 456


def test_tombstone_skipped_not_error(spark):
    recs = [("cdc.users", 0, i, key(42), v) for i, v in enumerate([None, "", "null", "  null\n"])]
    d = decode(log_df(spark, recs))
    assert [r["error_reason"] for r in d.orderBy("offset").collect()] == ["tombstone"] * 4
    assert good_events(d).count() == 0 and dead_letters(d).count() == 0


def test_delete_keeps_before(spark):
    v = envelope("d", 2000, after=None, before={"id": 42, "email": "a@b.c", "full_name": "A"})
    r = _decode(spark, [("cdc.users", 0, 1, key(42), v)])[1]
    assert r["error_reason"] is None and r["op"] == "d" and r["after"] is None
    assert r["before"]["email"] == "a@b.c"


def test_malformed_rejected(spark):
    r = _decode(spark, [("cdc.users", 0, 1, key(42), "{not json")])[1]
    assert r["error_reason"] == "bad_json"


def test_lsn_rules(spark):
    after = {"id": 1}
    cases = {1: (None, "77", None), 2: ("5.5", None, "bad_lsn"), 3: ('"77"', None, None),
             4: ('"abc"', None, "bad_lsn"), 5: ("99999999999999999999", None, "bad_lsn")}
    recs = []
    for off, (raw, _, _) in cases.items():
        recs.append(("cdc.users", 0, off, key(1), envelope("c", 77, after=after, raw_lsn=raw)))
    missing = '{"schema":{},"payload":{"after":{"id":1},"source":{"table":"users"},"op":"c"}}'
    recs.append(("cdc.users", 0, 6, key(1), missing))
    got = _decode(spark, recs)
    assert got[1]["error_reason"] is None and got[1]["lsn"] == 77
    assert got[2]["error_reason"] == "bad_lsn"
    assert got[3]["error_reason"] is None and got[3]["lsn"] == 77
    assert got[4]["error_reason"] == "bad_lsn"
    assert got[5]["error_reason"] == "bad_lsn"
    assert got[6]["error_reason"] == "bad_lsn"


def test_pk_rules_and_big_numbers(spark):
    v = envelope("c", 1, after={"id": 1})
    recs = [("cdc.users", 0, 1, '{"schema":{},"payload":{}}', v),
            ("cdc.users", 0, 2, '{"schema":{},"payload":{"id":"abc"}}', v),
            ("cdc.users", 0, 3, key("9007199254740993"), v),
            ("cdc.users", 0, 4, "{bad", v),
            ("cdc.users", 0, 5, None, v)]
    got = _decode(spark, recs)
    assert got[1]["error_reason"] == "bad_pk"
    assert got[2]["error_reason"] == "bad_pk"
    assert got[3]["error_reason"] is None and got[3]["pk"] == "9007199254740993"
    assert got[4]["error_reason"] == "bad_key"
    assert got[5]["error_reason"] == "bad_pk"


def test_after_required_and_unknown_op(spark):
    recs = [("cdc.users", 0, i, key(1), envelope(op, 1, after=None)) for i, op in enumerate(["c", "u", "r"])]
    recs.append(("cdc.users", 0, 3, key(1), envelope("t", 1, after={"id": 1})))
    recs.append(("cdc.users", 0, 4, key(1), '{"payload":{"after":{"id":1},"source":{"lsn":1}}}'))
    got = _decode(spark, recs)
    assert [got[i]["error_reason"] for i in range(3)] == ["after_missing"] * 3
    assert got[3]["error_reason"] == "bad_op"
    assert got[4]["error_reason"] == "bad_op"


def test_poison_does_not_block_good_rows(spark):
    big = envelope("c", 2, after={"id": 2, "profile": '{"blob":"%s"}' % ("x" * 1048576)})
    recs = [("cdc.users", 0, 1, key(1), envelope("c", 1, after={"id": 1})),
            ("cdc.users", 0, 2, key(2), big),
            ("cdc.users", 0, 3, key(3), envelope("c", 3, after={"id": 3}))]
    d = decode(log_df(spark, recs), max_value_bytes=1 << 20)
    assert sorted(r["pk"] for r in good_events(d).collect()) == ["1", "3"]
    dl = dead_letters(d).collect()
    assert [(r["source_offset"], r["error_reason"]) for r in dl] == [(2, "oversize")]
    # without a size limit the large value is a good row
    assert good_events(decode(log_df(spark, recs))).count() == 3


def test_nested_and_null_values_in_images(spark):
    v = ('{"payload":{"after":{"id":1,"profile":{"plan":"pro"},"tags":[1,2],"note":null},'
         '"source":{"lsn":1,"table":"users"},"op":"c"}}')
    r = _decode(spark, [("cdc.users", 0, 1, key(1), v)])[1]
    assert r["after"]["profile"] == '{"plan":"pro"}'
    assert r["after"]["tags"] == "[1,2]"
    assert "note" in r["after"] and r["after"]["note"] is None


def test_duplicate_json_keys_last_wins(spark):
    v = '{"payload":{"after":{"id":1,"a":"first","a":"second"},"source":{"lsn":1,"table":"users"},"op":"c"}}'
    r = _decode(spark, [("cdc.users", 0, 1, key(1), v)])[1]
    assert r["error_reason"] is None
    assert r["after"]["a"] == "second"


def test_heartbeat_like_record_is_rejected_not_fatal(spark):
    recs = [("__heartbeat.cdc", 0, 1, None, '{"ts_ms": 1}'),
            ("cdc.users", 0, 2, key(1), envelope("c", 1, after={"id": 1}))]
    got = _decode(spark, recs)
    assert got[1]["error_reason"] is not None and got[2]["error_reason"] is None


def test_tombstone_white_space(spark):
    from changelake.operators.decode import decode
    values = ["null", "null\n", "null  ", "\t null", "", None, "  ", "\n", "nullx", '"null"']
    log = log_df(spark, [("cdc.users", 0, i, key(1), v) for i, v in enumerate(values)])
    got = {r["offset"]: r["error_reason"] for r in decode(log).collect()}
    assert [got[i] for i in range(6)] == ["tombstone"] * 6
    assert [got[i] for i in range(6, 9)] == ["bad_json"] * 3 and got[9] != "tombstone"
