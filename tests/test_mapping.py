"""Mapping rules: the reference's mapper cases plus rule loading and typing."""

import json

import pytest
from conftest import envelope, key, log_df
from pyspark.sql import functions as F

from changelake.functions import scalar as S
from changelake.operators.decode import decode, good_events
from changelake.operators.mapping import apply_rule, cast_fields, default_fields, render_formats
from changelake.rules import ORDERS_RULE, USERS_RULE, Rule, FieldRule, load_rules, rule_to_dict


def _ev(spark, topic, op, after, before=None):
    recs = [(topic, 0, 1, key(1), envelope(op, 100, after=after, before=before,
                                            table=topic.rsplit(".", 1)[-1]))]
    return good_events(decode(log_df(spark, recs)))


def test_rename_both_images(spark):
    rule = Rule(source="public.users", target="users",
                fields={"full_name": FieldRule(target="fullName"), "created_at": FieldRule(target="createdAt")})
    ev = _ev(spark, "cdc.users", "u", {"id": 1, "full_name": "New", "email": "a@b.c", "created_at": "2026-01-01"},
             before={"id": 1, "full_name": "Old"})
    r = apply_rule(ev, {"users": rule}).first()
    assert dict(r["after"]) == {"id": "1", "fullName": "New", "email": "a@b.c", "createdAt": "2026-01-01"}
    assert dict(r["before"]) == {"id": "1", "fullName": "Old"}


def test_no_rule_passthrough(spark):
    ev = _ev(spark, "cdc.orders", "c", {"id": 1, "full_name": "X"})
    r = apply_rule(ev, {"users": USERS_RULE}).first()
    assert dict(r["after"]) == {"id": "1", "full_name": "X"}


def test_null_images_stay_null(spark):
    ev = _ev(spark, "cdc.users", "d", None)
    r = apply_rule(ev, {"users": USERS_RULE}).first()
    assert r["after"] is None and r["before"] is None


def test_cast_defaults_and_errors(spark):
    ev = _ev(spark, "cdc.orders", "c", {"id": 7, "user_id": "x1", "status": "paid", "total_cents": 1250,
                                        "created_at": "2024-01-02T03:04:05.678Z"})
    r = cast_fields(ev, ORDERS_RULE).first()
    assert r["_pkId"] == 7 and r["userId"] is None and r["totalCents"] == 1250
    assert r["cast_error"] == ["user_id"]
    assert str(r["createdAt"]) == "2024-01-02 03:04:05.678000"
    u = _ev(spark, "cdc.users", "c", {"id": 1, "email": "a@b.c"})
    d = u.select(default_fields("after", USERS_RULE).alias("a")).first()["a"]
    assert d["is_active"] == "true"
    typed = cast_fields(u, USERS_RULE).first()
    assert typed["isActive"] is True


def test_iso8601_rendering(spark):
    df = spark.createDataFrame([(1,)], "x int").select(F.to_timestamp(F.lit("2024-01-02 03:04:05.678")).alias("createdAt"))
    assert render_formats(df, ORDERS_RULE).first()["createdAt"] == "2024-01-02T03:04:05.678Z"


def test_topic_functions(spark):
    df = spark.createDataFrame([("cdc.users",), ("other",), ("src.public.orders",)], "t string")
    r = df.select(S.table_of("t").alias("a"), S.target_topic("t").alias("b"),
                  S.route("t", r"src\.public\.(.*)", "cdc.$1").alias("c")).collect()
    assert [tuple(x) for x in r] == [("users", "transformed.users", "cdc.users"),
                                     ("other", "transformed.other", "other"),
                                     ("orders", "transformed.src.public.orders", "cdc.orders")]


def test_classify_error(spark):
    df = spark.createDataFrame([("context deadline exceeded",), ("connection refused",), ("boom",),
                                ("context connection",)], "m string")
    assert [r[0] for r in df.select(S.classify_error("m")).collect()] == ["context", "connection", "other", "context"]


def test_wal_distance_and_size(spark):
    df = spark.createDataFrame([("0/3000060", "0/3000000"), ("1/0", "0/FFFFFFFF"), ("16/0", "0/0")], "c string, r string")
    r = df.select(S.lsn_diff("c", "r").alias("d")).select("d", S.size_pretty("d").alias("p")).collect()
    assert [(int(x[0]), x[1]) for x in r] == [(96, "96 bytes"), (1, "1 bytes"), (94489280512, "88 GB")]


def test_load_rules_round_trip(tmp_path):
    for r in (USERS_RULE, ORDERS_RULE):
        (tmp_path / f"{r.table}.json").write_text(json.dumps(rule_to_dict(r)))
    loaded = load_rules(str(tmp_path))
    assert loaded["users"].renames() == USERS_RULE.renames()
    assert loaded["orders"].joins[0].keys() == ("order_id", "id")
    (tmp_path / "bad.json").write_text(json.dumps({"source": "", "target": "x"}))
    with pytest.raises(ValueError):
        load_rules(str(tmp_path))


def test_rename_onto_existing_name_rejected():
    with pytest.raises(ValueError):
        Rule(source="public.t", target="t", fields={"a": FieldRule(target="b"), "b": FieldRule()}).validate()


def test_mapping_stage_keeps_envelope_types_and_foreign_records(spark):
    import json

    from conftest import key, log_df

    from changelake.operators.decode import decode
    from changelake.operators.mapping import map_changelog
    from changelake.rules import DEFAULT_RULES
    envelope = {"schema": {"x": [1, {"b": 2}]}, "payload": {
        "before": {"id": 1, "full_name": None}, "op": "u", "ts_ms": 3, "extra": {"k": [True]},
        "after": {"id": 1, "full_name": "Ann", "n": 1.5, "big": 9007199254740993, "t": True, "s": "1", "o": {"full_name": 2}},
        "source": {"lsn": 5, "table": "users", "ts_ms": 1}}}
    plain = [None, "", "null", "  null ", "{not json", "[1, 2]", '{"payload": 5}', '{ "a":1}', '{"payload": {"op":"c", "after":{"full_name": 1}, "source":{"table":"other"}}}']
    log = log_df(spark, [("cdc.users", 0, 0, key(1), json.dumps(envelope))] + [("cdc.users", 0, i + 1, "k", v) for i, v in enumerate(plain)]
                 + [("cdc.users", 0, 50, None, '{"payload":{"op":"d","before":{"full_name":"x"},"after":null}}'), ("elsewhere", 1, 51, "k", "{}")])
    rows = {r["offset"]: r for r in map_changelog(log, DEFAULT_RULES).collect()}
    want = json.loads(json.dumps(envelope))
    for image in ("before", "after"):
        old = want["payload"][image]
        want["payload"][image] = {{"id": "_pkId", "full_name": "fullName"}.get(k, k): v for k, v in old.items()}
    assert json.loads(rows[0]["value"]) == want and rows[0]["key"] == key(1) and rows[0]["topic"] == "transformed.users"
    assert [rows[i + 1]["value"] for i in range(len(plain))] == plain          # byte for byte
    assert json.loads(rows[50]["value"]) == {"payload": {"op": "d", "before": {"fullName": "x"}, "after": None}} and rows[50]["key"] is None
    assert rows[51]["topic"] == "transformed.elsewhere" and rows[51]["value"] == "{}"
    (again,) = decode(map_changelog(log, DEFAULT_RULES)).filter("offset = 0").collect()
    assert again["table"] == "users" and again["lsn"] == 5 and again["after"]["big"] == "9007199254740993"


def test_rule_files_are_never_skipped(tmp_path):
    import pytest

    from changelake.rules import load_rules
    (tmp_path / "a.json").write_text('{"source": "public.users", "target": "users", "fields": {}}')
    assert list(load_rules(str(tmp_path))) == ["users"]
    (tmp_path / "b.json").write_text('{"source": "other.users", "target": "people", "fields": {}}')
    with pytest.raises(ValueError, match="another rule"):
        load_rules(str(tmp_path))
    (tmp_path / "b.json").write_text('{"source": "public.orders", "target": "orders", "fields": {}}')
    (tmp_path / "c.yml").write_text("source: public.items\ntarget: items\nfields: {}\n")
    try:
        import yaml  # noqa: F401
    except ImportError:
        with pytest.raises(ValueError, match="yaml"):
            load_rules(str(tmp_path))
    else:
        assert len(load_rules(str(tmp_path))) == 3


def test_shaped_images_and_upgraded_documents(spark):
    from changelake.operators.mapping import enum_errors, shape_image, typed_documents, upgrade_documents
    from changelake.plans.typed import V1, V2
    image = {"id": "007", "status": "P", "total_cents": "00012", "created_at": "1700000000123", "meta": '{"b": 1, "a": [1.50]}', "extra": "x"}
    df = spark.createDataFrame([(image,), (None,), ({"id": "1", "is_open": None, "status": None},)], "after map<string,string>")
    shaped = [r[0] for r in df.select(shape_image("after", V1)).collect()]
    assert shaped == [{"_pkId": "7", "status": "P", "totalCents": "12", "createdAt": "2023-11-14T22:13:20.123Z",
                       "meta": '{"a":[1.5],"b":1}', "extra": "x", "isOpen": "true"}, None, {"_pkId": "1", "isOpen": None, "status": None}]
    partial = [r[0] for r in df.select(shape_image("after", V1, F.lit(False))).collect()]
    assert "isOpen" not in partial[0]
    assert [r[0] for r in df.select(enum_errors("after", V1)).collect()] == [["status"], [], []]
    docs = spark.createDataFrame([("orders:7", "orders", "7", 1, 1, shaped[0]), ("orders:8", "orders", "8", 1, 2, {"_pkId": "8", "total": "5", "channel": "app"})],
                                 "_id string, table string, pk string, sourceLsn long, schemaVersion int, doc map<string,string>")
    up = typed_documents(upgrade_documents(docs, {"orders": [V1, V2]}), V2).orderBy("pk").collect()
    assert [(r["_pkId"], r.total, r.channel, r.isOpen, r.schemaVersion) for r in up] == [(7, 12, "web", True, 1), (8, 5, "app", True, 2)]
