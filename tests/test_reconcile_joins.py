"""Reconciliation and joins on small hand-made frames."""

from pyspark.sql import functions as F

from changelake.operators import joins
from changelake.operators import reconcile as R

COLS = ["k", "a", "b"]


def _t(spark, rows):
    return spark.createDataFrame(rows, "k long, a string, b double")


def test_digest_is_order_free_and_detects_change(spark):
    rows = [(i, f"v{i}", i * 1.5) for i in range(50)]
    a = _t(spark, rows)
    b = _t(spark, list(reversed(rows))).repartition(7)
    da = {r["bucket"]: (r["n"], r["digest"]) for r in R.table_digest(a, "k", COLS, 4).collect()}
    db = {r["bucket"]: (r["n"], r["digest"]) for r in R.table_digest(b, "k", COLS, 4).collect()}
    assert da == db
    ok = R.integrity(a, b, "k", COLS, 4).first()
    assert ok["verdict"] == "INTEGRITY OK" and ok["src_count"] == 50
    changed = _t(spark, rows[:-1] + [(49, "other", 0.0)])
    assert R.integrity(a, changed, "k", COLS, 4).first()["verdict"] == "INTEGRITY FAILED"
    drift = {r["k"]: r["drift"] for r in R.drift(a, _t(spark, rows[1:] + [(99, "x", 1.0)]), "k", COLS).collect()}
    assert drift == {0: "missing", 99: "extra"}


def test_table_md5_matches_plain_python(spark):
    import hashlib
    rows = [(2, "b", None), (1, "a", 1.5), (15_000, "c", 2.0)]
    got = R.table_md5(_t(spark, rows), "k", COLS).first()

    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    ranges = [["1:11:a3:1.5", "1:21:b-"], ["5:150001:c3:2.0"]]
    assert got["md5"] == md5(",".join(md5(",".join(md5(t) for t in r)) for r in ranges)) and got["n"] == 3


def test_row_text_is_unambiguous(spark):
    a, b = _t(spark, [(1, "a|b", None), (2, "\\N", 1.0)]), _t(spark, [(1, "a", None), (2, None, 1.0)])
    assert sorted((r["k"], r["drift"]) for r in R.drift(a, b, "k", COLS).collect()) == [(1, "changed"), (2, "changed")]
    assert R.integrity(a, b, "k", COLS).first()["verdict"] == "INTEGRITY FAILED"


def test_embed_paged_keeps_every_child(spark):
    parents = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    kids = spark.createDataFrame([(1, i) for i in range(101)] + [(2, 0)], "pid long, x long")
    e = joins.embed_paged(parents, kids, "pid", "id", "items", ["x"], page_size=10)
    per = {r["id"]: r["n"] for r in e.groupBy("id").agg(F.sum(F.size("items")).alias("n")).collect()}
    assert per == {1: 101, 2: 1, 3: 0}
    assert e.filter("id = 1").select("page").distinct().count() > 5
    xs = sorted(x["x"] for r in e.filter("id = 1").collect() for x in r["items"])
    assert xs == list(range(101))


def test_upsert_by_keeps_id_and_other_columns(spark):
    t = spark.createDataFrame([(1, "a@x", "Ann", "old")], "id long, email string, name string, note string")
    n = spark.createDataFrame([(9, "a@x", "Anne", "new"), (8, "b@x", "Bob", "n2"), (10, "a@x", "Annie", "newer")],
                              "id long, email string, name string, note string")
    got = {r["email"]: tuple(r) for r in joins.upsert_by(t, n, "email", ["name"], "id").collect()}
    assert got["a@x"] == (1, "a@x", "Annie", "old")      # id and note kept, name set by the last row
    assert got["b@x"] == (8, "b@x", "Bob", "n2")


def test_insert_absent_first_row_wins(spark):
    t = spark.createDataFrame([(1, "keep")], "k long, v string")
    n = spark.createDataFrame([(1, "no"), (2, "second"), (2, "first")], "k long, v string") \
             .withColumn("o", F.when(F.col("v") == "first", 0).otherwise(1))
    got = sorted(tuple(r) for r in joins.insert_absent(t.withColumn("o", F.lit(0)), n, "k", "o").collect())
    assert got == [(1, "keep", 0), (2, "first", 0)]


def test_row_diff_multiset(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x long")
    b = spark.createDataFrame([(1,), (3,)], "x long")
    got = sorted(tuple(r) for r in R.row_diff(a, b).collect())
    assert got == [(1, "only_src"), (2, "only_src"), (3, "only_tgt")]


def test_merkle_trees_cut_alike_and_lead_to_the_difference(spark):
    rows = [(f"key {i * i % 9973}-{i}", i, f"v{i}") for i in range(2000)]
    make = lambda r: spark.createDataFrame(r, "k string, n long, v string")
    a = R.merkle_nodes(make(rows), ["k"], ["k", "n", "v"], fan=16, levels=2)
    b = R.merkle_nodes(make(list(reversed(rows))).repartition(13), ["k"], ["k", "n", "v"], fan=16, levels=2)
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    leaves = a.where("level = 1").collect()
    assert sum(r.n for r in leaves) == 2000 and 60 < len(leaves) < 250 and max(r.n for r in leaves) < 16 * 12
    changed = [r if r[1] != 777 else (r[0], r[1], "other") for r in rows] + [("new key", 1, "x")]
    c = R.merkle_nodes(make(changed), ["k"], ["k", "n", "v"], fan=16, levels=2)
    roots = [x.where("level = 3").first() for x in (a, c)]
    assert roots[0].node != roots[1].node and (roots[0].n, roots[1].n) == (2000, 2001)
    ranges = R.merkle_diff(a, c, 2).collect()
    assert 1 <= len(ranges) <= 4 and R.merkle_diff(a, b, 2).count() == 0
    # Composite keys, repeated keys and an empty table.
    pair = R.merkle_nodes(make(rows[:50] + rows[:1]), ["n", "k"], ["v"], fan=4, levels=1).where("level = 2").first()
    assert pair.n == 51
    assert R.merkle_nodes(make([]), ["k"], ["v"], levels=1).where("level = 2").first().n == 0


def test_cascade_follows_chains_and_cycles(spark):
    fk = joins.ForeignKey
    tables = {"a": spark.createDataFrame([(1, 5), (2, 1), (3, 2), (4, None)], "id long, up long"),
              "b": spark.createDataFrame([(10, 3), (11, 4), (12, 1)], "id long, a_id long"),
              "c": spark.createDataFrame([(100, 10, 1), (101, 11, 2)], "id long, b_id long, a_id long")}
    keys = [fk("a", "up", "a"), fk("b", "a_id", "a"), fk("c", "b_id", "b"), fk("c", "a_id", "a")]
    given = spark.createDataFrame([("a", "1", 70), ("a", "5", 90)], "table string, pk string, lsn long")
    got = {(r["table"], r.pk): (r.lsn, r.depth, r.before) for r in joins.cascade(given, tables, keys).collect()}
    # 5 -> 1 was given itself; 1 -> 2 -> 3 -> b10 -> c100 (already gone with 1); 101 went with a2
    assert got == {("a", "2"): (70, 1, {"id": "2", "up": "1"}), ("b", "12"): (70, 1, {"id": "12", "a_id": "1"}),
                   ("c", "100"): (70, 1, {"id": "100", "b_id": "10", "a_id": "1"}), ("a", "3"): (70, 2, {"id": "3", "up": "2"}),
                   ("c", "101"): (70, 2, {"id": "101", "b_id": "11", "a_id": "2"}), ("b", "10"): (70, 3, {"id": "10", "a_id": "3"})}
    assert joins.cascade(given.where("false"), tables, keys).count() == 0
