"""Poisson replication: distribution, rates, order and edge cases."""

import math
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from changelake.llm import mixing


def poisson(rate, u):
    p = c = math.exp(-rate)
    k = 0
    while c <= u:
        k += 1
        p *= rate / k
        c += p
    return k


def test_counts_invert_the_distribution(spark):
    for rate in (0.01, 0.7, 3.0, 40.0, 600.0):
        df = spark.range(50).select((F.col("id") / 50 + 0.0051).alias("u"), F.lit(rate).alias("rate"))
        first, cdf = mixing._first_count(F.col("rate")), mixing.poisson_table(F.col("rate"))
        rows = df.select("u", (first + F.size(F.filter(cdf, lambda p: p <= F.col("u")))).alias("k")).collect()
        assert all(r.k == poisson(rate, r.u) for r in rows)


def test_large_rate_is_centred(spark):
    df = spark.range(2000).select(((F.col("id") + 0.5) / 2000).alias("u"), F.lit(50_000.0).alias("rate"))
    rate = F.col("rate")
    table = df.limit(1).select(mixing._first_count(rate).alias("f"), mixing.poisson_table(rate).alias("c")).first()
    counts = [table.f + sum(p <= (i + 0.5) / 200 for p in table.c) for i in range(200)]
    mean = sum(counts) / 200
    assert abs(mean - 50_000) < 5 and abs(sum((c - mean) ** 2 for c in counts) / 200 / 50_000 - 1) < 0.05


def corpus(spark, n=3000):
    rows = [(i, "x" * (20 + i % 50), "a" if i % 3 else "b" if i % 2 else None, "k") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, mix_times string")


def test_sources_reach_their_weights(spark):
    df = corpus(spark)
    out = mixing.mix(df, {"a": 1.0, "b": 2.0, None: 1.0, "unknown": 9.0}, total=400_000)
    assert out.columns == [*df.columns, "copy", "shuffle_key"]
    size = {r.source: r.n for r in out.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    for source, share in (("a", 0.25), ("b", 0.5), (None, 0.25)):
        assert abs(size[source] / 400_000 / share - 1) < 0.12


def test_same_draw_on_every_run_and_partitioning(spark):
    df = corpus(spark, 500)
    one = mixing.mix(df).select("doc_id", "copy", "shuffle_key").collect()
    two = mixing.mix(df.repartition(7, "text")).select("doc_id", "copy", "shuffle_key").collect()
    assert Counter(one) == Counter(two)
    other = mixing.mix(df, seed=5).select("doc_id", "copy", "shuffle_key").collect()
    assert Counter(one) != Counter(other)


def test_order_is_global_and_random(spark):
    rows = mixing.mix(corpus(spark, 2000)).rdd.glom().map(lambda part: [r.doc_id for r in part]).collect()
    assert all(p != sorted(p) for p in rows if len(p) > 20)
    assert all(min(p) < 600 and max(p) > 1400 for p in rows if len(p) > 100)


def test_columns_of_the_added_names_stay(spark):
    df = corpus(spark, 300)
    odd = df.selectExpr("*", "doc_id AS copy", "'mine' AS shuffle_key", "1 AS mix_text")
    out = mixing.mix(odd)
    assert out.columns == [*odd.columns, "copy_", "shuffle_key_"]
    rows = out.collect()
    assert all(r.copy == r.doc_id and r.shuffle_key == "mine" for r in rows)
    assert Counter((r.doc_id, r.copy_) for r in rows) == Counter((r.doc_id, r.copy) for r in mixing.mix(df).collect())


def test_rows_without_an_id_draw_apart(spark):
    rows = [(None, f"text {i}", "a") for i in range(2000)] + [(1, f"other {i:04}", "b") for i in range(2000)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), {"a": 1.0, "b": 1.0})
    kept = {r.source: r.n for r in out.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    total = sum(len(t) for _, t, _ in rows)
    assert all(abs(kept[s] / (total / 2) - 1) < 0.1 for s in "ab")


def test_sql_lists_counts_of_a_tiny_source(spark, tmp_path):
    rows = [(i, "x" * 300, "large") for i in range(900)] + [(1000, "y" * 200, "tiny"), (None, None, "tiny"), (None, "z", None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = mixing.mix(spark.read.parquet(str(tmp_path / "documents.parquet")))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(mixing.oracle("documents", "doc_id, text, source")).fetchall()
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)
    assert max(Counter(r[0] for r in want).values()) > 400


def test_edge_cases(spark):
    kind = "doc_id long, text string, source string, n_chars long"
    assert mixing.mix(spark.createDataFrame([], kind)).collect() == []
    odd = spark.createDataFrame([(None, None, None, None), (1, "", "a", 0), (1, "", "a", 0), (2, "y" * 50_000, "a", 1)], kind)
    rows = mixing.mix(odd, total=1_000_000).collect()
    assert Counter((r.doc_id, r.copy) for r in rows if r.doc_id == 1).most_common(1)[0][1] == 2   # repeated rows draw alike
    assert mixing.mix(odd, {"zzz": 1.0}).collect() == []
