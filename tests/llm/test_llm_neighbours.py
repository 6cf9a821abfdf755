"""Nearest neighbours against brute force."""

import math

import numpy as np
from pyspark.sql import functions as F

from changelake.llm import neighbours

KIND = "vec_id long, embedding array<float>"


def brute(rows, k=10, every=10):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in good:
        if i % every == 0:
            near = sorted({(float(np.sqrt(((v - q) ** 2).sum())), j) for j, v in good if j != i and len(v) == len(q)})
            out[i] = near[:k]
    return out


def found(df, **more):
    out = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 10 == 0, **more).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 32))
    rows = [(i, (centres[i % 20] + 0.4 * rng.normal(size=32)).astype(np.float32).tolist()) for i in range(3000)]
    got = found(spark.createDataFrame(rows, KIND).repartition(4), block_rows=700, query_rows=100)
    want = brute(rows)
    assert got.keys() == want.keys()
    hits = sum(len({x for _, x in got[q]} & {x for _, x in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    exact = {(q, x): d for q in want for d, x in want[q]}
    assert all(abs(d - exact.get((q, x), d)) < 1e-12 for q in got for d, x in got[q])


def test_ties_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    copy = [0.5, -0.25, 1.0, 0.0]
    rows = [(i, copy) for i in range(60)] + [(100 + i, [float(x) for x in rng.integers(-2, 3, 4)]) for i in range(200)]
    rows += [(400, None), (401, []), (410, [0.0] * 4), (411, [math.nan] * 4), (412, [math.inf, 0.0, 0.0, 0.0]), (420, [None, 1.0, 1.0, 1.0]), (430, [1.0, 2.0]),
             (431, [1.0, 2.5]), (0, copy), (120, rows[80][1])]
    df = spark.createDataFrame(rows, KIND).withColumn("query", F.lit("x"))
    got, want = found(df, block_rows=64, query_rows=7), brute(rows)
    assert {q: [x for _, x in v] for q, v in got.items()} == {q: [x for _, x in v] for q, v in want.items()}


def test_few_rows_and_none(spark):
    assert found(spark.createDataFrame([], KIND)) == {}
    assert found(spark.createDataFrame([(10, [1.0])], KIND)) == {}
    assert found(spark.createDataFrame([(10, [1.0]), (11, [3.0]), (None, [1.5])], KIND)) == {10: [(2.0, 11)]}


def test_chi_square():
    rng = np.random.default_rng(2)
    draws = (rng.normal(size=(20_000, neighbours.PROJECTIONS)) ** 2).sum(axis=1)
    for x in (2.0, 7.0, 15.0):
        assert abs(neighbours.chi_square(x) - (draws < x).mean()) < 0.02
    assert neighbours.chi_square(0.0) == 0 and neighbours.chi_square(1e9) == 1


def test_tree_holds_every_point():
    points = np.random.default_rng(3).normal(size=(1000, 3))
    points[:300] = points[0]
    order, edges, low, high = neighbours.build_tree(points, leaf=8)
    assert sorted(order.tolist()) == list(range(1000)) and edges[0][0] == 0 and edges[-1][1] == 1000
    for (a, b), lo, hi in zip(edges, low, high):
        assert (points[order[a:b]] >= lo).all() and (points[order[a:b]] <= hi).all()
