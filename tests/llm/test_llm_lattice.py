"""Lattice hashing against all pairs."""

import numpy as np
import pytest
from pyspark.sql import types as T

from changelake.llm import lattice, queries

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def plain(rows, threshold=0.9):
    """{(id, links, component, kept)} as a sorted list, by all cosines."""
    usable = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for size in {len(rows[i][1]) for i in usable}:
        some = [i for i in usable if len(rows[i][1]) == size]
        v = np.array([rows[i][1] for i in some], np.float32).astype(float)
        norm = np.sqrt((v * v).sum(axis=1))
        for a, b in zip(*np.nonzero(v @ v.T / np.outer(norm, norm) >= threshold)):
            if a != b:
                links[some[a]].add(some[b])
    component = {}
    for start in range(len(rows)):
        if start not in component:
            group, queue = {start}, [start]
            while queue:
                for y in links[queue.pop()] - group:
                    group.add(y)
                    queue.append(y)
            ids = [rows[i][0] for i in group if rows[i][0] is not None]
            component |= dict.fromkeys(group, min(ids) if ids else None)
    return sorted(((r[0], len(links[i]), component[i], r[0] is not None and r[0] == component[i]) for i, r in enumerate(rows)), key=str)


def near(rng, base, cos):
    side = rng.normal(size=base.shape)
    side -= side @ base * base
    return cos * base + np.sqrt(1 - cos * cos) * side / np.linalg.norm(side)


def planted(seed, size=24):
    rng = np.random.default_rng(seed)
    unit = lambda: (lambda x: x / np.linalg.norm(x))(rng.normal(size=size))
    vectors = [unit() for _ in range(300)]
    for cos in (0.999, 0.98, 0.96, 0.94, 0.92):                 # pairs, and chains of them
        for _ in range(15):
            base = unit()
            vectors += [base, near(rng, base, cos)]
            vectors.append(near(rng, vectors[-1], cos))
    for spread, n in ((0.995, 150), (0.97, 120), (0.95, 80)):   # groups, tight and loose
        base = unit()
        vectors += [near(rng, base, spread) for _ in range(n)]
    vectors += [vectors[0]] * 40 + [3 * vectors[1]]
    return [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]


def collected(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("settings", [{}, {"cell_rows": 16}, {"lattices": 1, "scale": 0.75}])
def test_planted_groups_equal_all_pairs(spark, settings):
    rows = planted(1)
    got = collected(lattice.near_duplicates(spark.createDataFrame(rows, ROWS), **settings))
    want = plain(rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    found, there = sum(g[1] for g in got), sum(w[1] for w in want)
    # The loose group has many pairs just at the threshold; none below it may be counted.
    assert there * 0.99 <= found <= there and all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g == w for g, w in zip(got, want)) > 0.9 * len(want)
    assert [g[2:] for g in got] == [w[2:] for w in want]


def test_query_with_odd_rows_equals_all_pairs(spark, tmp_path):
    a, b = [1.0, 2.0, 3.0, 4.0], [4.0, -3.0, 2.0, -1.0]
    rows = [(5, a), (3, a), (3, [2.0, 4.0, 6.0, 8.0]), (9, b), (None, b), (None, [0.0, 1.0]), (1, None), (2, []), (4, [0.0] * 4),
            (6, [1.0, None, 3.0, 4.0]), (7, [float("nan"), 2.0, 3.0, 4.0]), (8, [float("inf"), 2.0, 3.0, 4.0]),
            (10, [1.0, 2.0]), (11, [1.0, 2.0]), (12, [1e30, 2e30, 3e30, 4e30])]
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "1 AS rep", "2 AS ball", "'x' AS v", "3 AS id", "4 AS label")
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    assert collected(queries.QUERIES["op11_lattice"](spark, str(tmp_path))) == plain(rows)


def test_empty_table(spark):
    none = lattice.near_duplicates(spark.createDataFrame([], ROWS))
    assert none.columns == ["vec_id", "n_links", "component_id", "kept"] and none.count() == 0


def test_decoding_finds_the_nearest_lattice_point():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 8)) * 2
    points = lattice.decode(x)
    doubled = np.rint(2 * points)
    assert (doubled == 2 * points).all() and (points.sum(axis=1) % 2 == 0).all()
    assert ((doubled % 2 == 0).all(axis=1) | (doubled % 2 == 1).all(axis=1)).all()
    steps = lattice.shortest_vectors()
    assert len(steps) == 240 and np.allclose((steps ** 2).sum(axis=1), 2)
    # No neighbour is nearer, which for E8 means that no point is.
    own = ((x - points) ** 2).sum(axis=1)
    others = ((x[:, None] - points[:, None] - steps[None]) ** 2).sum(axis=2).min(axis=1)
    assert (own <= others + 1e-9).all()


def test_recall_at_the_threshold():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = np.array([near(rng, x, 0.9) for x in a])
    one, two = lattice.cells(a), lattice.cells(b)
    met = ((one[:, :, :1] == two).any(axis=2) | (two[:, :, :1] == one).any(axis=2)).any(axis=1)
    assert met.mean() > 0.99
