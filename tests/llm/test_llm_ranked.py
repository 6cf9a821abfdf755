"""Ranked search against scores computed for every document."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from changelake.llm import queries, ranked

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def plain(docs, items, best=10):
    counts = [(d, Counter(TERM.findall((t or "").translate(SMALL)))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(TERM.findall((text or "").translate(SMALL)))
    out = set()
    for item, terms in asked.items():
        scored = []
        for d, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in terms if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out |= {(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored)[:best])}
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "ÀB", "ab", "AB", "日本", "x1"]
    marks = [" ", ", ", "\n", "-", "_", "\x7f", "'", " "]
    def text(k):
        return "".join(rng.choice(words[: rng.choice([5, 20, 66])]) + rng.choice(marks) for _ in range(k))
    docs = [(i, text(rng.randrange(0, 80))) for i in rng.sample(range(10 * n), n)]
    docs += [(None, text(9)), (7, None), (8, ""), (9, "--- ..")] + docs[:5] + [(10 * n + i, docs[0][1]) for i in range(30)]
    items = [(i, text(rng.randrange(1, 25))) for i in range(12)] + [(50, None), (51, ""), (52, "absent"), (3, "w1 w2"), (None, "w7")]
    return docs, items


def rows(df):
    return {(r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()}


@pytest.mark.parametrize("settings", [{}, {"shard_postings": 300}, {"item_terms": 20}])
def test_equals_scores_of_all_documents(spark, settings):
    docs, items = corpus(3, 400)
    got = ranked.search(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), **settings)
    assert rows(got) == plain(docs, items)


def test_query_and_its_sql_equal_plain_python(spark, tmp_path):
    docs, items = corpus(4, 150)
    docs = [(i, t) for i, (_, t) in enumerate(docs)]
    for name, df in (("documents", spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS doc", "2 AS score", "'z' AS term")),
                     ("benchmark", spark.createDataFrame(items, ITEMS).selectExpr("*", "'y' AS terms"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    assert rows(queries.QUERIES["op12_ranked"](spark, str(tmp_path))) == plain(docs, items)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert set(con.execute(queries.ORACLES["op12_ranked"]).fetchall()) == plain(docs, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([(1, "a")], ITEMS)
    assert ranked.search(docs.where("false"), items).count() == 0
    assert ranked.search(docs, items.where("false")).count() == 0
    assert ranked.search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(ranked, "PIECE", 10)
    text = "Abc " * 50 + "é" * 40 + "-" + "x" * 25 + " end"
    assert ranked.count_terms(text) == Counter(t.encode() for t in TERM.findall(text.translate(SMALL)))


def test_blocks_decompress_to_what_they_hold_and_some_are_passed_over():
    rng = np.random.default_rng(1)
    docs = np.sort(rng.choice(100_000, 5_000, replace=False))
    counts, m = rng.integers(1, 400, 5_000), rng.integers(10, 300, 100_000)
    postings = ranked.Postings(docs, counts, m)
    got, impact = postings.read(3, 9)
    assert (got == docs[3 * 128:9 * 128]).all() and (impact == ranked.impacts(counts, m[docs])[3 * 128:9 * 128]).all()
    assert postings.gaps.nbytes + postings.counts.nbytes <= 4 * 5_000
    # A rare dear term and a common cheap one: once ten documents hold both, most of the
    # cheap list's blocks can lift nothing.
    rare, common = np.arange(0, 100_000, 9_000), np.arange(100_000)
    shard = ranked.Shard(np.full(100_000, 100), np.repeat([0, 1], [len(rare), len(common)]),
                         np.concatenate([rare, common]), np.ones(len(rare) + len(common), int))
    assert [d for _, d in shard.search([(0, 9_000), (1, 3)])] == rare[:10].tolist()
    assert shard.read < len(common) // 128
