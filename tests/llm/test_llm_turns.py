"""Conversation repair against a plain search over whole conversations."""

import hashlib
import random
import re
import sys
import zlib
from functools import cache

import pytest
from pyspark.sql import types as T

from changelake.llm import queries, turns

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
NAMES = {"u": "user", "a": "assistant"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def plain(rows):
    """What ``report`` says of one conversation's rows after damage: a backward search over all edits."""
    sys.setrecursionlimit(100_000)
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3][:64].encode()))
    seen, kinds = set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        kinds.append("blank" if not bare else "duplicate" if (role, text) in seen else
                     "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))

    @cache
    def best(at, state, inserts=0):
        found = []
        if at == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if inserts < 3:
            found += [(c + 2, "I" + s, ((NAMES[x], ""),) + t) for x in "ua" if x in NEXT[state]
                      for c, s, t in best(at, NEXT[state][x], inserts + 1)]
        if at < len(rows):
            role, text = rows[at][2:]
            found += [(c + 3, "D" + s, t) for c, s, t in best(at + 1, state)]
            if kinds[at] not in ("blank", "duplicate"):
                more = kinds[at] == "truncated"
                if role[:1] in NEXT[state]:
                    found += [(c + more, "K" + s, ((role, text),) + t) for c, s, t in best(at + 1, NEXT[state][role[:1]])]
                found += [(c + 2 + more, "R" + s, ((NAMES[x], text),) + t) for x in "ua" if x in NEXT[state]
                          for c, s, t in best(at + 1, NEXT[state][x])]
        return [min(found, key=lambda x: x[:2])] if found else []

    numbers = [r[1] for r in rows if r[1] is not None]
    cost, audit, kept = best(0, "")[0]
    return {"gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            **{k: kinds.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
            "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()}


def conversations(seed, n, longest, roles=("system", "user", "assistant", "user", "assistant", "tool", "", None)):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Well!", " ", "", None, "a b?", "open \n", "dot. \t"]
    return [(c if c else None, None if rng.random() < 0.05 else rng.randrange(longest + 2), rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"text {rng.random()}{rng.choice(['.', ''])}")
            for c in range(n) for _ in range(rng.randrange(1, longest))]


def run(spark, rows, path):
    spark.createDataFrame(rows, ROWS).write.parquet(f"{path}/conversations.parquet")
    return {r.conv_id: r.asDict() for r in queries.QUERIES["op13_repair"](spark, str(path)).collect()}


def expected(rows):
    after = damaged(rows)
    return {c: {"conv_id": c} | plain([r for r in after if r[0] == c]) for c in {r[0] for r in rows}}


@pytest.mark.parametrize("seed", [1, 2])
def test_query_equals_plain_search(spark, tmp_path, seed):
    rows = conversations(seed, 120, 9)
    assert run(spark, rows, tmp_path) == expected(rows)


def test_long_conversations_over_many_partitions(spark, tmp_path):
    rows = conversations(5, 4, 160) + conversations(6, 3, 5)
    # One conversation that stays undecided: only system rows, each of which must go or change.
    rows += [(77, t, "system", f"s{t}.") for t in range(60)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark, rows, tmp_path) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_repeated_rows_and_dropped_conversations(spark, tmp_path):
    rows = [(1, 1, "user", "again.")] * 300 + [(1, 2, "assistant", "so.")] * 2
    gone = next(c for c in range(10, 500) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "lost."), (None, None, None, None)]
    got = run(spark, rows, tmp_path)
    assert got == expected(rows)
    assert got[gone]["audit"] == "" and got[gone]["cost"] == 0


def test_empty_table_and_extra_columns(spark, tmp_path):
    assert run(spark, [], tmp_path / "none") == {}
    rows = [(1, 1, "user", "a."), (1, 2, "assistant", "b.")]
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "1 AS conv", "2 AS part", "3 AS times", "'x' AS row")
    df.write.parquet(str(tmp_path / "extra" / "conversations.parquet"))
    (got,) = queries.QUERIES["op13_repair"](spark, str(tmp_path / "extra")).collect()
    assert got.asDict() == expected(rows)[1]


def test_tree_stays_small_on_an_ordinary_conversation():
    search = turns.Survivors()
    search.insert()
    depths = []
    for i in range(400):
        turns._feed(search, "ua"[i % 2], False, False, 1, True)
        list(search.settled())
        depths.append(max(len(search.path(node)) for _, node in search.best.values()))
    assert max(depths) <= 4
