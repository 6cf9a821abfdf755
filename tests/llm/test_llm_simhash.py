"""SimHash near-duplicates against brute force over all pairs."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from changelake.llm import simhash

WORDS = [f"w{i}" for i in range(200)]


def brute_fingerprint(text, words=3):
    tokens = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        tokens = tokens.replace(c, " ")
    tokens = [t for t in tokens.split(" ") if t]
    if not tokens:
        return 0
    grams = [" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, distance=2):
    prints = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    groups = {}
    for i, (ident, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(ident)
    low = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((ident, f"{prints[i]:016x}", low[find(i)]) for i, (ident, _) in enumerate(rows)), key=str)


def texts(rng, n):
    rows = []
    base = [" ".join(rng.choices(WORDS, k=150)) for _ in range(6)]
    for i in range(n):
        k = rng.random()
        if k < 0.5:                     # near copies, some far and some near
            t = rng.choice(base).split()
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(WORDS)
            rows.append((i, " ".join(t)))
        elif k < 0.6:
            rows.append((i, rng.choice(["", "  \n", "One two", "ONE\tTWO", "é one"])))
        else:
            rows.append((i, " ".join(rng.choices(WORDS, k=rng.randint(1, 60)))))
    return rows + [(900, None), (None, base[0]), (3, rows[3][1]), (901, "x" * 50_000), (902, "x " * 30_000)]


@pytest.mark.parametrize("pairwise", [1, 24])
def test_components_equal_brute_force(spark, pairwise):
    rows = texts(random.Random(4), 250)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = simhash.near_duplicates(df, pairwise=pairwise).select("doc_id", simhash.hex64("fp"), "component").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows)


@pytest.mark.parametrize("distance", [0, 1, 3])
def test_links_at_other_distances(spark, distance):
    rng = random.Random(distance)
    seeds = [rng.getrandbits(63) for _ in range(5)]
    prints = {s ^ sum(1 << rng.randrange(63) for _ in range(rng.randint(0, 3))) for s in seeds for _ in range(30)}
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = simhash.links(df, distance=distance, pairwise=3)
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    rows = sorted(prints)
    root = {p: p for p in rows}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, p in enumerate(rows):
        for q in rows[:i]:
            if (p ^ q).bit_count() <= distance:
                a, b = find(p), find(q)
                root[max(a, b)] = min(a, b)
    assert {p: got.get(p, p) for p in rows} == {p: find(p) for p in rows}


def test_a_large_group_makes_no_pairs(spark):
    # 400 fingerprints within two bits of one another: the links stay linear in the group.
    near = [0] + [1 << i for i in range(63)] + [(1 << i) | (1 << j) for i in range(63) for j in range(i)][:340]
    df = spark.createDataFrame([(p,) for p in near], "fp long")
    edges = simhash.links(df)
    assert edges.count() < 40 * len(near)
    assert {r.root for r in simhash.components(edges).collect()} == {0}


def test_long_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    got = simhash.components(edges).collect()
    assert {r.root for r in got} == {0} and len(got) == 300


def test_empty_table_and_kept_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, fp int")
    assert simhash.near_duplicates(empty).collect() == []
    rows = [(2, "a b c d", 1, "x"), (1, "A b c d", 2, "y"), (5, None, 3, "z"), (1, "A b c d", 2, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int, component string")
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5]


def test_only_near_duplicates_go_under_null_and_repeated_ids(spark):
    rng = random.Random(9)
    text = [" ".join(rng.choices(WORDS, k=80)) for _ in range(60)]
    rows = [(None, t, "n") for t in text[:20]] + [(7, t, "r") for t in text[20:40]]     # distinct texts
    rows += [(5, text[40], "own"), (5, text[41], "copy"), (3, text[41], "low")]         # id 5: own group, group of id 3
    rows += [(None, text[42], "m"), (None, text[42].upper(), "m"), (None, text[42], "m")]   # a group without ids
    rows += [(None, text[43], "x"), (8, text[43], "y"), (9, None, "z"), (9, "", "z"), (None, None, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept_hash string").repartition(4)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    got = [tuple(r) for r in kept.collect()]
    want = rows[:40] + [(5, text[40], "own"), (3, text[41], "low"), (8, text[43], "y")]
    ends = [r for r in got if r not in want]
    assert sorted((r for r in got if r in want), key=str) == sorted(want, key=str)
    assert sorted((r[0], (r[1] or "").lower(), r[2]) for r in ends if r[0]) == [(9, "", "z")]
    assert [(r[0], r[1].lower(), r[2]) for r in ends if not r[0]] == [(None, text[42], "m")]
    # The same groups as near_duplicates finds, one row of each.
    groups = simhash.near_duplicates(df.where("doc_id is not null")).select("component", "fp").distinct().count()
    assert simhash.drop_near_duplicates(df.where("doc_id is not null")).count() == groups


def test_fingerprint_counts_only_a_to_z_as_upper_case():
    assert simhash.fingerprint_text("ÀB c".encode()) == simhash.fingerprint_text("Àb C".encode())
    assert simhash.fingerprint_text("Àb".encode()) != simhash.fingerprint_text("àb".encode())


def test_no_row_is_dropped(spark):
    df = spark.createDataFrame([(i, f"t{i % 7} a b c") for i in range(100)], "doc_id long, text string")
    assert simhash.near_duplicates(df).agg(F.count("*")).first()[0] == 100
