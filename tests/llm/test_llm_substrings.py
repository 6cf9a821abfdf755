"""Repeated substrings against brute force over all strings."""

import random

import numpy as np
import pytest
import xxhash

from changelake.llm import substrings


def brute(docs, length=substrings.LENGTH):
    low, first = -(1 << 63), {}
    raws = [(low if i is None else i, (t or "").encode()) for i, t in docs]
    for i, raw in raws:
        for a in range(len(raw) - length + 1):
            w = raw[a:a + length]
            if w not in first or (i, a) < first[w]:
                first[w] = (i, a)
    out = []
    for i, raw in raws:
        gone = np.zeros(len(raw), bool)
        for a in range(len(raw) - length + 1):
            if first[raw[a:a + length]] < (i, a):
                gone[a:a + length] = True
        edges = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
        out.append((None if i == low else i, len(raw), int(gone.sum()), int((edges == 1).sum()), bytes(np.frombuffer(raw, np.uint8)[~gone])))
    return sorted(out, key=str)


def found(spark, docs, **more):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).selectExpr("*", "1 as bucket", "'x' as mark")
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in substrings.remove_repeats(df, **more).collect()), key=str)


def mixed(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefé", k=rng.randint(2, 6))) for _ in range(60)]

    def some(n):
        return " ".join(rng.choices(words, k=n))

    base = [some(80) for _ in range(20)]
    docs = []
    for i in range(120):
        k, b = rng.random(), rng.choice(base)
        if k < 0.2:
            t = b
        elif k < 0.5:
            a = rng.randint(0, len(b) - 50)
            t = some(rng.randint(0, 30)) + b[a:a + rng.randint(40, 400)] + some(rng.randint(0, 30))
        elif k < 0.6:
            t = rng.choice(["ab", "x", "abc "]) * rng.randint(30, 400)
        elif k < 0.7:
            at = rng.randrange(len(b))
            t = b[:at] + "Z" + b[at + 1:]
        else:
            t = some(rng.randint(0, 100))
        docs.append((i, t))
    return docs + [(500, None), (501, ""), (None, base[0]), (3, docs[3][1]), (3, base[1] + "tail"), (4, some(3) + docs[4][1]), (502, "y" * 99), (503, "y" * 100)]


@pytest.mark.parametrize("many", [1, 4, substrings.MANY])
def test_equals_brute_force(spark, many):
    docs = mixed(many)
    assert found(spark, docs, many=many) == brute(docs)


def test_passage_in_every_text(spark):
    rng = random.Random(7)
    passage = "".join(rng.choices("abcdefgh ", k=400))
    docs = [(i, "".join(rng.choices("abcdefgh ", k=20)) + passage + "".join(rng.choices("abcdefgh ", k=20))) for i in range(150)]
    assert found(spark, docs, many=20) == brute(docs)


def test_text_longer_than_a_span(spark):
    rng = random.Random(8)
    text = "".join(rng.choices("abcdefgh", k=300_000))
    docs = [(1, text), (2, text[250_000:262_400] + "-" + text[:150])]
    assert found(spark, docs) == brute(docs)


def test_texts_of_one_id_are_never_mixed_up(spark):
    rng = random.Random(11)
    seen, pair = {}, None
    while not pair:                       # two texts that agree in 31 bits of a hash
        text = "".join(rng.choices("abcdefghij", k=130))
        mark = xxhash.xxh64_intdigest(text, 42) & 0x7FFFFFFF
        pair = (seen[mark], text) if mark in seen else None
        seen[mark] = text
    some = list(seen.values())[:400]
    docs = [(3, pair[0]), (7, pair[0]), (7, pair[1])] + [(None, t) for t in some[:250]] + [(9, t) for t in some[200:400]] + [(9, some[399])]
    assert found(spark, docs) == brute(docs)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.remove_repeats(df).collect() == []


def test_cover_and_suffix_order():
    members = set(substrings.COVER)
    assert {(a - b) % substrings.PERIOD for a in members for b in members} == set(range(substrings.PERIOD))
    rng = random.Random(9)
    text = bytes(rng.choices(b"ab", k=400)) * 2 + b"a" * 300
    data = np.concatenate([np.frombuffer(text, np.uint8), np.zeros(300, np.uint8)])
    places = np.arange(len(text))
    order = substrings.suffix_order(data, places, np.zeros(len(text), np.int64))
    padded = text + bytes(300)
    keys = [padded[p:p + substrings.LENGTH] for p in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == places.tolist()
