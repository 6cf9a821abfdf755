"""Consistent weighted sampling: collision rates, pairing with the next document, edge cases."""

import hashlib
import random
from collections import Counter

import numpy as np

from changelake.llm import cws, queries

WORDS = ["".join(random.Random(i).choices("abcdefé", k=2 + i % 7)) for i in range(300)]


def texts(rng, n, k=200):
    return [" ".join(rng.choices(WORDS, k=rng.randint(1, k))) for _ in range(n)]


def similarity(a, b):
    x, y = (Counter(t.split()) for t in (a, b))
    low = sum(min(x[w], y[w]) * len(w) for w in x | y)
    high = sum(max(x[w], y[w]) * len(w) for w in x | y)
    return low / high if high else 1.0


def test_collision_rate_is_generalised_jaccard():
    rng = random.Random(1)
    a = texts(rng, 60)
    b = [cws.edited(x, y) for x, y in zip(a, texts(rng, 60))]
    codes = cws.texts_signatures(a + b, lanes=512)
    got = cws.likeness(codes[:60], codes[60:])
    want = np.array([similarity(x, y) for x, y in zip(a, b)])
    assert np.abs(got - want).max() < 0.1 and abs((got - want).mean()) < 0.01


def test_long_words_weigh_all_their_characters():
    rng = random.Random(5)
    letters = lambda n, some="abcdefghij日é": "".join(rng.choices(some, k=n))
    shared = [letters(9) for _ in range(10)]
    pairs = [(" ".join([*shared, letters(1000)]), " ".join([*shared, letters(1000)])),
             (" ".join([*shared, word := letters(1000)]), " ".join([word, letters(90)])),
             (" ".join([letters(300)] * 40 + shared), " ".join([*shared, letters(70)]))]
    codes = cws.texts_signatures([x for pair in pairs for x in pair], lanes=2048)
    for (a, b), got in zip(pairs, cws.likeness(codes[::2], codes[1::2])):
        assert abs(got - similarity(a, b)) < 0.05


def test_order_of_the_parts_of_a_long_word_matters():
    a, b = "x" * 256, "y" * 256
    for one, two in ((a + b, b + a), (a + b + a, a + a + b), ("x" * 65536 + "y", "y" + "x" * 65536), ("ab" * 40000, "ba" * 40000)):
        codes = cws.texts_signatures([one, two])
        assert cws.likeness(codes[:1], codes[1:])[0] < 0.1


def test_long_texts_are_cut_between_words(monkeypatch):
    rng = random.Random(6)
    many = texts(rng, 40) + ["z" * 700, "", "a " * 900 + "b" * 500]
    whole = cws.texts_signatures(many)
    monkeypatch.setattr(cws, "PIECE", 64)
    assert (cws.texts_signatures(many) == whole).all()


def test_query_equals_plain_python(spark, tmp_path):
    rng = random.Random(7)
    docs = [(i, t) for i, t in zip(rng.sample(range(900), 60), texts(rng, 60))] + [(901, None), (902, ""), (903, "w" * 3000)]
    spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS lang", "1 AS id") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op9_fingerprint"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs)


def test_signature_does_not_depend_on_the_batch():
    rng = random.Random(2)
    many = texts(rng, 50) + ["", " \n", None, "x" * 50_000, "x " * 20_000]
    many = [t or "" for t in many]
    together = cws.texts_signatures(many)
    assert all((cws.texts_signatures([t])[0] == row).all() for t, row in zip(many, together))
    assert not together[50:53].any() and together[53:].any()


def brute(docs):
    ordered = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    out = []
    for (i, t), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        t, after = t or "", after or ""
        new = cws.edited(t, after)
        codes = cws.texts_signatures([t, new, after])
        near = cws.likeness(codes[[0, 0]], codes[1:])
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), cws.as_hex(codes)[0], cws.as_hex(codes)[1], near[0], near[1]))
    return sorted(out, key=str)


def test_pairs_equal_brute_force(spark):
    rng = random.Random(3)
    docs = [(rng.randrange(10_000), t) for t in texts(rng, 200)]
    docs += [(5, None), (7, ""), (None, "null id"), (-4, "é😀 odd"), (20_000, "last " * 4000), (docs[0][0], "same id"), docs[1]]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as bucket", "2 as halo").repartition(5)
    for buckets in (1, 7, 60):
        got = sorted((tuple(r) for r in cws.compare_with_next(df, buckets=buckets).collect()), key=str)
        assert got == brute(docs)


def test_small_tables(spark):
    kind = "doc_id long, text string"
    assert cws.compare_with_next(spark.createDataFrame([], kind)).collect() == []
    one = cws.compare_with_next(spark.createDataFrame([(1, "a b c d")], kind)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert one[0].edited_sha256 == hashlib.sha256(cws.edited("a b c d", "a b c d").encode()).hexdigest()


def test_edit_of_odd_lengths():
    assert cws.edited("abcde", "XYZ") == "abcXY"
    assert cws.edited("abcde", "X") == "abcX"
    assert cws.edited("a", "X") == "a" and cws.edited("", "X") == ""
