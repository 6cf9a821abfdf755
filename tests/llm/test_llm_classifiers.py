"""Quality classifier and language identification: held-out accuracy, brute-force scores, edge cases."""

import random
import zlib

import numpy as np
import pytest

from changelake.llm import langid, quality, queries

SYLLABLES = {"aa": ["the", "ing", "and", "wh", "tion"], "bb": ["ich", "sch", "ung", "der", "ü"], "cc": ["que", "eau", "les", "é", "ment"]}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def junk(rng, lang, n):
    words = sentence(rng, lang, n).split()
    kind = rng.randrange(3)
    if kind == 0:
        return " ".join(w + rng.choice(["%%%", "***", "$$$"]) for w in words)
    if kind == 1:
        return " ".join(w + "!!" for w in words).upper()
    return " ".join(w for w in words[:max(1, n // 12)] for _ in range(12))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(900):
        lang, bad = rng.choice(list(SYLLABLES)), rng.random() < 0.3
        docs.append((i, (junk if bad else sentence)(rng, lang, rng.randint(4, 120)), lang, "s", 0.5))
        labels.append((i, int(not bad)))
    docs += [(1000, None, "aa", "s", 0.5), (1001, "", None, "s", 0.5), (1002, "12 34 !!", "bb", "s", 0.5), (None, "the and", "aa", "s", 0.5)]
    labels += [(1000, None), (1001, 7), (5000, 1)]
    kind = "doc_id long, text string, lang string, source string, score double"
    return spark.createDataFrame(docs, kind).repartition(4), spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels)


def test_quality_held_out(spark, corpus):
    docs, labels, truth = corpus
    model = quality.fit(docs, labels, where=docs.doc_id % 3 != 0)
    rows = docs.select("doc_id", quality.scorer(model, spark)("text").alias("s")).collect()
    assert all(0 <= r.s <= 1 for r in rows) and len(rows) == 904
    held = [(r.s >= quality.THRESHOLD) == (truth[r.doc_id] == 1) for r in rows if r.doc_id in truth and r.doc_id < 900 and r.doc_id % 3 == 0]
    assert np.mean(held) > 0.95


def test_quality_score_is_the_mean_over_all_features(corpus):
    docs, labels, _ = corpus
    model = quality.fit(docs, labels)
    texts = [b"", b"a", b"the the the", "é ü %%% and".encode() * 300, b" x", b"x" * 100_000, b"the and"]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = quality.score_logits(np.frombuffer(b"".join(texts), np.uint8), offsets, model)
    for text, logit in zip(texts, got):
        buckets = quality.features(text)
        want = model.bias + (model.table[buckets].astype(float).mean() if len(buckets) else 0)
        assert abs(logit - want) < 1e-6


def test_quality_repeat_mark():
    same, other = quality.features(b"abc abc abc"), quality.features(b"xyz xyz xyz")
    assert len(set(same[-2:]) | set(other[-2:])) == 1          # repeated words look alike


def test_quality_degenerate_labels(spark, corpus):
    docs, labels, _ = corpus
    for marks, want in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0), (labels.where("quality = 0"), 0.0)):
        model = quality.fit(docs, marks)
        scores = {r[0] for r in docs.select(quality.scorer(model, spark)("text")).collect()}
        assert len(scores) == 1 and abs(scores.pop() - want) < 1e-3
    empty = docs.limit(0).select(quality.scorer(model, spark)("text"))
    assert empty.collect() == []


def test_language_held_out(spark, corpus):
    docs, _, _ = corpus
    net = langid.fit(docs.where("doc_id % 3 <> 0"))
    assert net.languages == sorted(SYLLABLES)
    out = langid.predict(docs, net, lang_out="guess", score_out="sure")
    assert out.columns == [*docs.columns, "guess", "sure"]
    rows = out.collect()
    held = [r.guess == r.lang for r in rows if r.doc_id is not None and r.doc_id < 900 and r.doc_id % 3 == 0]
    assert np.mean(held) > 0.97
    und = {r.doc_id: r.sure for r in rows if r.guess == langid.UNDETERMINED}
    assert und == {1000: 0.0, 1001: 0.0, 1002: 0.0}
    assert all(0 <= r.sure <= 1 for r in rows)


def test_language_windows_read_the_whole_text(spark, corpus):
    docs, _, _ = corpus
    net = langid.fit(docs)
    rng = random.Random(9)
    # A short beginning in one language, a long rest in another: the rest decides.
    text = sentence(rng, "aa", 30) + " " + sentence(rng, "bb", 4000)
    df = spark.createDataFrame([(text,), (text,), ("the",)], "text string")
    rows = langid.predict(df, net).collect()
    assert rows[0] == rows[1] and rows[0].lang_pred == "bb"


def test_language_network_by_hand(corpus):
    net = langid.fit(corpus[0])
    data = "the and ingtion".encode()
    rows, owner, held = langid.windows(np.frombuffer(data * 20, np.uint8), np.array([0, 15, 15, 300]))
    assert owner.tolist() == [0, 2, 2, 2] and held.tolist() == [15, 128, 128, 29]
    got = langid.log_probabilities(net, rows)
    for row, logs in zip(rows, got):
        seen, hidden = net.vectors[row], []
        for width, weights in zip(langid.WIDTHS, net.filters):
            values = [seen[i:i + width].reshape(-1) @ weights for i in range(langid.WINDOW - width + 1)]
            hidden.append(np.max(values, axis=0))
        z = np.maximum(np.concatenate(hidden) + net.shifts, 0) @ net.layer + net.bias
        assert np.allclose(logs, z - np.log(np.exp(z - z.max()).sum()) - z.max(), atol=1e-4)


def test_language_without_or_with_one_language(spark, corpus):
    docs, _, _ = corpus
    none = langid.predict(docs, langid.fit(docs.limit(0))).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in none] == [("und", 0.0)]
    one = langid.fit(docs.where("lang = 'aa'"))
    rows = langid.predict(docs.where("doc_id < 900"), one, score_out="sure").select("lang_pred", "sure").distinct().collect()
    assert [tuple(r) for r in rows] == [("aa", 1.0)]


def test_quality_long_text_in_pieces(monkeypatch):
    rng = random.Random(4)
    model = quality.Model(np.random.default_rng(1).normal(size=1 << quality.BITS).astype(np.float32), 0.25)
    for text in (sentence(rng, "bb", 900), "слово слово 日本語 テスト " * 200 + "конец", "é" * 3000, "a" * 700 + " b b b" * 300):
        data = np.frombuffer(text.encode(), np.uint8)
        whole = quality.score_logits(data, np.array([0, len(data)]), model)
        with monkeypatch.context() as patch:
            patch.setattr(quality, "SLICE_BYTES", 64)
            assert np.allclose(quality.score_logits(data, np.array([0, len(data)]), model), whole)


def test_quality_grams_are_of_characters():
    for text, n in (("日本語です", 5), ("слово", 5), ("añb", 3), ("ab", 2)):
        codes, starts = quality._characters(np.frombuffer(text.encode(), np.uint8))
        assert len(codes) == n and len(set(codes.tolist())) == len(set(text))
    one, two = quality.features("кот пёс".encode()), quality.features("пёс кот".encode())
    assert len(one) == (7 - 2) + (7 - 3) + 2 and len(two) == len(one)


@pytest.mark.parametrize("letters", ["абвгдежзиклмнопрст", "日本語中文字典漢数学校生先今"])
def test_quality_held_out_in_other_scripts(spark, letters):
    rng = random.Random(12)
    parts = ["".join(rng.choices(letters, k=3)) for _ in range(12)]
    good = lambda: " ".join("".join(rng.choices(parts, k=2)) for _ in range(40))
    bad = lambda: " ".join("".join(rng.choices(letters, k=6)) for _ in range(40))
    rows = [(i, good() if i % 2 else bad(), i % 2) for i in range(600)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    model = quality.fit(docs, labels, where=docs.doc_id < 400)
    scores = {r.doc_id: r[1] for r in docs.select("doc_id", quality.scorer(model, spark)("text")).collect()}
    right = [(scores[i] >= 0.5) == bool(y) for i, _, y in rows if i >= 400]
    assert np.mean(right) > 0.95


def test_queries_return_every_document_and_hold_out_by_crc(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    language = queries.QUERIES["op2_language"](spark, sf_dir)
    assert language.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = {r.doc_id: r for r in language.collect()}
    assert rows.keys() == texts.keys()
    known = {r.lang for r in texts.values() if r.lang is not None}
    for i, r in rows.items():
        letters = any(c.isalpha() for c in texts[i].text or "")
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.lang_pred in known if letters else r.lang_pred == "und"
    scored = queries.QUERIES["op6_quality"](spark, sf_dir)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in scored.collect()}
    assert rows.keys() == texts.keys()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
