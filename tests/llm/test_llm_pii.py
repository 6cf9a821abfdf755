"""Personal data: fixed patterns against re, discovery on planted contexts, redaction."""

import random
import re

from changelake.llm import pii

FIXED = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in FIXED.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def spans(rows, column):
    return [(s["kind"], s["start"], s["end"]) for s in rows[column]]


def test_fixed_patterns_equal_re(spark):
    rng = random.Random(6)
    texts = [None, "", "a@b.c.@d.e", "aa@bb@cc.dd", "a@b.com_x@c.org 1.2.3.4.5.6.7.8 +1-(2)3..4 55 -+++12345678",
             "é😀 x@y.zz 😀 256.1.1.1 001.002.003.004", "9" * 20_000 + " a@" + "b.c" * 20_000, "a" * 60_000 + "@",
             "4111 1111 1111 1111-4111-1111-1111-1111", "+1 (555) 123-4567 4111111111111111"]
    texts += ["".join(rng.choices("ab1@.+-_% ()9é\n", k=rng.randint(1, 60))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = pii.find(df).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert spans(r, "base") == brute(texts[r.id])


def planted():
    """Card numbers after 'account no'; some fail the check digit, so only context tells."""
    rng = random.Random(2)
    filler = ["lorem", "ipsum", "dolor", "sit", "amet"]
    rows, unseen = [], set()
    for i in range(80):
        stem = "".join(rng.choices("0123456789", k=15))
        good = next(stem + d for d in "0123456789" if luhn(stem + d))
        number = good if i % 4 else good[:-1] + str((int(good[-1]) + 1) % 10)
        if not i % 4:
            unseen.add((i, number))
        rows.append((i, f"{' '.join(rng.choices(filler, k=6))} account {number} {' '.join(rng.choices(filler, k=4))}"))
    rows += [(100 + i, f"we use version {i}.0 of the lorem tool") for i in range(30)]
    return rows, unseen


def test_contexts_discover_unseen_identifiers(spark):
    rows, unseen = planted()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts, found = dict(rows), set()
    for r in pii.find(df, confidence=0.7, score=0.7).collect():
        assert set(spans(r, "base")) <= set(spans(r, "spans"))
        assert not spans(r, "spans") or r.id < 100
        found |= {(r.id, texts[r.id][a:b]) for kind, a, b in spans(r, "spans") if kind == "card"}
    assert unseen <= found


def test_contexts_discover_unseen_identifiers_at_defaults(spark):
    rows, unseen = planted()
    # One constant neighbour word only, and half of the cards unseen.
    rng = random.Random(3)
    for i in range(200, 240):
        number = "".join(rng.choices("0123456789", k=15))
        number += next(d for d in "0123456789" if luhn(number + d) == (i % 2 == 0))
        if i % 2:
            unseen.add((i, number))
        rows.append((i, f"{chr(97 + i % 26)}{chr(97 + i // 26)}q holder {number} {chr(97 + i // 26)}{chr(97 + i % 26)}z"))
    # Numbers of other forms beside as many e-mail addresses are no addresses.
    rows += [(300 + i, f"meet at a{i}@b.org" if i % 2 else f"meet at {i}:30") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    added = set()
    texts = dict(rows)
    for r in pii.find(df).collect():
        added |= {(r.id, texts[r.id][a:b], kind) for kind, a, b in set(spans(r, "spans")) - set(spans(r, "base"))}
    assert added == {(i, number, "card") for i, number in unseen}


def test_no_discovery_without_confident_patterns(spark):
    rows = [(i, f"word{'abcdefghij'[i % 10]} {1000 + i} x a{i}@b.org") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.base == r.spans for r in pii.find(df).collect())


def test_redaction(spark):
    rows = [(1, "mail a.b@c.org or 1.2.3.4!", "en", 26), (1, "mail a.b@c.org or 1.2.3.4!", "en", 26), (2, None, "en", 0), (3, "", None, 0),
            (4, "+4111111111111111 x", "en", 1), (None, "😀 a@b.cc 😀", "en", 10), (1, "other", "en", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii_id string, n_chars long")
    out = pii.redact(df)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in out.collect()), key=str)
    assert got == sorted([(1, "mail <EMAIL> or <IP>!", 21), (1, "mail <EMAIL> or <IP>!", 21), (1, "other", 5), (2, None, 0), (3, "", 0),
                          (4, "+<CARD> x", 9), (None, "😀 <EMAIL> 😀", 11)], key=str)


def test_empty_table(spark):
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert pii.redact(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_main_path_has_no_python(spark):
    df = spark.createDataFrame([(1, "a@b.cc")], "doc_id long, text string")
    plan = pii.find(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
