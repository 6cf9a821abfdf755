"""Registered queries and the pipeline over small tables, whole rows against plain Python."""

import hashlib
import random
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
from conftest import SF_SMALL
from test_llm_bpe import REFERENCE, odd_texts
from test_llm_mixing import poisson
from test_llm_pii import brute
from test_llm_simhash import brute_components, texts
from test_llm_substrings import brute as brute_repeats
from test_llm_substrings import mixed

import __spark_entry__ as E
import corpus_pipeline

QUERIES = E.queries()


def documents(tmp_path, rows):
    ids, found = zip(*rows)
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(found, pa.string())}),
                   tmp_path / "documents.parquet")
    return str(tmp_path)


def test_op3_pii(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choices("ab1@.+-_% ()9é\n", k=rng.randint(1, 60)))) for i in range(300)]
    rows += [(900, None), (None, "x a@b.org y"), (901, "4111 1111 1111 1111 or +1 (555) 123-4567 at 10.0.0.1")]
    want = []
    for ident, text in rows:
        spans = brute(text)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want.append((ident, *(sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")),
                     hashlib.sha256(listed.encode()).hexdigest(), listed))
    df = QUERIES["op3_pii"](spark, documents(tmp_path, rows))
    assert df.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    # Random contexts never become confident, so the spans are those of the fixed patterns.
    assert sorted((tuple(r) for r in df.collect()), key=str) == sorted(want, key=str)


def test_op5_simhash(spark, tmp_path):
    rows = texts(random.Random(12), 120)
    df = QUERIES["op5_simhash"](spark, documents(tmp_path, rows))
    assert df.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in df.collect()), key=str) == brute_components(rows)


def test_op8_repeats(spark, tmp_path):
    rows = mixed(4)
    df = QUERIES["op8_repeats"](spark, documents(tmp_path, rows))
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute_repeats(rows)]
    assert sorted((tuple(r) for r in df.collect()), key=str) == sorted(want, key=str)


def test_op10_bpe(spark, tmp_path):
    rows = list(enumerate(odd_texts()))
    df = QUERIES["op10_bpe"](spark, documents(tmp_path, rows))
    assert df.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = []
    for ident, text in rows:
        ids = REFERENCE.encode_ordinary(text or "")
        want.append((ident, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(tuple(r) for r in df.collect()) == want


def redacted(text):
    spans = []
    for start, end, kind in sorted((a, b, k) for k, a, b in brute(text)):
        if spans and start < spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end, kind])
    for start, end, kind in reversed(spans):
        text = f"{text[:start]}<{kind.upper()}>{text[end:]}"
    return text


def draw(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2 ** 52


def test_pipeline_run(spark, monkeypatch):
    given = {}

    def seen(name, stage):
        def run(session, docs, sf_dir):
            given[name] = docs.collect()
            return stage(session, docs, sf_dir)
        return name, run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [seen(*s) for s in corpus_pipeline.STAGES])
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    first, good, unique, clean, copies = given.values()
    # The classifier is trained, so only that it drops some rows and changes none.
    assert 0 < len(good) < len(first) and set(good) <= set(first)
    found = brute_components([(r.doc_id, r.text) for r in good])
    keep = {ident for ident, _, low in found if ident == low}
    assert Counter(unique) == Counter(r for r in good if r.doc_id in keep)
    want = [(r.doc_id, redacted(r.text), r.lang, r.source) for r in unique]
    assert Counter((r.doc_id, r.text, r.lang, r.source) for r in clean) == Counter(want)
    size = Counter()
    for r in clean:
        size[r.source] += max(len(r.text), 1)
    times = Counter({r: poisson(sum(size.values()) / len(size) / size[r.source], draw(42, r.doc_id)) for r in clean})
    assert Counter(copies) == +times
    assert Counter((r.doc_id, r.text, r.decoded_sha256) for r in out) == Counter(
        (r.doc_id, r.text, hashlib.sha256(r.text.encode()).hexdigest()) for r in copies)
    assert all(r.n_tokens == len(r.ids) for r in out)
