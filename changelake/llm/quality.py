"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its words and its character n-grams
(across word borders), all hashed into one table; a softmax layer on the average gives the
class. A word that repeats its predecessor is replaced by one mark
before hashing, so that runs of a word look alike whatever the word.

Vectors and layer are trained together by numpy stochastic gradient descent on a bounded
sample of labelled rows (``sample_rows``, ``sample_bytes`` of each from a hash-chosen
place). For two classes the layer is linear in the average, so prediction folds it into
the table: one number per bucket, summed over the whole text, a long text piece by piece
(cut between words; n-grams that cross a cut count once).

Edge cases: null and empty texts get the score of the bias alone; rows without a label
or with a label other than 0 or 1 do not train; no labelled rows (or one class only)
give a constant score, the share of class 1 (0.5 if there is none); ties and repeated
rows score alike; other columns are kept and never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import SLICE_BYTES, by_slice, small_batches, uniform

BITS = 16
DIM = 8
GRAMS = (3, 4)
SAMPLE_ROWS = 2000
SAMPLE_BYTES = 2000
THRESHOLD = 0.7


@dataclass(frozen=True)
class Model:
    table: np.ndarray      # log-odds of class 1 per bucket (float32)
    bias: float


def _mix(codes: np.ndarray, salt: int) -> np.ndarray:
    mixed = (codes ^ np.uint32(salt)) * np.uint32(2654435761)
    mixed ^= mixed >> np.uint32(15)
    return (mixed * np.uint32(2246822519)) >> np.uint32(32 - BITS)


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """(a number for each character, its UTF-8 bytes; where each begins, or None if each byte is one)."""
    lead = data & 0xC0 != 0x80
    if lead.all():
        return data.astype(np.uint32), None
    starts = np.flatnonzero(lead)
    width = np.diff(np.append(starts, len(data)))
    codes = data[starts].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(width > k)
        codes[longer] |= data[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return codes, starts


def _gram_buckets(codes: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each character."""
    mixed = codes[:len(codes) - n + 1].copy()
    for i in range(1, n):
        mixed = mixed * np.uint32(16777619) + codes[i:len(codes) - n + 1 + i]
    return _mix(mixed, n)


def _powers() -> np.ndarray:
    out = np.empty(64, np.uint32)
    x = 1
    for i in range(64):
        out[i] = x
        x = x * 16777619 % (1 << 32)
    return out


POWERS = _powers()


def _words(data: np.ndarray, offsets: np.ndarray, before: int | None = None) -> tuple[np.ndarray, np.ndarray, int | None]:
    """(bucket of each word, its start, the last one's hash). Words are runs of bytes above the
    space; the borders of documents also end them. ``before``: hash of the word before the first."""
    solid = data > 32
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | first[1:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.empty(0, np.uint32), starts, before
    place = np.arange(len(data)) - starts[np.maximum(np.cumsum(begins) - 1, 0)]
    parts = np.where(solid, (data.astype(np.uint32) + np.uint32(1)) * POWERS[np.clip(place, 0, 63)], np.uint32(0))
    hashes = np.add.reduceat(parts, starts, dtype=np.uint32)
    again = np.zeros(len(starts), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & ~first[starts[1:]]
    again[0] = before is not None and hashes[0] == before
    return _mix(np.where(again, np.uint32(0), hashes), 77), starts, int(hashes[-1])


def score_logits(data: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    """Log-odds of class 1 for each text in a byte buffer."""
    if len(offsets) == 2 and len(data) > 2 * SLICE_BYTES:
        total, count = _long_sums(data, model)
        return np.array([total / max(count, 1) + model.bias])
    total, count = _sums(data, offsets, model)
    return total / np.maximum(count, 1) + model.bias


def _long_sums(data: np.ndarray, model: Model) -> tuple[float, float]:
    """Sum and number of the features of one text, piece by piece."""
    total = count = 0.0
    a, before = 0, None
    while a < len(data):
        b = min(a + SLICE_BYTES, len(data))
        while b < len(data):                            # a piece ends where a word does
            space = np.flatnonzero(data[b:b + SLICE_BYTES] <= 32)
            b = b + int(space[0]) if len(space) else min(b + SLICE_BYTES, len(data))
            if len(space):
                break
        buckets, _, before = _words(data[a:b], np.array([0, b - a]), before)
        total, count = total + float(model.table[buckets].sum(dtype=np.float64)), count + len(buckets)
        codes, starts = _characters(data[a:b + 4 * (max(GRAMS) - 1)])      # and what n-grams reach beyond
        own = b - a if starts is None else int(np.searchsorted(starts, b - a))
        inside = len(codes) if b < len(data) else own
        for n in GRAMS:
            grams = _gram_buckets(codes, n)[:own] if inside >= n else codes[:0]
            total, count = total + float(model.table[grams].sum(dtype=np.float64)), count + len(grams)
        a = b
    return total, count


def _sums(data: np.ndarray, offsets: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the features of each text."""
    total, features = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)

    def add(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        hi = np.maximum(lo, hi)
        sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
        nonlocal total, features
        total += sums[hi] - sums[lo]
        features += hi - lo

    codes, begins = _characters(data)
    edges = offsets if begins is None else np.searchsorted(begins, offsets)
    for n in GRAMS:
        if len(codes) >= n:
            last = len(codes) - n + 1
            add(model.table[_gram_buckets(codes, n)], np.minimum(edges[:-1], last), np.minimum(edges[1:] - n + 1, last))
    if len(data):
        buckets, starts, _ = _words(data, offsets)
        edges = np.searchsorted(starts, offsets)
        add(model.table[buckets], edges[:-1], edges[1:])
    return total, features


def features(text: bytes) -> np.ndarray:
    """All buckets of one text, for training."""
    data = np.frombuffer(text, np.uint8)
    codes, _ = _characters(data)
    grams = [_gram_buckets(codes, n) for n in GRAMS if len(codes) >= n]
    words = [_words(data, np.array([0, len(data)]))[0]] if len(data) else []
    return np.concatenate([np.empty(0, np.uint32), *grams, *words])


def train(texts: list[bytes], labels: np.ndarray, share: float, epochs: int = 8, batch: int = 64,
          rate: float = 0.5, seed: int = 7) -> Model:
    """Stochastic gradient descent on the embedding table and the softmax layer.

    ``share`` is class 1's share among all labelled rows; the sample may hold the classes
    in other proportions, which the bias makes up for."""
    prior = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(1 << BITS, np.float32), prior)
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
    layer = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    docs = [features(t) for t in texts]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(len(docs))
        for k in range(0, len(order), batch):
            rows = order[k:k + batch]
            sizes = np.maximum([len(docs[r]) for r in rows], 1)
            ids = np.concatenate([docs[r] for r in rows]).astype(np.int64)
            owner = np.repeat(np.arange(len(rows)), [len(docs[r]) for r in rows])
            # Counts per (document, bucket), so each bucket is read and written once a document.
            cells, counts = np.unique(owner * (1 << BITS) + ids, return_counts=True)
            owner, ids = cells >> BITS, cells & ((1 << BITS) - 1)
            weight = (counts / sizes[owner]).astype(np.float32)[:, None]
            mean = np.zeros((len(rows), DIM), np.float32)
            np.add.at(mean, owner, table[ids] * weight)
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1
            back = p @ layer.T
            layer -= step * mean.T @ p / len(rows)
            bias -= step * p.mean(axis=0)
            # Sparse features: a bucket's step is not shrunk by the batch or the length.
            np.add.at(table, ids, -step * 20 * weight * back[owner])
    odds = np.bincount(labels, minlength=2)
    return Model((table @ (layer[:, 1] - layer[:, 0])).astype(np.float32),
                 float(bias[1] - bias[0]) + prior - float(np.log(odds[1] / odds[0])))


def sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, where: Column | None = None,
           rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES, seed: int = 11) -> tuple[list[bytes], np.ndarray, float]:
    """At most ``rows`` labelled texts, about as many of each class, ``size`` characters of
    each from a hash-chosen place, and class 1's share among all labelled rows. Ids and
    labels are joined without texts; only the picked rows' texts are read then."""
    ids = docs if where is None else docs.where(where)
    ids = ids.select(F.col(id_col).alias("id"))
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1)")
    marked = ids.join(marks, "id")
    counts = {r.y: r.n for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return [], np.empty(0, np.int64), 0.5
    share = counts.get(1, 0) / sum(counts.values())
    quota = F.create_map(*(x for y, n in counts.items() for x in (F.lit(y), F.lit(rows / 2 / n))))[F.col("y")]
    picked = marked.withColumn("u", uniform("id", seed=seed)).where(F.col("u") < quota) \
        .orderBy("u", "id", "y").limit(rows).collect()
    if not picked:
        return [], np.empty(0, np.int64), share
    chosen = F.broadcast(docs.sparkSession.createDataFrame([(r.id, r.y, r.u) for r in picked], marked.schema.add("u", "double")))
    text = F.coalesce(docs[text_col], F.lit(""))
    start = F.floor(uniform("id", seed=seed + 1) * F.greatest(F.length(text) - size + 1, F.lit(1))) + 1
    found = docs.join(chosen, docs[id_col] == chosen["id"]) \
        .select("u", "id", "y", F.substring(text, start.cast("int"), F.lit(size)).alias("t")) \
        .orderBy("u", "id", "y", "t").limit(rows).collect()
    return [r.t.encode() for r in found], np.array([r.y for r in found], np.int64), share


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        where: Column | None = None, rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> Model:
    """A model from the documents that have a label and satisfy ``where``; the id joins the
    labels and picks the sample, nothing else."""
    return train(*sample(docs, labels, label_col, id_col, text_col, where, rows, size))


def scorer(model: Model, spark):
    """Column function: text -> score in [0, 1]. The model (a few hundred kB, a fixed size)
    is broadcast."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def quality_score(texts: pa.Array) -> pa.Array:
        known = shared.value
        logits = by_slice(texts, lambda data, offsets: score_logits(data, offsets, known))
        return pa.array(1 / (1 + np.exp(-np.clip(logits, -500, 500))), pa.float64())

    return quality_score
