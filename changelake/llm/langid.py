"""Language identification by a byte convolutional network.

A text's UTF-8 bytes are cut into fixed-length windows (the last one padded with zeros).
Each byte has a learned vector; filters of several widths slide over the window, each
filter's largest value is kept (max pooling), rectified, and a softmax layer gives the
languages' probabilities. A text's log-probabilities are the mean over its windows,
weighted by the bytes each holds; every window of every text is read.

The network is trained in numpy on the driver, on a bounded sample of labelled texts
(``sample_rows`` texts, about as many of each language, ``sample_bytes`` from a
hash-chosen place of each). It has a fixed, small size and is broadcast.

Edge cases: null texts and texts without a letter are ``und`` with score 0; no labelled
text at all makes every text ``und``; one language only gives that language with score 1;
ties between languages go to the one first in order; repeated rows get the same answer;
other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import slices, small_batches, uniform, utf8

WINDOW = 128
DIM = 8
WIDTHS = (2, 3, 4)
FILTERS = 12
SAMPLE_ROWS = 1600
SAMPLE_BYTES = 1024
UNDETERMINED = "und"
#: Windows in one matrix product.
BLOCK = 256


@dataclass(frozen=True)
class Network:
    languages: list[str]
    vectors: np.ndarray              # (256, DIM)
    filters: list[np.ndarray]        # per width: (width * DIM, FILTERS)
    shifts: np.ndarray               # (len(WIDTHS) * FILTERS,)
    layer: np.ndarray                # (len(WIDTHS) * FILTERS, languages)
    bias: np.ndarray


def windows(data: np.ndarray, offsets: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows as rows of bytes, owner text of each, bytes that each holds)."""
    lengths = np.diff(offsets)
    counts = -(-lengths // size)
    owner = np.repeat(np.arange(len(lengths)), counts)
    if not len(owner):
        return np.empty((0, size), np.uint8), owner, np.empty(0, np.int64)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[:-1][owner] + nth * size
    held = np.minimum(lengths[owner] - nth * size, size)
    place = np.arange(size)
    padded = np.concatenate([data, np.zeros(size, np.uint8)])
    rows = padded[start[:, None] + place]
    short = held < size
    rows[short] = np.where(place < held[short, None], rows[short], 0)
    return rows, owner, held


def _pool(net: Network, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(pooled values before rectifying, place of each maximum by width, byte vectors)."""
    seen = net.vectors[rows]                                       # (n, WINDOW, DIM)
    n, size, dim = seen.shape
    pooled, places = [], []
    for width, weights in zip(WIDTHS, net.filters):
        patches = np.lib.stride_tricks.sliding_window_view(seen.reshape(n, size * dim), width * dim, axis=1)[:, ::dim]
        values = patches.reshape(-1, width * dim) @ weights
        values = values.reshape(n, size - width + 1, FILTERS)
        at = values.argmax(axis=1)
        places.append(at)
        pooled.append(np.take_along_axis(values, at[:, None, :], axis=1)[:, 0])
    return np.concatenate(pooled, axis=1) + net.shifts, places, seen


def _log_softmax(logits: np.ndarray) -> np.ndarray:
    logits = logits - logits.max(axis=1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))


def log_probabilities(net: Network, rows: np.ndarray) -> np.ndarray:
    """Of each language for each window: only the largest filter values are needed here."""
    out = np.empty((len(rows), len(net.languages)), np.float32)
    for k in range(0, len(rows), BLOCK):
        part = rows[k:k + BLOCK]
        seen = net.vectors[part].reshape(len(part), -1)
        pooled = []
        for width, weights in zip(WIDTHS, net.filters):
            patches = np.lib.stride_tricks.sliding_window_view(seen, width * DIM, axis=1)[:, ::DIM]
            values = patches.reshape(-1, width * DIM) @ weights
            pooled.append(values.reshape(len(part), -1, FILTERS).max(axis=1))
        hidden = np.maximum(np.concatenate(pooled, axis=1) + net.shifts, 0)
        out[k:k + BLOCK] = _log_softmax(hidden @ net.layer + net.bias)
    return out


def train(texts: list[bytes], labels: list[str], epochs: int = 6, batch: int = 64, rate: float = 0.01,
          seed: int = 5) -> Network:
    """Softmax cross-entropy on single windows by Adam steps. A part of the windows is cut
    short, so that short texts are known too."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    kinds, hidden = len(languages), len(WIDTHS) * FILTERS
    net = Network(languages, rng.normal(0, 1, (256, DIM)).astype(np.float32),
                  [rng.normal(0, (w * DIM) ** -0.5, (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
                  np.zeros(hidden, np.float32), rng.normal(0, hidden ** -0.5, (hidden, kinds)).astype(np.float32),
                  np.zeros(kinds, np.float32))
    net.vectors[0] = 0
    if kinds < 2:
        return net
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    rows, owner, held = windows(np.frombuffer(b"".join(texts), np.uint8), offsets)
    answer = np.searchsorted(languages, labels)[owner]
    weights = [net.vectors, *net.filters, net.shifts, net.layer, net.bias]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), batch):
            pick = order[k:k + batch]
            part = rows[pick].copy()
            cut = np.where(rng.random(len(pick)) < 0.3, rng.integers(16, WINDOW + 1, len(pick)), WINDOW)
            part[np.arange(WINDOW) >= cut[:, None]] = 0
            pooled, places, seen = _pool(net, part)
            active = np.maximum(pooled, 0)
            delta = np.exp(_log_softmax(active @ net.layer + net.bias))
            delta[np.arange(len(pick)), answer[pick]] -= 1
            delta /= len(pick)
            back = (delta @ net.layer.T) * (pooled > 0)
            to_vectors = np.zeros_like(net.vectors)
            to_filters = []
            for j, (width, filters) in enumerate(zip(WIDTHS, net.filters)):
                flow = back[:, j * FILTERS:(j + 1) * FILTERS]                      # (n, FILTERS)
                spots = places[j][:, :, None] + np.arange(width)                   # (n, FILTERS, width)
                who = np.arange(len(pick))[:, None, None]
                patches = seen[who, spots].reshape(len(pick), FILTERS, width * DIM)
                to_filters.append(np.einsum("nf,nfk->kf", flow, patches))
                spread = np.einsum("nf,kf->nfk", flow, filters).reshape(-1, DIM)
                np.add.at(to_vectors, part[who, spots].reshape(-1), spread)
            to_vectors[0] = 0
            slopes = [to_vectors, *to_filters, back.sum(axis=0), active.T @ delta, delta.sum(axis=0)]
            step += 1
            for w, g, a, b in zip(weights, slopes, first, second):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                w -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)
    return net


def sample(docs: DataFrame, text_col: str, lang_col: str, key_col: str, rows: int = SAMPLE_ROWS,
           size: int = SAMPLE_BYTES, seed: int = 3) -> tuple[list[bytes], list[str]]:
    """At most ``rows`` labelled texts, about as many of each language; the key only picks."""
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")) \
        .select(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("y"), F.col(key_col).cast("string").alias("key"))
    counts = docs.where(F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).cast("string").alias("y")) \
        .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "y").limit(rows).collect()
    if not counts:
        return [], []
    quota = F.create_map(*(x for r in counts for x in (F.lit(r.y), F.lit(rows / len(counts) / r.n))))[F.col("y")]
    start = F.floor(uniform("key", seed=seed + 1) * F.greatest(F.length("t") - size + 1, F.lit(1))) + 1
    found = usable.withColumn("u", uniform("key", seed=seed)).where(F.col("u") < quota) \
        .select("u", "key", "y", F.substring("t", start.cast("int"), F.lit(size)).alias("t")) \
        .orderBy("u", "key", "y", "t").limit(rows).collect()
    return [r.t.encode()[:size] for r in found], [r.y for r in found]


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id",
        rows: int = SAMPLE_ROWS, size: int = SAMPLE_BYTES) -> Network:
    return train(*sample(docs, text_col, lang_col, key_col, rows, size))


def predict(docs: DataFrame, net: Network, text_col: str = "text", lang_out: str = "lang_pred",
            score_out: str = "score") -> DataFrame:
    """``docs`` with the likeliest language and its probability."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("lang string, score double")
    def language(texts: pa.Array) -> pa.Array:
        net = shared.value
        data, offsets = utf8(texts)
        best, share = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        for a, b in slices(offsets):
            rows, owner, held = windows(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            logs = log_probabilities(net, rows) * held[:, None]
            total = np.zeros((b - a, len(net.languages)))
            np.add.at(total, owner, logs)
            p = np.exp(_log_softmax(total / np.maximum(np.diff(offsets[a:b + 1]), 1)[:, None]))
            best[a:b], share[a:b] = p.argmax(axis=1), p.max(axis=1)
        return pa.StructArray.from_arrays([pa.array(np.array(net.languages, object)[best], pa.string()),
                                           pa.array(share)], fields=list(kind))

    known = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)) if net.languages else F.lit(False)
    answer = language(F.col(text_col)) if net.languages else F.struct(F.lit("").alias("lang"), F.lit(0.0).alias("score"))
    return docs.withColumns({lang_out: F.when(known, answer["lang"]).otherwise(F.lit(UNDETERMINED)),
                             score_out: F.when(known, answer["score"]).otherwise(F.lit(0.0))})
