"""Byte-level BPE: encoding by a rank file and decoding to raw bytes.

A text is cut into pre-tokens by the vocabulary's pattern; each pre-token's UTF-8 bytes
are merged pair by pair, lowest rank first. Pre-tokens repeat: the different ones of a slice of
texts are encoded once, all together, a pair of each at a time.

Long texts. A text above ``chunk + overlap`` characters is cut into chunks that overlap by
``overlap`` characters, spread over the cluster and pre-tokenised in parallel. The pattern
only looks ahead, so once two tokenisations share a boundary they agree from there on:
neighbouring chunks are stitched at the first boundary that both have inside the overlap
(boundaries within ``MARGIN`` characters of a chunk's end are not trusted, as the text
beyond could change them). Then the pieces between the stitches are encoded in parallel
and joined in order. A text with a border that has no common boundary (one pre-token
longer than the overlap) is encoded from its start in one go instead; the result is the
same. Texts that occur more than once are encoded once on this path.

Edge cases: null and empty texts have no ids and decode to no bytes; repeated rows and
ties are independent; other columns are kept whatever their names; an id outside the
vocabulary is an error when decoding.
"""

from __future__ import annotations

import base64
import heapq
import re
from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changelake.llm.common import fresh, small_batches, stable, utf8

CHUNK = 32_768
OVERLAP = 1_024
#: The longest look-ahead of a pre-token decision: a contraction such as 're.
MARGIN = 3
#: Pre-tokens of neighbouring texts that are encoded together.
SLICE = 500_000
#: Different pre-tokens of up to so many bytes are merged together, so many of them at most.
WIDTHS, ROWS = (8, 16, 32, 48), 16_384
#: Stands for a pair that has no rank.
NEVER = 1 << 31


@dataclass(frozen=True)
class Vocabulary:
    ranks: dict[bytes, int]
    pattern: str


def load(path: str, pattern: str) -> Vocabulary:
    """A rank file (base64 token and rank per line), read on the driver; tens of thousands of
    entries, broadcast to the workers."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return Vocabulary(ranks, pattern)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: always merge the adjacent pair of lowest rank, leftmost first."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > 48:
        return _merge_long(piece, ranks)
    get = ranks.get
    parts = [piece[i:i + 1] for i in range(len(piece))]
    pairs = [get(piece[i:i + 2], NEVER) for i in range(len(piece) - 1)]
    while pairs and (best := min(pairs)) < NEVER:
        at = pairs.index(best)
        parts[at] = joined = parts[at] + parts.pop(at + 1)
        del pairs[at]
        if at:
            pairs[at - 1] = get(parts[at - 1] + joined, NEVER)
        if at < len(pairs):
            pairs[at] = get(joined + parts[at + 1], NEVER)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap, so a very long pre-token takes n log n steps."""
    n = len(piece)
    end = list(range(1, n + 1))         # end of the part that starts here; 0 once merged away
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        mid = end[i]
        if not mid or mid >= n or end[mid] != stop:
            continue                    # one of the two parts has changed since
        end[i], end[mid] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (j := before[i]) >= 0 and (r := ranks.get(piece[j:stop])) is not None:
            heapq.heappush(heap, (r, j, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


def ascii_pattern(pattern: str) -> re.Pattern | None:
    """What the pattern means on ASCII text, for the standard library's faster matcher; None
    if it uses a property other than letters and numbers."""
    plain = re.sub(r"\[[^\]]*\]", lambda m: m[0].replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9"), pattern)
    plain = plain.replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
    return None if r"\p" in plain.lower() else re.compile(plain, re.ASCII)


class _Cache:
    """What a worker keeps of a vocabulary: its tokens, numbered in the order of their ranks, and
    the pairs of tokens that make another one."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(vocabulary.pattern)
        self.ascii = ascii_pattern(vocabulary.pattern) or self.pattern
        ranks = vocabulary.ranks
        tokens = sorted(ranks, key=ranks.__getitem__)
        if len(set(ranks.values())) < len(tokens):
            raise ValueError("two tokens have the same rank")
        self.whole = pa.array(tokens, pa.binary())
        single = [bytes([b]) for b in range(256)]
        tokens += [b for b in single if b not in ranks]
        number = {t: n for n, t in enumerate(tokens)}
        self.none = len(tokens)         # no part, and a pair that makes no token
        self.ids = np.array([ranks.get(t, -1) for t in tokens], np.int32)
        self.single = np.array([number[b] for b in single], np.int32)
        pairs = {left * (self.none + 1) + right: n for t, n in number.items() for i in range(1, len(t))
                 if (left := number.get(t[:i])) is not None and (right := number.get(t[i:])) is not None}
        keys = np.array([*pairs, np.iinfo(np.int64).max], np.int64)
        order = keys.argsort()
        self.keys, self.made = keys[order], np.array([*pairs.values(), self.none], np.int32)[order]
        self.first = self.joined(np.repeat(self.single, 256), np.tile(self.single, 256))

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The number of the token that each pair of parts makes, or ``none``."""
        key = left.astype(np.int64) * (self.none + 1) + right
        at = self.keys.searchsorted(key)
        return np.where(self.keys[at] == key, self.made[at], np.int32(self.none))

    def tokens(self, text: str, start: int = 0) -> list[str]:
        return (self.ascii if text.isascii() else self.pattern).findall(text, start)

    def piece(self, text: str, start: int, stop: int) -> list[str]:
        """Pre-tokens between two boundaries; the text beyond ``stop`` stays in sight of the pattern."""
        tokens = self.tokens(text, start)
        ends = list(accumulate(map(len, tokens), initial=start))
        return tokens[:bisect_left(ends, stop)]

    def encode(self, text: str) -> bytes:
        """Ids of a text as 32-bit bytes."""
        return self.encode_all([self.tokens(text)]).values.to_numpy().tobytes()

    def encode_all(self, rows: Iterable[list[str]]) -> pa.ListArray:
        """Ids of each row of pre-tokens, about ``SLICE`` pre-tokens at a time."""
        out, tokens, ends = [], [], [0]
        for row in rows:
            tokens += row
            ends.append(len(tokens))
            if len(tokens) >= SLICE:
                out.append(self._slice(tokens, ends))
                tokens, ends = [], [0]
        return pa.concat_arrays([*out, self._slice(tokens, ends)])

    def _slice(self, tokens: list[str], ends: list[int]) -> pa.ListArray:
        """Each different pre-token is encoded once; its ids are then copied to where it occurs."""
        words = pa.array(tokens, pa.string()).dictionary_encode()
        lists, place = self._different(words.dictionary)
        ids = lists.take(pa.array(place[words.indices.to_numpy()]))
        return pa.ListArray.from_arrays(ids.offsets.take(pa.array(ends, pa.int32())), ids.values)

    def _different(self, words: pa.Array) -> tuple[pa.ListArray, np.ndarray]:
        """(ids of the pre-tokens in an order of their own, the place of each in it)."""
        data, offsets = utf8(words)
        sizes = np.diff(offsets)
        known = pc.index_in(words.cast(pa.binary()), value_set=self.whole).fill_null(-1).to_numpy()
        rows = np.flatnonzero(known >= 0)
        order, ids, counts = [rows], [self.ids[known[rows]]], [np.ones(len(rows), np.int64)]
        rest = np.flatnonzero(known < 0)
        rest = rest[sizes[rest].argsort(kind="stable")]
        a = 0
        for width in WIDTHS:
            stop = int(sizes[rest].searchsorted(width, "right"))
            for start in range(a, stop, ROWS):
                rows = rest[start:min(start + ROWS, stop)]
                merged, n = self._merge(data, offsets[rows], sizes[rows], width)
                order, ids, counts = [*order, rows], [*ids, merged], [*counts, n]
            a = stop
        for i in rest[a:].tolist():
            merged = merge(data[offsets[i]:offsets[i + 1]].tobytes(), self.vocabulary.ranks)
            order.append(np.array([i])), ids.append(np.array(merged, np.int32)), counts.append(np.array([len(merged)]))
        place = np.empty(len(words), np.int64)
        place[np.concatenate(order)] = np.arange(len(words))
        ends = np.concatenate([[0], *counts]).cumsum().astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids))), place

    def _merge(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of many pre-tokens, how many each has). Each round merges the lowest, leftmost pair
        of every pre-token that still has one. The parts stand where they start, from place 1;
        place 0 and those behind the end are no part."""
        n, step = len(sizes), width + 2
        places = np.arange(step)
        used = (places >= 1) & (places <= sizes[:, None])
        raw = np.zeros((n, step), np.int64)
        raw[used] = data[(starts[:, None] + places - 1)[used]]
        parts = np.where(used, self.single[raw], np.int32(self.none)).ravel()
        pairs = np.full((n, step), self.none, np.int32)
        pairs[:, :-1] = np.where(used[:, :-1] & used[:, 1:], self.first[raw[:, :-1] * 256 + raw[:, 1:]], np.int32(self.none))
        after, before = np.tile(places + 1, n), np.tile(places - 1, n)
        row = np.arange(n) * step
        while len(row):
            at = pairs.argmin(axis=1)
            best = pairs[np.arange(len(row)), at]
            live = best < self.none
            if not live.all():
                pairs, row, at, best = pairs[live], row[live], at[live], best[live]
            i, gone, ahead = np.arange(len(row)), after[row + at], before[row + at]
            behind = after[row + gone]
            parts[row + at], parts[row + gone] = best, self.none
            after[row + at], before[row + behind] = behind, at
            pairs[i, gone] = self.none
            pairs[i, at] = self.joined(best, parts[row + behind])
            pairs[i, ahead] = self.joined(parts[row + ahead], best)
        left = parts.reshape(n, step) != self.none
        ids = self.ids[parts[left.ravel()]]
        if (ids < 0).any():
            raise KeyError("a byte is not in the vocabulary")
        return ids, left.sum(axis=1)


def _encoder(shared):
    @F.arrow_udf("array<int>")
    def bpe_ids(texts: pa.Array) -> pa.Array:
        cache = shared.value
        return cache.encode_all(cache.tokens(t.as_py() or "") for t in texts)
    return bpe_ids


def _piece_encoder(shared):
    @F.arrow_udf("array<int>")
    def piece_ids(chunks: pa.Array, starts: pa.Array, stops: pa.Array) -> pa.Array:
        cache = shared.value
        return cache.encode_all(cache.piece(c.as_py(), *row) for c, *row in zip(chunks, starts.to_pylist(), stops.to_pylist()))
    return piece_ids


def _chunks(chunk: int, overlap: int):
    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array) -> pa.Array:
        return pa.array([[t[a:a + chunk + overlap] for a in range(0, len(t) - overlap, chunk)]
                         for t in (x.as_py() for x in texts)], pa.list_(pa.string()))
    return cut


def _borders(shared, chunk: int, overlap: int):
    """(boundaries in the first ``overlap`` characters, trusted ones in the last)."""
    kind = pa.struct([("head", pa.list_(pa.int32())), ("tail", pa.list_(pa.int32()))])

    @F.arrow_udf("head array<int>, tail array<int>")
    def borders(chunks: pa.Array) -> pa.Array:
        pattern, out = shared.value.pattern, []
        for c in chunks:
            text = c.as_py()
            ends = [m.end() for m in pattern.finditer(text)]
            out.append({"head": [0] + [e for e in ends if e < overlap and e <= len(text) - MARGIN],
                        "tail": [e - chunk for e in ends if chunk <= e <= len(text) - MARGIN]})
        return pa.array(out, kind)
    return borders


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", out_col: str = "ids",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` with the column ``out_col`` (array of int) added, which they must not have yet."""
    if out_col.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the documents have a column {out_col} already: name another out_col")
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(_Cache(vocabulary))
    ids = _encoder(shared)
    length = F.coalesce(F.length(text_col), F.lit(0))
    short = docs.where(length <= chunk + overlap).withColumn(out_col, ids(F.col(text_col)))
    key = fresh(docs, "text_key")
    long = docs.where(length > chunk + overlap).withColumn(key, F.sha2(F.col(text_col), 256))
    texts = long.select(F.col(key).alias("k"), F.col(text_col).alias("t")).dropDuplicates(["k"])
    pieces = texts.select("k", F.posexplode(_chunks(chunk, overlap)("t")).alias("i", "c"))
    # Neighbouring chunks of one text go to different tasks.
    pieces = pieces.repartition("k", "i").withColumn("b", _borders(shared, chunk, overlap)("c"))
    pieces = stable(pieces.select("k", "i", "c", "b.head", "b.tail"))
    order = Window.partitionBy("k").orderBy("i")
    cut = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
    marks = pieces.withColumn("stop", cut).withColumn("last", F.lead("i").over(order).isNull()) \
        .withColumn("start", F.coalesce(F.lag("stop").over(order), F.lit(0)))
    marks = marks.withColumn("stitched", F.min(F.col("last") | F.col("stop").isNotNull()).over(Window.partitionBy("k"))) \
        .select("k", "i", "start", "stop", "last", "stitched")
    parts = pieces.select("k", "i", "c").join(marks.where("stitched"), ["k", "i"])
    until = F.when(F.col("last"), F.length("c")).otherwise(F.col("stop") + chunk)
    encoded = parts.select("k", "i", _piece_encoder(shared)("c", "start", until).alias("x")) \
        .groupBy("k").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"])).alias("x"))
    broken = marks.where(~F.col("stitched")).select("k").distinct()
    whole = texts.join(broken, "k", "left_semi").select("k", ids("t").alias("x"))
    found = encoded.unionByName(whole).withColumnRenamed("k", fresh(long, "k")).withColumnRenamed("x", fresh(long, "x"))
    k, x = found.columns
    done = long.join(found, F.col(key) == F.col(k)).select(*(long[c] for c in docs.columns), F.col(x).alias(out_col))
    return short.unionByName(done)


def decode(rows: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", out_col: str = "bytes") -> DataFrame:
    """``rows`` with ``out_col``: the raw bytes of the ids, one after the other."""
    size = max(vocabulary.ranks.values()) + 1
    tokens = [b""] * size
    known = np.zeros(size, bool)
    for token, rank in vocabulary.ranks.items():
        tokens[rank], known[rank] = token, True
    shared = rows.sparkSession.sparkContext.broadcast((tokens, known))

    @F.arrow_udf("binary")
    def raw(ids: pa.Array) -> pa.Array:
        tokens, known = shared.value
        ids = ids.fill_null([]) if ids.null_count else ids
        flat = ids.flatten()
        values = flat.to_numpy(zero_copy_only=False)
        if len(values) and (values.min() < 0 or values.max() >= len(known) or not known[values].all()):
            raise ValueError("an id is not in the vocabulary")
        joined = pa.array(tokens, pa.large_binary()).take(flat)
        at = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1) if len(joined) else np.zeros(1, np.int64)
        sizes = np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy())]).astype(np.int64)
        data = joined.buffers()[2].to_pybytes() if len(joined) else b""
        ends = at[sizes].tolist()
        return pa.array([data[a:b] for a, b in zip(ends, ends[1:])], pa.binary())

    return rows.withColumn(out_col, raw(F.col(ids_col)))
