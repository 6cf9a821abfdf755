"""Document fingerprints by consistent weighted sampling.

A text's terms are its words, weighted by how many of its characters they make up (count
times length), so that rare long words tell more than common short ones. For each lane
and term, hashes of the term give r and c from Gamma(2, 1) and b uniform; with weight S,
t = floor(ln S / r + b), ln y = r (t - b) and ln a = ln c - ln y - r. The lane's sample is
the pair (term, t) of the smallest a. Two texts agree in a lane with a probability equal to
the generalised Jaccard similarity of their weighted terms, so the share of equal lanes
estimates it. Lanes are kept as 16-bit codes, which agree by chance once in 65,536.

Within a batch every distinct (term, count) is sampled once for all texts that hold it. Long
texts are cut into terms in pieces between words, whose counts are added up.

Edge cases: null and empty texts and texts of white space only have no terms; their
fingerprint is all zeros, their likeness 1 to each other and 0 to any other text. Terms are
told apart by 64 bits of a hash of all their bytes; their length is counted in characters and
without limit. Repeated rows agree; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import slices, small_batches, text_or_empty, utf8

LANES = 64
#: Bytes that are cut into terms at once (more only where no word ends).
PIECE = 4 << 20
#: (text, term) pairs, and distinct (term, count), handled at once.
PAIRS = 1 << 14
CELLS = 1 << 11
#: Bytes of own and edited texts that are sampled together; they share most terms.
SHARED_BYTES = 10 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(step: int) -> np.ndarray:
    """256 powers of the hash's base, ``step`` apart."""
    out, x = np.empty(256, np.uint64), 1
    for i in range(256):
        out[i] = x
        x = x * pow(0x9E3779B97F4A7C15, step, 1 << 64) % (1 << 64)
    return out


#: Powers by each byte of an exponent below 2^32.
POWERS = [_powers(256 ** k) for k in range(4)]


def _power(place: np.ndarray) -> np.ndarray:
    out, left = POWERS[0][place & 255], place >> 8
    for table in POWERS[1:]:
        far = np.flatnonzero(left)                      # few words reach 256 bytes
        if not len(far):
            break
        out[far] *= table[left[far] & 255]
        left = left >> 8
    return out


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, length, count) of each distinct word of each text, in one pass."""
    solid = data > 32
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | first[1:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    place = np.arange(len(data)) - starts[np.maximum(np.cumsum(begins) - 1, 0)]
    parts = np.where(solid, (data.astype(np.uint64) + np.uint64(1)) * _power(np.where(solid, place, 0)), np.uint64(0))
    hashes = _mix(np.add.reduceat(parts, starts, dtype=np.uint64))
    lengths = np.add.reduceat(solid & (data & 0xC0 != 0x80), starts, dtype=np.int64)    # bytes that begin a character
    owner = np.searchsorted(offsets, starts, "right") - 1
    distinct, at, number = np.unique(hashes, return_index=True, return_inverse=True)
    keys = owner << 32 | number
    keys.sort()
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.concatenate([new, [len(keys)]]))
    number = keys[new] & 0xFFFFFFFF
    return keys[new] >> 32, distinct[number], lengths[at[number]], counts


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, length, count) of each distinct word of each text. Words are runs of bytes
    above the space, so characters are never cut."""
    if len(data) <= 2 * PIECE:
        return _words(data, offsets)
    found, a = [], 0
    while a < len(data):
        b = min(a + PIECE, len(data))
        while b < len(data):                            # to the end of the word at the border
            space = np.flatnonzero(data[b:b + PIECE] <= 32)
            b = b + int(space[0]) if len(space) else min(b + PIECE, len(data))
            if len(space):
                break
        inside = offsets[(offsets > a) & (offsets < b)]
        owner, *rest = _words(data[a:b], np.concatenate([[0], inside - a, [b - a]]))
        found.append((owner + np.searchsorted(offsets, a, "right") - 1, *rest))
        a = b
    owner, term, length, count = (np.concatenate(x) for x in zip(*found))
    if not len(owner):
        return owner, term, length, count
    by = np.lexsort((term, owner))
    owner, term, length, count = owner[by], term[by], length[by], count[by]
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (term[1:] != term[:-1])]))
    return owner[new], term[new], length[new], np.add.reduceat(count, new)


def _gamma_quantiles(n: int = 1 << 16) -> np.ndarray:
    """Quantiles of Gamma(2, 1) at (i + 1/2) / n, by Newton steps on 1 - (1 + x) exp(-x)."""
    q = (np.arange(n) + 0.5) / n
    x = np.sqrt(2 * q) + q
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - q) / (x * np.exp(-x)), x / 2)
    return x.astype(np.float32)


QUANTILES = _gamma_quantiles()


def samples(term: np.ndarray, weight: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """For each (term, weight) and lane: ln a as an ordered 32-bit number in the high half,
    the code of (term, t) in the low half. One 64-bit hash a cell: 32 bits make c (minus the
    logarithm of two uniform numbers' product), 16 pick r's quantile, 16 are b."""
    out = np.empty((len(term), lanes), np.int64)
    lane = _mix(np.arange(1, lanes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    logs = np.log(weight.astype(np.float64)).astype(np.float32)[:, None]
    seeds = _mix(term * np.uint64(0xD1342543DE82EF95) + np.uint64(1))[:, None]
    half = np.float32(0.5)
    for k in range(0, len(term), CELLS):
        bits = _mix(seeds[k:k + CELLS] ^ lane)
        parts = bits.view(np.uint16).reshape(*bits.shape, 4)
        r = QUANTILES[parts[..., 0]]
        b = (parts[..., 1] + half) * np.float32(2.0 ** -16)
        log_c = np.log(-np.log((parts[..., 2] + half) * (parts[..., 3] + half) * np.float32(2.0 ** -32)))
        t = np.floor(logs[k:k + CELLS] / r + b)
        raw = (log_c - r * (t - b) - r).view(np.int32)
        ordered = (raw ^ ((raw >> 31) & np.int32(0x7FFFFFFF))).astype(np.int64)
        code = (bits ^ t.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
        out[k:k + CELLS] = ordered << np.int64(32) | (code >> np.uint64(32)).view(np.int64)
    return out


def signatures(data: np.ndarray, offsets: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """16-bit codes, one row per text of a byte buffer."""
    out = np.zeros((len(offsets) - 1, lanes), np.uint16)
    text, term, length, count = terms(data, offsets)
    if not len(text):
        return out
    # A term has one length, so a distinct (term, count) has one weight.
    _, number = np.unique(term, return_inverse=True)
    _, at, where = np.unique(number << 32 | count, return_index=True, return_inverse=True)
    table = samples(term[at], np.maximum(length[at], 1) * count[at], lanes)
    best = np.full((len(offsets) - 1, lanes), np.iinfo(np.int64).max)
    for k in range(0, len(text), PAIRS):
        part = text[k:k + PAIRS]
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        low = np.minimum.reduceat(table[where[k:k + PAIRS]], starts, axis=0)
        best[part[starts]] = np.minimum(best[part[starts]], low)
    have = np.unique(text)
    codes = (best[have] & 0xFFFF).astype(np.uint16)
    codes[:, 0] |= (codes == 0).all(axis=1)      # all zeros mean no terms
    out[have] = codes
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal lanes, row by row."""
    none_a, none_b = ~a.any(axis=1), ~b.any(axis=1)
    return np.where(none_a | none_b, (none_a & none_b).astype(np.float64), (a == b).mean(axis=1))


def texts_signatures(texts: list[str], lanes: int = LANES) -> np.ndarray:
    data, offsets = utf8(pa.array(texts, pa.large_string()))
    parts = [signatures(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], lanes) for a, b in slices(offsets, SHARED_BYTES)]
    return np.concatenate(parts) if parts else np.zeros((0, lanes), np.uint16)


def as_hex(codes: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in codes]


def fingerprint(lanes: int = LANES):
    """Column function: text -> fingerprint as hex digits, four a lane."""

    @F.arrow_udf("string")
    def weighted_samples(texts: pa.Array) -> pa.Array:
        return pa.array(as_hex(texts_signatures(texts.to_pylist(), lanes)), pa.string())

    return weighted_samples


def edited(text: str, following: str) -> str:
    """``text`` with its second half replaced by the beginning of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


COMPARED = ("id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double")


def _compare(rows: Iterator[tuple], lanes: int) -> Iterator[pa.RecordBatch]:
    """Over rows (bucket, halo, id, text) in order: each row against the one after it. A
    bucket's halo row comes last, stands for the next bucket's first and gives no result."""
    schema = pa.schema([("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                        ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def flush(pairs):
        texts = [text for _, text, _ in pairs]
        changed = [edited(text, after) for _, text, after in pairs]
        # A row's successor is mostly the next row; only others are sampled on their own.
        apart = [i for i, (_, _, after) in enumerate(pairs) if i + 1 == len(pairs) or pairs[i + 1][1] is not after]
        codes = texts_signatures(texts + changed + [pairs[i][2] for i in apart], lanes)
        n = len(pairs)
        own, new = codes[:n], codes[n:2 * n]
        follow = np.concatenate([own[1:], own[:1]])
        follow[apart] = codes[2 * n:]
        return pa.RecordBatch.from_arrays([
            pa.array([i for i, _, _ in pairs], pa.int64()), pa.array(map(len, texts), pa.int64()),
            pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed], pa.string()),
            pa.array(as_hex(own), pa.string()), pa.array(as_hex(new), pa.string()),
            pa.array(likeness(own, new)), pa.array(likeness(own, follow))], schema=schema)

    pairs, size, last, ended = [], 0, None, None
    for bucket, halo, key, text in rows:
        if bucket == ended:
            continue                      # further rows that share the halo's id
        if last is not None:
            pairs.append((last[0], last[1], text))
            size += len(last[1])
            if len(pairs) >= 4000 or size >= SHARED_BYTES // 2:
                yield flush(pairs)
                pairs, size = [], 0
        last = None if halo else (key, text)
        ended = bucket if halo else None
    if pairs:
        yield flush(pairs)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lanes: int = LANES,
                      buckets: int | None = None) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text (second half replaced by
    the beginning of the next document, in ascending id; the last one's next is the first), and
    how alike its fingerprint is to the edited text's and to the next document's.

    Ids are cut into ranges at approximate quantiles; each range is sorted and read once, with
    the first row of the next range as a halo. Rows of one id are ordered by text; null ids
    come first; a single document is its own successor."""
    spark = docs.sparkSession
    small_batches(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or 4 * tasks           # several ranges a task, which evens tasks out
    rank = F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63)))
    ids = docs.select(rank.alias("rank"))
    cuts = ids.agg(F.percentile_approx("rank", [i / buckets for i in range(1, buckets)] or [0.5], 10 * buckets)).first()[0]
    bounds = spark.sparkContext.broadcast(np.array(sorted(set(cuts or [])), np.int64))

    @F.arrow_udf("int")
    def bucket_of(ranks: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds.value, ranks.to_numpy(zero_copy_only=False), "right"), pa.int32())

    # One row per range: its first id, and the range before it (the last, for the first).
    firsts = sorted(ids.groupBy(bucket_of("rank").alias("bucket")).agg(F.min("rank").alias("first")).collect())
    halos = [(now.first, before.bucket) for before, now in zip(firsts[-1:] + firsts[:-1], firsts)]
    halo = F.broadcast(spark.createDataFrame(halos, "first bigint, before int"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), rank.alias("rank"), bucket_of(rank).alias("bucket"),
                       text_or_empty(text_col).alias("text")) \
        .join(halo, F.col("rank") == F.col("first"), "left")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("halo"))
    extra = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("halo"))
    rows = rows.select("id", "rank", "text", F.explode(
        F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, extra))).alias("at"))
    rows = rows.select("at.bucket", "at.halo", "id", "rank", "text").repartition(tasks, "bucket") \
        .sortWithinPartitions("bucket", "halo", "rank", "text").select("bucket", "halo", "id", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _compare((row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))), lanes)

    return rows.mapInArrow(compare, COMPARED)
