"""Repeated substrings: blockwise suffix sorting with a difference cover.

Finds every byte covered by a ``LENGTH``-byte string that also starts earlier (smaller id,
or same id and earlier start), over all texts' UTF-8 bytes; strings never cross texts.

1. Buckets. A string's bucket is its smallest hashed ``GRAM``-byte gram (leftmost on ties),
   so equal strings share a bucket. Neighbouring strings mostly share it too: a run of them,
   at most LENGTH - GRAM + 1, is one row of a few numbers (about one row per 40 bytes), with
   a hash of the bytes that the run spans. Runs that occur again within a batch of texts are
   settled there, so a passage in a third of all texts sends one row a batch.
2. Equal runs. Rows are dealt by bucket and sorted; of equal runs all but the earliest are
   repeated in whole. A bucket with one kind of run is settled. The pass keeps one row.
3. Suffix sort. Buckets with several kinds of runs (neighbourhoods of edits and of passage
   ends) get their bytes, and are sorted one block of buckets at a time: by the first bytes
   up to the period of a difference cover, then the long ties by the ranks of the cover's
   sample positions, computed for the block beforehand: for any two suffixes a shift below
   the period takes both to sample positions. A block has a bounded size. Neighbours in the
   order that agree in LENGTH bytes are equal strings; all but the earliest are repeated.
4. A bucket with more than ``MANY`` kinds of runs is not sorted in one task: its strings are
   dealt one by one, by a 128-bit hash, after the same settling within batches.
5. Spans are joined per text and cut out.

Runs are compared by 48 bits of a hash besides the 64 bits of the bucket, strings of step 4
by 128 bits; step 3 compares bytes.

Edge cases: null and empty texts have no bytes, texts shorter than LENGTH no strings; null
ids come before all others; rows with the same id count as one document, so of two rows that
repeat an id and text neither loses the other's bytes, and each gets the same result, and
different texts under one id are numbered exactly (up to 2^31 under one id); other columns are
never read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import small_batches, stable, text_or_empty, utf8

LENGTH = 100
GRAM = 28
#: Kinds of runs in a bucket up to which one task sorts it.
MANY = 4096
#: Bytes of a block whose buckets are sorted together.
BLOCK_BYTES = 1 << 18
#: Bytes hashed together; positions in it take SPAN_BITS.
SPAN_BITS = 18
#: A perfect difference set: each shift modulo PERIOD is a difference of two members.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)

#: ``place`` is start << 32 | mark. ``same`` of a run is a 48-bit hash << 16 | strings, of a
#: single string 64 bits of a hash; of repeated strings it is their number.
ROW = "kind tinyint, bucket bigint, same bigint, id bigint, place bigint"
RUN, REPEATED = 0, 1
N_BITS = 16
MARK = (1 << 32) - 1


def _schema(text: str) -> pa.Schema:
    kinds = {"tinyint": pa.int8(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in text.split(", "))])


ROW_SCHEMA = _schema(ROW)


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


# 1. Buckets ---------------------------------------------------------------------------------

MULTIPLIER = 0x9E3779B97F4A7C15
BYTE_CODES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(MULTIPLIER, n, 1 << 64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


UP = _powers(MULTIPLIER, 1 << SPAN_BITS)
DOWN = _powers(pow(MULTIPLIER, -1, 1 << 64), 1 << SPAN_BITS)


def _gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the gram at each place: lengths double, then are put together."""
    by_length, size = {1: codes}, 1
    while size * 2 <= gram:
        h = by_length[size]
        by_length[size * 2] = h[:-size] * _power(size) + h[size:]
        size *= 2
    total, done = by_length[size], size
    for part in sorted(by_length, reverse=True):
        while done + part <= gram:
            n = len(codes) - done - part + 1
            total = total[:n] * _power(part) + by_length[part][done:done + n]
            done += part
    total = (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(32))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (width - size)], x[width - size:])


def span_runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) \
        -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of the texts in a short byte buffer: (text, start in the buffer, strings, bucket,
    hash of the run's bytes)."""
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none
    codes = BYTE_CODES[data]
    hashes = _gram_hashes(codes, gram)
    place = np.arange(len(hashes), dtype=np.uint64)
    low = np.uint64((1 << SPAN_BITS) - 1)
    first = (_sliding_min(hashes & ~low | place, length - gram + 1) & low).astype(np.int64)
    lengths = np.diff(offsets)
    owner = np.repeat(np.arange(len(lengths)), lengths)[:len(first)]
    valid = np.arange(len(first)) + length <= offsets[1:][owner]
    at = np.flatnonzero(valid)
    if not len(at):
        return none, none, none, none, none
    anchor = first[at]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[at][1:] != owner[at][:-1])]))
    n = np.diff(np.concatenate([new, [len(at)]]))
    start = at[new]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * UP[:len(codes)], dtype=np.uint64)])
    same = (sums[start + n + length - 1] - sums[start]) * DOWN[start]
    same = (same ^ (same >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) >> np.uint64(16)
    return owner[start], start, n, hashes[anchor[new]].view(np.int64), same.view(np.int64)


def _spans(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple]:
    """Pieces of the texts that fit a span, overlapping by length - 1 bytes where a text is
    longer: (bytes, offsets of the pieces, text of each piece, its place in the text)."""
    room = 1 << SPAN_BITS
    pieces, held = [], 0
    for text, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        for s in range(a, max(b - length + 1, a), room - length + 1):
            e = min(s + room, b)
            if held + e - s > room:
                yield _gather(data, pieces)
                pieces, held = [], 0
            pieces.append((text, s, e, s - a))
            held += e - s
    if pieces:
        yield _gather(data, pieces)


def _gather(data: np.ndarray, pieces: list) -> tuple:
    text, s, e, place = map(np.array, zip(*pieces))
    return np.concatenate([data[a:b] for a, b in zip(s, e)]), np.concatenate([[0], np.cumsum(e - s)]), text, place


def _first_of_equal(bucket, same, ident, place) -> tuple[np.ndarray, np.ndarray]:
    """(order by (bucket, same, id, place), whether each row in that order starts later than
    the first of its kind)."""
    order = np.lexsort((place, ident, same, bucket))
    b, s, i, p = bucket[order], same[order], ident[order], place[order] >> 32
    new = np.concatenate([[True], (b[1:] != b[:-1]) | (s[1:] != s[:-1])]) if len(b) else np.empty(0, bool)
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(b) else np.empty(0, np.int64)
    return order, (i != i[head]) | (p != p[head])


def text_runs(table: pa.RecordBatch, length: int = LENGTH, gram: int = GRAM) -> pa.RecordBatch:
    """Runs of a batch of texts (id, mark, text), those settled within the batch marked."""
    data, offsets = utf8(table.column("text"))
    ids = table.column("id").to_numpy(zero_copy_only=False)
    marks = table.column("mark").to_numpy(zero_copy_only=False)
    parts = []
    for buffer, borders, text, place in _spans(data, offsets, length):
        piece, start, n, bucket, same = span_runs(buffer, borders, length, gram)
        parts.append((text[piece], place[piece] + start - borders[:-1][piece], n, bucket, same) if len(piece) else
                     (piece, start, n, bucket, same))
    if not parts:
        return _batch(ROW_SCHEMA, *[[]] * 5)
    text, start, n, bucket, same = (np.concatenate(x) for x in zip(*parts))
    return _settle(bucket, same << N_BITS | n, ids[text], start << 32 | marks[text].astype(np.int64), n)


def _settle(bucket, same, ident, place, n) -> pa.RecordBatch:
    """Rows of a batch: of equal ones the first as they are; the others are repeated, and
    those that follow each other in a text are put together."""
    order, later = _first_of_equal(bucket, same, ident, place)
    first, rest = order[~later], order[later]
    rest = rest[np.lexsort((place[rest] >> 32, place[rest] & MARK, ident[rest]))]
    i, p, m = ident[rest], place[rest], n[rest]
    new = np.ones(len(rest), bool)
    new[1:] = (i[1:] != i[:-1]) | (p[1:] != p[:-1] + (m[:-1] << 32))
    at = np.flatnonzero(new)
    counts = np.add.reduceat(m, at) if len(at) else m
    # A repeated row only passes through: deal it by its place.
    return _batch(ROW_SCHEMA, np.repeat(np.array([RUN, REPEATED], np.int8), [len(first), len(at)]),
                  np.concatenate([bucket[first], i[at] * 31 + (p[at] >> 32)]), np.concatenate([same[first], counts]),
                  np.concatenate([ident[first], i[at]]), np.concatenate([place[first], p[at]]))


# 2. Equal runs ------------------------------------------------------------------------------

def _equal_runs(batches: Iterator[pa.RecordBatch], single: bool) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by (kind, bucket, same, id, place): later equal runs (or single strings)
    become repeated; first ones stay if their bucket has another row."""
    head = None              # (bucket, same, id, start) of the current kind's first row
    held, held_met = None, False   # the last first row, and whether its bucket has another before it
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        settled = columns[0] == REPEATED
        out = [[x[settled] for x in columns]]
        rows = [x[~settled] for x in columns]
        if len(rows[0]):
            kind, b, s, i, place = rows
            p = place >> 32
            new = np.concatenate([[head is None or (b[0], s[0]) != head[:2]], (b[1:] != b[:-1]) | (s[1:] != s[:-1])])
            at = np.concatenate([[-1], np.flatnonzero(new)])[np.cumsum(new)]
            first_i, first_p = i[at], p[at]
            if not new[0]:
                first_i, first_p = np.where(at < 0, head[2], first_i), np.where(at < 0, head[3], first_p)
            later = (i != first_i) | (p != first_p)
            head = (b[-1], s[-1], first_i[-1], first_p[-1])
            n = np.ones(int(later.sum()), np.int64) if single else s[later] & ((1 << N_BITS) - 1)
            out.append([np.full(len(n), REPEATED, np.int8), b[later], n, i[later], place[later]])
            firsts = [x[~later] for x in rows]
            if held is not None:
                firsts = [np.concatenate([h, f]) for h, f in zip(held, firsts)]
            if len(firsts[0]):
                fb = firsts[1]
                met = np.concatenate([[held_met and held is not None], fb[1:] == fb[:-1]])
                shared = met.copy()
                shared[:-1] |= fb[1:] == fb[:-1]
                out.append([x[:-1][shared[:-1]] for x in firsts])
                held, held_met = [x[-1:] for x in firsts], bool(met[-1])
        yield _batch(ROW_SCHEMA, *(np.concatenate(x) for x in zip(*out)))
    if held is not None and held_met:
        yield _batch(ROW_SCHEMA, *held)


def _settle_all(rows: DataFrame, single: bool = False) -> DataFrame:
    """Rows of ``ROW`` dealt by bucket; what is left of them as described above."""
    return rows.repartition("bucket").sortWithinPartitions("kind", "bucket", "same", "id", "place") \
        .mapInArrow(lambda batches: _equal_runs(batches, single), ROW)


# 3. Suffix sort -----------------------------------------------------------------------------

def _shifts() -> np.ndarray:
    member = np.isin(np.arange(PERIOD), COVER)
    out = np.full((PERIOD, PERIOD), -1)
    for d in range(PERIOD - 1, -1, -1):
        both = np.roll(member, -d)
        out[np.ix_(both, both)] = d
    if (out < 0).any():
        raise ValueError("COVER does not cover all differences")
    return out


SHIFTS = _shifts()


def _words(windows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes at each place as a number that sorts like them."""
    return np.ascontiguousarray(windows[at]).view(">u8")[:, 0].astype(np.uint64)


def _refine(order: np.ndarray, group: np.ndarray, keys, done: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sort the members of each group (numbers ascending along ``order``) by ``keys(places,
    groups)`` and split groups where the key changes. Groups of one, and groups whose places
    are ``done``, are left alone."""
    tied = np.zeros(len(order), bool)
    same = group[1:] == group[:-1]
    tied[1:] |= same
    tied[:-1] |= same
    if done is not None:
        tied &= ~done[order]
    at = np.flatnonzero(tied)
    new = np.concatenate([[True], ~same])
    if len(at):
        places, owner = order[at], group[at]
        key = keys(places, owner)
        by = np.lexsort((key, owner))
        order = order.copy()
        order[at] = places[by]
        key = key[by]
        new[at[1:]] |= key[1:] != key[:-1]
    return order, np.cumsum(new) - 1


def suffix_order(data: np.ndarray, places: np.ndarray, bucket: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """``places`` by bucket and then by the suffixes there, such that those which agree in
    ``depth`` bytes are together. ``data`` is padded by 2 * depth bytes or more."""
    windows = np.lib.stride_tricks.sliding_window_view(data, 8)
    order, group = places, bucket
    for k in range(0, PERIOD, 8):
        order, group = _refine(order, group, lambda p, _, k=k: _words(windows, p + k))
    # Ranks of the sample positions, to the depth.
    sample = np.flatnonzero(np.isin(np.arange(len(data) - 2 * depth) % PERIOD, COVER))
    ranked, rank = sample, np.zeros(len(sample), np.int64)
    for k in range(0, depth, 8):
        ranked, rank = _refine(ranked, rank, lambda p, _, k=k: _words(windows, p + k))
    rank_at = np.zeros(len(data), np.int64)
    rank_at[ranked] = rank
    # Long ties: split each group by comparing with its middle member, all groups at once.
    done = np.zeros(len(data), bool)
    while True:
        begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        middle = order[begins + np.diff(np.concatenate([begins, [len(order)]])) // 2]
        if not (~done[order[1:]] & (group[1:] == group[:-1])).any():
            return order

        def against(p, g):
            pivot = middle[g]
            shift = SHIFTS[p % PERIOD, pivot % PERIOD]
            side = np.sign(rank_at[p + shift] - rank_at[pivot + shift])
            done[p[side == 0]] = True
            return side

        order, group = _refine(order, group, against, done)


def repeated_strings(data: np.ndarray, starts: np.ndarray, counts: np.ndarray, bucket: np.ndarray,
                     ident: np.ndarray, place: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For runs of strings in a block (``starts`` in ``data``, ``counts`` strings each, in
    ascending bucket): whether each string occurs in the block at an earlier (ident, place)."""
    run = np.repeat(np.arange(len(starts)), counts)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)
    padded = np.concatenate([data, np.zeros(2 * length + PERIOD, np.uint8)])
    places = starts[run] + nth
    by_place = np.full(len(padded), -1)
    by_place[places] = np.arange(len(places))
    order = by_place[suffix_order(padded, places, bucket[run], length)]
    texts = np.lib.stride_tricks.sliding_window_view(padded, length)
    new = np.ones(len(order), bool)
    for k in range(0, len(order) - 1, 1 << 14):
        a, b = order[k:k + (1 << 14) + 1][:-1], order[k:k + (1 << 14) + 1][1:]
        new[k + 1:k + 1 + len(b)] = (bucket[run[a]] != bucket[run[b]]) | (texts[places[a]] != texts[places[b]]).any(axis=1)
    kind = np.empty(len(order), np.int64)
    kind[order] = np.cumsum(new) - 1
    by = np.lexsort((place[run] + nth, ident[run], kind))
    head = np.flatnonzero(np.concatenate([[True], kind[by][1:] != kind[by][:-1]]))[kind[by]]
    at, who = (place[run] + nth)[by], ident[run][by]
    out = np.zeros(len(order), bool)
    out[by] = (who != who[head]) | (at != at[head])
    return out


TEXT_ROW = "bucket bigint, id bigint, mark int, start int, n int, bytes binary"


def _repeated_rows(ident, mark, place, counts, flags) -> pa.RecordBatch:
    """Stretches of repeated strings as rows."""
    run = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)
    hit = np.flatnonzero(flags)
    if not len(hit):
        return _batch(ROW_SCHEMA, *[[]] * 5)
    begins = np.flatnonzero(np.concatenate([[True], (np.diff(hit) != 1) | (run[hit][1:] != run[hit][:-1])]))
    n = np.diff(np.concatenate([begins, [len(hit)]]))
    r, k = run[hit[begins]], nth[hit[begins]]
    return _batch(ROW_SCHEMA, np.full(len(n), REPEATED, np.int8), np.zeros(len(n), np.int64), n, ident[r],
                  (place[r].astype(np.int64) + k) << 32 | mark[r])


def _sort_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows (``TEXT_ROW``) sorted by bucket: whole buckets are put together to blocks."""
    held: list[pa.RecordBatch] = []

    def sort(table: pa.RecordBatch) -> pa.RecordBatch:
        bucket, ident, mark, place, counts = (c.to_numpy(zero_copy_only=False) for c in table.columns[:5])
        data, offsets = utf8(table.column(5).cast(pa.large_binary()).view(pa.large_string()))
        number = np.cumsum(np.concatenate([[True], bucket[1:] != bucket[:-1]])) - 1
        flags = repeated_strings(data, offsets[:-1], counts.astype(np.int64), number, ident, place.astype(np.int64))
        return _repeated_rows(ident, mark, place, counts, flags)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.column(5).nbytes for b in held) < BLOCK_BYTES:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        bucket = whole.column(0).to_numpy()
        cut = int(np.searchsorted(bucket, bucket[-1], "left"))
        if cut:
            yield sort(whole.slice(0, cut))
        held = [whole.slice(cut)]
    if held:
        yield sort(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


# 4. Strings of large buckets ----------------------------------------------------------------

def _single_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for _, ident, mark, start, n, text in zip(*(c.to_pylist() for c in batch.columns)):
            for i in range(n):
                digest = xxhash.xxh3_128_intdigest(text[i:i + LENGTH])
                rows.append((digest >> 64, digest & (1 << 64) - 1, ident, mark, start + i))
        if rows:
            high, low, ident, mark, start = zip(*rows)
            yield _settle(np.array(high, np.uint64).view(np.int64), np.array(low, np.uint64).view(np.int64),
                          np.array(ident, np.int64), np.array(start, np.int64) << 32 | np.array(mark, np.int64),
                          np.ones(len(rows), np.int64))


# 5. All together ----------------------------------------------------------------------------

def _slice_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _schema(TEXT_ROW).append(pa.field("large", pa.bool_()))
    for batch in batches:
        out = []
        for ident, mark, packed, runs in zip(*(c.to_pylist() for c in batch.columns)):
            raw = zstandard.decompress(packed)
            out += [(r["bucket"], ident, mark, r["start"], r["n"], raw[r["start"]:r["start"] + r["n"] + LENGTH - 1], r["large"])
                    for r in runs]
        yield _batch(schema, *(zip(*out) if out else [[]] * 7))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", many: int = MANY) -> DataFrame:
    """(id, mark, spans): per text with repeated strings the array of (start, n), each n
    strings from byte start on. ``mark`` tells apart texts that share an id."""
    return _repeats(_texts(docs, id_col, text_col), many)


def _repeats(texts: DataFrame, many: int) -> DataFrame:
    small_batches(texts.sparkSession)
    runs = texts.mapInArrow(lambda batches: map(text_runs, batches), ROW)
    mark, start = F.col("place").bitwiseAND(MARK).cast("int").alias("mark"), F.shiftright("place", 32).cast("int").alias("start")
    rows = stable(_settle_all(runs))
    unclear = rows.where(F.col("kind") == RUN).select(
        "bucket", "id", mark, start, F.col("same").bitwiseAND((1 << N_BITS) - 1).cast("int").alias("n"))
    large = unclear.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > many).select("bucket", F.lit(True).alias("large"))
    wanted = unclear.join(large, "bucket", "left") \
        .groupBy("id", "mark").agg(F.collect_list(F.struct("start", "n", "bucket", F.coalesce("large", F.lit(False)).alias("large"))).alias("runs"))
    pieces = stable(_packed(texts).join(wanted, ["id", "mark"]).select("id", "mark", "packed", "runs")
                    .mapInArrow(_slice_runs, TEXT_ROW + ", large boolean"))
    sorted_ = pieces.where("not large").drop("large").repartition("bucket") \
        .sortWithinPartitions("bucket", "id", "start").mapInArrow(_sort_blocks, ROW)
    single = _settle_all(pieces.where("large").drop("large").mapInArrow(_single_strings, ROW), single=True)
    found = rows.unionByName(sorted_).unionByName(single).where(F.col("kind") == REPEATED) \
        .select("id", mark, start, F.col("same").alias("n"))
    return found.groupBy("id", "mark").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, text). ``mark`` numbers the different texts of one id: 0 for the only one, else
    the place in the order of their hashes (256 bits), found by a sort over all of them."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("id"),
                       text_or_empty(text_col).alias("text"))
    again = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    kinds = rows.select("id", F.sha2(F.col("text").cast("binary"), 256).alias("hash")).join(again, "id", "left_semi").distinct()
    kinds = stable(kinds.repartitionByRange("id", "hash").sortWithinPartitions("id", "hash")
                   .select("id", "hash", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")))
    if kinds.isEmpty():
        return rows.select("id", F.lit(0).alias("mark"), "text")
    # One row a partition: how many come before it.
    parts = sorted(kinds.groupBy("part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).collect())
    offsets, before = [], 0
    for part, first, n in parts:
        offsets.append((part, before - first))
        before += n
    moved = kinds.join(docs.sparkSession.createDataFrame(offsets, "part int, offset bigint"), "part") \
        .select("id", "hash", (F.col("place") + F.col("offset")).alias("at"))
    number = moved.join(moved.groupBy("id").agg(F.min("at").alias("first")), "id") \
        .select("id", "hash", (F.col("at") - F.col("first")).alias("number"))
    number = stable(number)
    if number.agg(F.max("number")).first()[0] >= 1 << 31:
        raise ValueError("more than 2^31 different texts share an id")
    return rows.withColumn("hash", F.sha2(F.col("text").cast("binary"), 256)).join(number, ["id", "hash"], "left") \
        .select("id", F.coalesce(F.col("number").cast("int"), F.lit(0)).alias("mark"), "text")


def _packed(texts: DataFrame) -> DataFrame:
    """``texts`` with each text compressed on its own, for joins that shuffle whole texts: two
    thirds of what the shuffle's own compression leaves."""

    @F.arrow_udf("binary")
    def pack(texts: pa.Array) -> pa.Array:
        packer = zstandard.ZstdCompressor(level=1)
        return pa.array([packer.compress(t.as_py().encode()) for t in texts], pa.binary())

    return texts.select("id", "mark", pack("text").alias("packed"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", many: int = MANY) -> DataFrame:
    """Per document: ``id_col``, n_bytes, n_removed, n_spans, kept (the remaining bytes)."""
    texts = _texts(docs, id_col, text_col)
    both = _packed(texts).join(_repeats(texts, many), ["id", "mark"], "left").select("id", "packed", "spans")
    kind = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ident, packed, spans in zip(*(c.to_pylist() for c in batch.columns)):
                raw, kept, removed, count, edge = zstandard.decompress(packed), [], 0, 0, -1
                for a, b in sorted((s["start"], s["start"] + s["n"] + LENGTH - 1) for s in spans or ()):
                    if a > edge:
                        kept.append(raw[max(edge, 0):a])
                        count += 1
                        removed += b - a
                        edge = b
                    elif b > edge:
                        removed += b - edge
                        edge = b
                kept.append(raw[max(edge, 0):])
                out.append((ident, len(raw), removed, count, b"".join(kept)))
            yield _batch(_schema(kind), *(zip(*out) if out else [[]] * 5))

    found = both.mapInArrow(cut, kind)
    return found.select(F.when(F.col("id") != -(1 << 63), F.col("id")).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")
