"""Ranked lexical search: block-max MaxScore over compressed postings, shard by shard.

A document's score for an item adds, for each of the item's terms, the term's weight times an
impact in whole numbers that grows with the term's count and falls with the document's length.

A first pass counts the terms of each text; only the terms of the items are kept, all count for
lengths. Weights and lengths need statistics of the whole corpus, one row each. The second pass
makes shards of at most ``SHARD_POSTINGS`` postings of neighbouring rows. A shard's list of a term
holds document gaps and counts in the fewest bytes that fit, in blocks of ``BLOCK`` postings, each
with its last document and its greatest impact. For an item, lists stand in ascending order of
their greatest score (the global bounds). Those whose bounds together cannot beat the tenth best
score so far are not essential: candidates come from the others alone. Windows of documents are
taken in order; essential lists are decompressed and added up in a window, then each list that is
not essential, the dearest first, sees only candidates that its block's greatest impact and the bounds
below could still lift above the threshold, and only the blocks that hold such a candidate are
decompressed. Documents come in ascending id, so an equal score never displaces an earlier one.
A shard returns its ten best for each item; a window over item merges the heaps of all shards.

Memory: a shard's postings, one text's counts and one window. Texts are read in pieces, so a very
long text is never a list of words. Items reach tasks as a broadcast below ``ITEM_TERMS`` terms,
else in chunks of about that many by a hash, one pass of the shards each.

Edge cases: a null or empty text has no terms and counts nowhere; a null item has no terms and no
rows; rows that repeat an item id are one item with the terms of all; each row of documents is a
document of its own, so rows that repeat an id rank apiece; null ids come after the others of
their score; an empty table on either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changelake.llm.common import small_batches, stable

#: What each byte becomes: capitals small, bytes that end a term (all ASCII but letters and digits)
#: a space. Bytes of other characters stay, so terms are cut in UTF-8 as they are in characters.
FOLD = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()
BEST = 10
BLOCK = 128
#: Documents of a shard's first window, and the most of a window (each is twice the one before).
FIRST_ROWS, WINDOW_ROWS = 1_024, 16_384
SHARD_POSTINGS = 8_000_000
ITEM_TERMS = 1_000_000
#: Bytes of a text that are cut into terms at once.
PIECE = 1 << 20
#: Impact of one occurrence in a document of no length; the scores' whole-number scale.
UNIT = 1_000_000_000


def count_terms(text: str | bytes | None) -> Counter:
    """Occurrences of each term (in UTF-8) of a text."""
    counts: Counter = Counter()
    raw = (text.encode() if isinstance(text, str) else text or b"").translate(FOLD)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE)                # a term stays whole
        end = len(raw) if end < 0 else end
        counts.update(raw[at:end].split())
        at = end
    return counts


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, terms): the distinct terms of each item."""

    @F.arrow_udf("array<string>")
    def terms(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(t.decode() for t in count_terms(x)) for x in texts.to_pylist()], pa.list_(pa.string()))

    found = items.select(F.col(id_col).alias("item"), F.explode(terms(text_col)).alias("term"))
    return found.groupBy("item").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def _counted(docs: DataFrame, known: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc, n, terms, counts): each text's length in terms and its counts of known terms (numbers)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(known)

    @F.arrow_udf("struct<n:bigint,terms:array<int>,counts:array<int>>")
    def counted(texts: pa.Array) -> pa.Array:
        numbers = shared.value
        lengths, flat, times, ends = [], [], [], [0]
        for text in texts:
            found = count_terms(text.as_py())
            lengths.append(sum(found.values()))
            if len(found) < len(numbers):
                pairs = sorted((numbers[t], c) for t, c in found.items() if t in numbers)
            else:
                pairs = sorted((k, found[t]) for t, k in numbers.items() if t in found)
            flat += [t for t, _ in pairs]
            times += [c for _, c in pairs]
            ends.append(len(flat))
        offsets = pa.array(ends, pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (flat, times)]
        return pa.StructArray.from_arrays([pa.array(lengths, pa.int64()), *lists], ["n", "terms", "counts"])

    return docs.select(F.col(id_col).alias("doc"), counted(text_col).alias("c")).select("doc", "c.*").where("n > 0")


def impacts(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    return UNIT * counts.astype(np.int64) // (1000 * counts.astype(np.int64) + 8 * m)


def _narrow(values: np.ndarray) -> np.ndarray:
    """The values in the fewest bytes that hold them all."""
    top = int(values.max(initial=0))
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


class Postings:
    """One term's documents (ascending numbers) and counts, in compressed blocks."""

    def __init__(self, docs: np.ndarray, counts: np.ndarray, m: np.ndarray):
        cuts = np.arange(0, len(docs), BLOCK)
        self.n, self.m = len(docs), m
        self.first = docs[cuts]
        self.last = docs[np.minimum(cuts + BLOCK, len(docs)) - 1]
        gaps = np.diff(docs, prepend=docs[:1])
        gaps[cuts] = 0
        self.gaps, self.counts = _narrow(gaps), _narrow(counts)
        self.most = np.maximum.reduceat(impacts(counts, m[docs]), cuts)
        self.top = int(self.most.max())

    def read(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, impacts) of the blocks a to b - 1, decompressed."""
        lo, hi = a * BLOCK, min(b * BLOCK, self.n)
        gaps = self.gaps[lo:hi].astype(np.int64)
        starts = np.arange(0, hi - lo, BLOCK)
        total = np.cumsum(gaps)
        docs = total + np.repeat(self.first[a:b] - total[starts], np.diff(np.append(starts, hi - lo)))
        return docs, impacts(self.counts[lo:hi], self.m[docs])


class Shard:
    """Compressed postings of neighbouring documents, searched for one item at a time."""

    def __init__(self, m: np.ndarray, terms: np.ndarray, docs: np.ndarray, counts: np.ndarray):
        self.size = len(m)
        order = np.argsort(terms, kind="stable")        # documents stay ascending within a term
        terms, docs, counts = terms[order], docs[order], counts[order]
        edges = np.flatnonzero(np.diff(terms, prepend=-1))
        self.lists = {int(terms[a]): Postings(docs[a:b], counts[a:b], m)
                      for a, b in zip(edges, np.append(edges[1:], len(terms)))}
        self.read = self.passed = 0                     # blocks decompressed, blocks passed over

    def _ordered(self, terms: list[tuple[int, int]]) -> list[tuple[int, int, Postings]]:
        """(greatest score, weight, list) of the terms that occur, cheapest first."""
        return sorted(((w * self.lists[t].top, w, self.lists[t]) for t, w in terms if t in self.lists and w > 0),
                      key=lambda x: x[0])

    def _lift(self, postings: Postings, w: int, docs: np.ndarray, score: np.ndarray, below: int, least: int) -> np.ndarray:
        """Adds a list's scores for ``docs``, of those that it and ``below`` could lift above
        ``least`` by the block's greatest impact; reads blocks of these alone. Returns them."""
        block = np.searchsorted(postings.last, docs)
        near = np.minimum(block, len(postings.last) - 1)
        held = (block < len(postings.last)) & (postings.first[near] <= docs)
        could = score + w * np.where(held, postings.most[near], 0) + below > least
        needed = np.unique(block[held & could])
        self.passed += len(np.unique(block[held])) - len(needed)
        for run in np.split(needed, np.flatnonzero(np.diff(needed) > 1) + 1) if len(needed) else ():
            found, impact = postings.read(run[0], run[-1] + 1)
            self.read += len(run)
            at = np.searchsorted(found, docs)
            hit = found[np.minimum(at, len(found) - 1)] == docs
            score[hit] += w * impact[at[hit]]
        return could

    def search(self, terms: list[tuple[int, int]], best: int = BEST) -> list[tuple[int, int]]:
        """The best (score, document) by descending score, ascending document; terms are
        (number, weight)."""
        lists = self._ordered(terms)
        bounds = np.cumsum([top for top, _, _ in lists])
        heap: list[tuple[int, int]] = []
        end, rows = 0, FIRST_ROWS
        while end < self.size:
            start, end, rows = end, min(end + rows, self.size), min(2 * rows, WINDOW_ROWS)
            least = heap[-1][0] if len(heap) == best else 0
            # Lists below ``cut`` cannot beat the threshold together.
            cut = int(np.searchsorted(bounds, least, "right"))
            if cut == len(lists):
                break
            score = np.zeros(end - start, np.int64)
            for _, w, postings in lists[cut:]:
                a, b = np.searchsorted(postings.last, start), np.searchsorted(postings.first, end)
                if a < b:
                    docs, impact = postings.read(a, b)
                    self.read += b - a
                    inside = slice(*np.searchsorted(docs, (start, end)))
                    score[docs[inside] - start] += w * impact[inside]
            found = np.flatnonzero(score)
            score, found = score[found], found + start
            for k in range(cut - 1, -1, -1):
                could = score + bounds[k] > least
                found, score = found[could], score[could]
                if not len(found):
                    break
                _, w, postings = lists[k]
                could = self._lift(postings, w, found, score, int(bounds[k - 1]) if k else 0, least)
                found, score = found[could], score[could]
            above = np.flatnonzero(score > least)
            if len(above) > best:
                above = above[np.lexsort((found[above], -score[above]))[:best]]
            heap = sorted([*heap, *zip(score[above].tolist(), found[above].tolist())], key=lambda x: (-x[0], x[1]))[:best]
        return heap


def _search_shards(shared, mean: tuple[int, int], best: int, shard_postings: int):
    """Rows (doc, n, terms, counts) of a partition -> (item, doc, score) of each shard's best.
    ``shared``: (item, its terms with weights)."""
    n_docs, all_terms = mean

    def shards(batches):
        held: list[pa.RecordBatch] = []
        postings = 0
        for batch in batches:
            # A batch is cut where a shard is full; a row's own postings are at most the known terms.
            ends = np.cumsum(batch["terms"].value_lengths().to_numpy())
            at = 0
            while at < batch.num_rows:
                used = int(ends[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(ends, used + shard_postings - postings, "right")))
                held.append(batch.slice(at, to - at))
                postings += int(ends[to - 1]) - used
                at = to
                if postings >= shard_postings or (at < batch.num_rows):
                    yield held
                    held, postings = [], 0
        if held:
            yield held

    def search(batches):
        for held in shards(batches):
            rows = pa.Table.from_batches(held).combine_chunks()
            nulls = rows["doc"].is_null().to_numpy(zero_copy_only=False)
            ids = rows["doc"].fill_null(0).to_numpy()
            order = np.lexsort((ids, nulls))
            rows, ids, nulls = rows.take(pa.array(order)), ids[order], nulls[order]
            lists = rows["terms"].combine_chunks()
            sizes = lists.value_lengths().to_numpy()
            m = 10 + 90 * rows["n"].to_numpy() * n_docs // all_terms
            shard = Shard(m, lists.flatten().to_numpy(), np.repeat(np.arange(len(ids)), sizes),
                          rows["counts"].combine_chunks().flatten().to_numpy())
            out = [(item, doc, score) for item, terms in shared.value for score, doc in shard.search(terms, best)]
            if out:
                items, docs, scores = zip(*out)
                docs = np.array(docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items, pa.int64()), pa.array(ids[docs], pa.int64(), mask=nulls[docs]), pa.array(scores, pa.int64())],
                    ["item", "doc", "score"])

    return search


def search(docs: DataFrame, items: DataFrame, best: int = BEST, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", shard_postings: int = SHARD_POSTINGS,
           item_terms: int = ITEM_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``best`` documents with a score above 0."""
    spark = docs.sparkSession
    small_batches(spark)
    asked = stable(_items(items, item_col, item_text_col))
    chunks = -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 1) // item_terms)
    chunk = F.pmod(F.xxhash64("item"), F.lit(chunks))
    parts = [_search_chunk(docs, asked.where(chunk == c).select("item", "terms").collect(), best, id_col, text_col, shard_postings)
             for c in range(chunks)]
    heaps = parts[0]
    for part in parts[1:]:
        heaps = heaps.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best) \
        .select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


def _search_chunk(docs: DataFrame, rows: list, best: int, id_col: str, text_col: str, shard_postings: int) -> DataFrame:
    spark = docs.sparkSession
    known = {t: k for k, t in enumerate(sorted({t.encode() for r in rows for t in r.terms}))}
    counted = stable(_counted(docs, known, id_col, text_col))
    n_docs, all_terms = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = dict(counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1))).collect())
    weights = {k: weight(n_docs, df[k]) for k in df}
    numbers = [(r.item, [known[t.encode()] for t in r.terms]) for r in rows]
    plan = [(item, [(k, weights[k]) for k in terms if k in weights]) for item, terms in numbers]
    return counted.mapInArrow(_search_shards(spark.sparkContext.broadcast(plan), (n_docs, all_terms or 1), best, shard_postings),
                              "item bigint, doc bigint, score bigint")


def oracle() -> str:
    """The same ranking as DuckDB SQL, without an index."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    terms = rf"unnest(regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
    return f"""
    WITH words AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
    counted AS (SELECT r, doc_id, term, count(*) AS tf FROM (SELECT r, doc_id, {terms} AS term FROM words) GROUP BY ALL),
    lengths AS (SELECT r, sum(tf)::BIGINT AS n FROM counted GROUP BY r),
    corpus AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM lengths),
    weights AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
                FROM counted, corpus GROUP BY term, nd),
    asked AS (SELECT DISTINCT item_id, {terms} AS term FROM benchmark),
    scores AS (SELECT a.item_id, c.r, c.doc_id,
                      sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l))))::BIGINT AS score
               FROM asked a JOIN counted c USING (term) JOIN weights USING (term) JOIN lengths USING (r), corpus
               GROUP BY a.item_id, c.r, c.doc_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS k FROM scores WHERE score > 0)
    SELECT item_id, k::INTEGER AS rank, doc_id, score FROM ranked WHERE k <= 10"""
