"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint has one bit per position of a 64-bit hash: 1 if more than half of the
text's shingle hashes have it. Texts whose fingerprints differ in at most ``distance``
bits are linked; groups are the connected components.

Candidates. The 64 bits are cut into ``blocks`` pieces. Fingerprints that differ in at
most ``distance`` bits agree in ``blocks - distance`` pieces at least, so each choice of
that many pieces gives one join key. Only distinct fingerprints take part, and only
keys that two or more of them share.

* Keys with few members: joined with themselves, then the bit distance is verified.
* Keys with many members (a large group of near copies): no pairs are made. Two members
  within two bits meet at a midpoint one bit away from both, so each member is listed
  under itself and under its one-bit neighbours (only bits outside the agreed pieces can
  differ); members of one midpoint are linked to the smallest. At most one row per free
  bit and member, whatever the group's size, and no link is lost. This needs
  ``distance`` <= 2; a larger one joins the members pairwise.

Components come from alternating large-star and small-star steps on the links, each
written to the shared checkpoint folder.

Edge cases: a null or empty text has no words and the fingerprint zero, which links like
any other; a text of fewer words than the shingle is one shingle; repeated rows and ties
share a fingerprint; null ids never become a component's id unless the whole group has
none; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import fresh, small_batches, stable, text_or_empty, utf8

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
BLOCKS = 4
#: Members up to which a key is joined with itself; beyond it, midpoints are used.
PAIRWISE_MEMBERS = 24


def fingerprint_text(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one UTF-8 text (signed 64-bit)."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum([len(t) + 1 for t in tokens])
        starts = [0, *ends[:-words].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, (ends[words - 1:] - 1).tolist())]
    ones = _bit_counts(np.array(hashes, np.uint64))
    return int(_pack(ones * 2 > len(hashes)).view(np.int64))


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return total


def _pack(bits: np.ndarray) -> np.uint64:
    return np.packbits(bits, bitorder="little").view(np.uint64)[0]


def fingerprint(words: int = SHINGLE_WORDS):
    """Column function: text -> fingerprint as bigint."""

    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        data, offsets = utf8(texts)
        raw = data.tobytes()
        return pa.array([fingerprint_text(raw[a:b], words) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())],
                        pa.int64())

    return simhash


def _pieces(blocks: int) -> list[int]:
    """Bit masks of the pieces, low bits first."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(prints: DataFrame, distance: int = MAX_DISTANCE, blocks: int = BLOCKS,
          pairwise: int = PAIRWISE_MEMBERS) -> DataFrame:
    """Links (a, b), a < b, whose transitive closure joins all distinct fingerprints
    (column ``fp``) within ``distance`` bits."""
    if not 0 <= distance < blocks:
        raise ValueError("distance must be below the number of blocks")
    masks = [sum(chosen) for chosen in combinations(_pieces(blocks), blocks - distance)]
    keyed = prints.select("fp", F.explode(F.array(*(
        F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for k, m in enumerate(masks)))).alias("k")).select("fp", "k.part", "k.key")
    sizes = keyed.groupBy("part", "key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = stable(keyed.join(sizes, ["part", "key"]))
    few = shared if distance > 2 else shared.where(F.col("members") <= pairwise)
    left, right = few.select("part", "key", F.col("fp").alias("a")), few.select("part", "key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = left.join(right, ["part", "key"]).where((F.col("a") < F.col("b")) & near).select("a", "b")
    if distance > 2:
        return pairs.distinct()
    many = shared.where(F.col("members") > pairwise)
    # The bits outside a part's mask, as one-bit flips; flip 0 keeps the member itself.
    flips = F.create_map(*(x for k, m in enumerate(masks) for x in (
        F.lit(k), F.array(F.lit(0).cast("bigint"), *(F.lit(_signed(1 << i)) for i in range(64) if not m >> i & 1)))))
    reach = many.select("part", "fp", F.explode(flips[F.col("part")]).alias("flip")) \
        .select("part", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"), "fp")
    # A midpoint has one member per free bit and itself at most, so the set is bounded.
    met = reach.groupBy("part", "mid").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    if distance == 2:
        star = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a < b")
    else:                                # one bit apart: one of the two is the midpoint itself
        own = met.where(F.array_contains("fps", F.col("mid"))).select("mid", F.explode("fps").alias("other"))
        star = own.select(F.least("mid", "other").alias("a"), F.greatest("mid", "other").alias("b")).where("a < b") \
            .where(near)
    return pairs.unionByName(star).distinct()


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has a link."""
    edges = stable(edges.select("a", "b").where("a <> b"))
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: a node's larger neighbours move to its smallest neighbour (or itself).
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("m").alias("a"), F.col("b")).distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        down = large.select(F.col("b").alias("a"), F.col("a").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(low, "a")
        small = moved.select(F.col("m").alias("a"), F.col("b")).where("a <> b") \
            .unionByName(low.select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct()
        before, edges = edges, stable(small)
        if _same(before, edges):
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    raise RuntimeError("components did not settle")


def _same(x: DataFrame, y: DataFrame) -> bool:
    """Whether two edge sets without repeats are equal, by counts and sums of hashes."""
    def mark(df):
        h = F.xxhash64("a", "b").cast("decimal(38,0)")
        return tuple(df.agg(F.count(F.lit(1)), F.sum(h), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())
    return mark(x) == mark(y)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                    distance: int = MAX_DISTANCE, blocks: int = BLOCKS, pairwise: int = PAIRWISE_MEMBERS) -> DataFrame:
    """One row per input row: ``id_col``, ``fp`` (bigint), ``component`` (smallest id reachable)."""
    small_batches(docs.sparkSession)
    prints = stable(docs.select(F.col(id_col).alias("id"), fingerprint(words)(F.col(text_col)).alias("fp")))
    owners = stable(prints.groupBy("fp").agg(F.min("id").alias("first")))
    roots = components(links(owners.select("fp"), distance, blocks, pairwise))
    member = owners.join(roots, owners.fp == roots.node, "left") \
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = member.groupBy("root").agg(F.min("first").alias("component"))
    found = member.join(smallest, "root").select("fp", "component")
    return prints.join(found, "fp").select(F.col("id").alias(id_col), "fp", "component")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with one row of each group, that with the smallest id (null ids last) and, among
    its texts, the smallest text hash. Columns stay. Rows are told apart by id and text, so
    other texts under a null or repeated id stay unless they are near duplicates themselves."""
    text_hash, rows = fresh(docs, "kept_hash"), fresh(docs, "kept_rows")
    kept = _survivors(docs, id_col, text_col, **settings).select(
        F.col("id").alias(fresh(docs, "kept_id")), F.col("text_hash").alias(text_hash), F.col("n").alias(rows))
    kept = stable(kept)
    marked = docs.withColumn(text_hash, F.xxhash64(text_or_empty(docs[text_col])))
    out = marked.join(kept, marked[id_col].eqNullSafe(kept[kept.columns[0]]) & (marked[text_hash] == kept[text_hash]),
                      "left_semi")
    if not kept.where(F.col(rows) > 1).isEmpty():
        out = out.dropDuplicates([id_col, text_hash])
    return out.drop(text_hash)


def _survivors(docs: DataFrame, id_col: str, text_col: str, words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE,
               blocks: int = BLOCKS, pairwise: int = PAIRWISE_MEMBERS) -> DataFrame:
    """One row per component: id and text hash of the row that stays, and how many rows share both."""
    small_batches(docs.sparkSession)
    prints = stable(docs.select(F.col(id_col).alias("id"), F.xxhash64(text_or_empty(text_col)).alias("text_hash"),
                                fingerprint(words)(F.col(text_col)).alias("fp")))
    texts = prints.groupBy("fp", "id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash", "n")).alias("first")
    owners = stable(texts.groupBy("fp").agg(first))
    roots = components(links(owners.select("fp"), distance, blocks, pairwise))
    return owners.join(roots, owners.fp == roots.node, "left").groupBy(F.coalesce("root", "fp").alias("root")) \
        .agg(F.min("first").alias("first")).select("first.*")


def hex64(col: str):
    """16 lower-case hex digits of a bigint."""
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))
