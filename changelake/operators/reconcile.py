"""Source-to-target reconciliation.

``table_md5`` is an ordered checksum: md5 over the md5s of key ranges, each of
them over its rows in key order; ``table_digest`` is the scalable form: an order-free sum of per-row hash
numbers per hash bucket, computed with partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelake.functions.scalar import md5_number, row_text
from changelake.functions.scan import in_ranges
from changelake.session import written

def count_parity(src_counts: DataFrame, tgt_counts: DataFrame) -> DataFrame:
    """``(table_name, n)`` on both sides -> counts side by side and equality."""
    s = src_counts.withColumnRenamed("n", "src_count")
    t = tgt_counts.withColumnRenamed("n", "tgt_count")
    j = s.join(t, "table_name", "full_outer").fillna(0, subset=["src_count", "tgt_count"])
    return j.withColumn("counts_equal", F.col("src_count") == F.col("tgt_count"))


def table_md5(df: DataFrame, key: str, cols: list[str], range_rows: int = 10_000) -> DataFrame:
    """Ordered checksum (one row): the md5 of all ranges' md5s in range order, a range
    being ``range_rows`` consecutive values of the integer key and its md5 taken over its
    rows' md5s in key order. Both steps work on short texts, ranges in parallel."""
    rows = df.select(F.col(key).alias("_k"), F.floor(F.col(key) / F.lit(range_rows)).alias("_r"),
                     F.md5(row_text(*cols)).alias("_t"))
    ranges = rows.groupBy("_r").agg(F.md5(F.expr("listagg(_t, ',') WITHIN GROUP (ORDER BY _k, _t)")).alias("_m"),
                                    F.count("*").alias("_n"))
    return ranges.agg(F.md5(F.expr("listagg(_m, ',') WITHIN GROUP (ORDER BY _r)")).alias("md5"),
                      F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))


def merkle_nodes(df: DataFrame, keys: list[str], cols: list[str], fan: int = 4096, levels: int = 3) -> DataFrame:
    """A7 for keys of any type: a Merkle tree over ranges of the key order.

    Rows: level, first (text of the range's first key; null for the range before all cut keys),
    parent (``first`` of the node above), node (md5) and n (rows below). A key begins a range where
    the md5 of its text falls into one of ``fan`` parts, another part of the md5 for each level: so
    ranges hold about ``fan`` rows whatever the keys' values and gaps, a row's range does not
    depend on rows far away, and two tables cut alike. A leaf is the md5 of its rows' md5s in key
    order, a node above that of its nodes; level ``levels`` + 1 is the root, over a table
    ``fan ** levels`` times smaller. Up to 4 levels."""
    if not 1 <= levels <= 4:
        raise ValueError("levels must be 1 to 4")
    now = df.select(F.struct(*keys).alias("k"), row_text(*keys).alias("kt"), F.md5(row_text(*cols)).alias("t"), F.lit(1).cast("bigint").alias("n"))
    out = []
    for level in range(1, levels + 1):
        part = F.conv(F.substring(F.md5(F.coalesce("kt", F.lit(""))), 8 * level - 7, 8), 16, 10).cast("bigint")
        begins = F.when(part % fan == 0, F.struct("k", "kt"))
        ranged = in_ranges(now.withColumn("b", begins), ["k"], "merkle")
        within = F.max("b").over(Window.partitionBy("_rng").orderBy("k"))
        # One row a range: the last cut key before it.
        carry = ranged.groupBy("_rng").agg(F.max("b").alias("b")).select("_rng", F.max("b").over(
            Window.orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)).alias("c"))
        owned = ranged.withColumn("w", within).join(carry, "_rng").withColumn("o", F.coalesce("w", "c"))
        if level > 1:
            out.append(owned.select(F.lit(level - 1).alias("level"), F.col("kt").alias("first"), F.col("o.kt").alias("parent"),
                                    F.col("t").alias("node"), "n"))
        now = owned.groupBy("o").agg(F.expr("md5(listagg(t, ',') WITHIN GROUP (ORDER BY k, t))").alias("t"), F.sum("n").alias("n")) \
            .select(F.col("o.k").alias("k"), F.col("o.kt").alias("kt"), "t", "n")
    now = written(now, "merkle")
    out.append(now.select(F.lit(levels).alias("level"), F.col("kt").alias("first"), F.lit(None).cast("string").alias("parent"),
                          F.col("t").alias("node"), "n"))
    out.append(now.agg(F.expr("md5(coalesce(listagg(t, ',') WITHIN GROUP (ORDER BY k, t), ''))").alias("node"),
                       F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(
        F.lit(levels + 1).alias("level"), F.lit(None).cast("string").alias("first"), F.lit(None).cast("string").alias("parent"), "node", "n"))
    nodes = out[0]
    for part in out[1:]:
        nodes = nodes.unionByName(part)
    return nodes


def merkle_diff(src: DataFrame, tgt: DataFrame, levels: int = 3) -> DataFrame:
    """(first, in_src, in_tgt): the leaves of two trees that differ, found from the top: a level is
    compared only below nodes that differ, so equal parts of the tables are passed over."""
    below = None
    for level in range(levels, 0, -1):
        def side(nodes, name):
            rows = nodes.where(F.col("level") == level)
            if below is not None:
                rows = rows.join(below, rows["parent"].eqNullSafe(below["up"]), "left_semi")
            return rows.select(F.col("first").alias(f"f_{name}"), F.col("node").alias(f"node_{name}"), F.lit(True).alias(f"in_{name}"))
        s, t = side(src, "s"), side(tgt, "t")
        both = s.join(t, s["f_s"].eqNullSafe(t["f_t"]), "full_outer").where(~F.col("node_s").eqNullSafe(F.col("node_t")))
        first = F.when(F.col("in_s"), F.col("f_s")).otherwise(F.col("f_t"))
        below = both.select(first.alias("up"), F.coalesce("in_s", F.lit(False)).alias("in_src"), F.coalesce("in_t", F.lit(False)).alias("in_tgt"))
    return below.withColumnRenamed("up", "first")


def digest_terms(df: DataFrame, key: str, cols: list[str], buckets: int) -> DataFrame:
    t = row_text(*cols)
    return df.select(F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint"),
                            F.lit(buckets)).cast("int").alias("bucket"),
                     md5_number(t, 1).alias("_h"), md5_number(t, 17).alias("_h2"))


def table_digest(df: DataFrame, key: str, cols: list[str], buckets: int = 16) -> DataFrame:
    """Per hash bucket of the key: row count and two sums of 60-bit parts of the rows' md5."""
    return (digest_terms(df, key, cols, buckets).groupBy("bucket")
            .agg(F.count("*").alias("n"), F.sum("_h").cast("decimal(38,0)").alias("digest"),
                 F.sum("_h2").cast("decimal(38,0)").alias("digest2")))


def drift(src: DataFrame, tgt: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Keys missing in target, extra in target, or with changed content."""
    s = src.select(F.col(key).alias("_k"), F.md5(row_text(*cols)).alias("_sh"))
    t = tgt.select(F.col(key).alias("_k"), F.md5(row_text(*cols)).alias("_th"))
    j = s.join(t, "_k", "full_outer")
    kind = (F.when(F.col("_th").isNull(), F.lit("missing"))
             .when(F.col("_sh").isNull(), F.lit("extra"))
             .when(F.col("_sh") != F.col("_th"), F.lit("changed")))
    return j.select(F.col("_k").alias(key), kind.alias("drift")).filter(F.col("drift").isNotNull())


def integrity(src: DataFrame, tgt: DataFrame, key: str, cols: list[str], buckets: int = 16) -> DataFrame:
    """A10: counts and bucket digests of both sides -> one verdict row."""
    a = table_digest(src, key, cols, buckets).alias("a")
    b = table_digest(tgt, key, cols, buckets).alias("b")
    j = a.join(b, "bucket", "full_outer")
    same = F.coalesce(F.col("a.n") == F.col("b.n"), F.lit(False)) & \
        F.coalesce((F.col("a.digest") == F.col("b.digest")) & (F.col("a.digest2") == F.col("b.digest2")), F.lit(False))
    return j.agg(F.coalesce(F.sum("a.n"), F.lit(0)).cast("bigint").alias("src_count"),
                 F.coalesce(F.sum("b.n"), F.lit(0)).cast("bigint").alias("tgt_count"),
                 F.bool_and(same).alias("content_equal")) \
            .withColumn("verdict", F.when(F.col("content_equal") & (F.col("src_count") == F.col("tgt_count")),
                                          F.lit("INTEGRITY OK")).otherwise(F.lit("INTEGRITY FAILED")))


def key_sample(df: DataFrame, key: str, percent: int) -> DataFrame:
    """Deterministic sample by key hash — the same keys on both sides."""
    h = F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(100))
    return df.filter(h < percent)


def row_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows only in ``a`` and rows only in ``b`` (multiset difference both ways)."""
    return a.exceptAll(b).withColumn("side", F.lit("only_src")) \
        .unionByName(b.exceptAll(a).withColumn("side", F.lit("only_tgt")))


def drained_at(polls: DataFrame, part: list[str], pos: str, ts: str, match: Column,
               report: list[str] | None = None) -> DataFrame:
    """First poll where this poll and the previous one (``pos - 1`` in the same
    series ``part``) both match; grouped by ``report`` columns (default: the series).
    The previous poll is found by a join on the poll index, not by a window."""
    p = polls.withColumn("_m", match)
    prev = p.select(*part, (F.col(pos) + 1).alias(pos), F.col("_m").alias("_pm"))
    j = p.join(prev, [*part, pos], "left")
    return j.filter(F.col("_m") & F.col("_pm")).groupBy(*(report or part)).agg(F.min(ts).alias("drained_at"))
