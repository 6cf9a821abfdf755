"""Ordered per-key scans that stay balanced when one key is hot.

A window ``partitionBy(key).orderBy(pos)`` puts every row of a key into one
task; if one key holds a third of the log that task holds a third of the
data. Here rows are cut into blocks of ``block_size`` consecutive positions.
The in-block part of a scan is a window partitioned by (key, block), so no
task holds more than one block of a key; the carry from earlier blocks comes
from one summary row per block (a table ``block_size`` times smaller), joined
back on (key, block). Results equal the plain window's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changelake.session import written

DEFAULT_BLOCK = 1 << 16


def _blocks(df: DataFrame, pos: str, block_size: int) -> DataFrame:
    return df.withColumn("_blk", F.floor(F.col(pos) / F.lit(block_size)))


def prefix_max_before(df: DataFrame, keys: list[str], pos: str, value: str, out: str,
                      group: list[str] | None = None, block_size: int | None = DEFAULT_BLOCK) -> DataFrame:
    """``out`` = max(value) over earlier rows of the same key, ordered by (group..., pos).

    ``group`` columns order before ``pos`` (e.g. source partition before offset).
    """
    group = group or []
    order = [*group, pos]
    if not block_size:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, F.max(value).over(w))
    b = _blocks(df, pos, block_size)
    part = [*keys, *group, "_blk"]
    w_in = Window.partitionBy(*part).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumn("_in", F.max(value).over(w_in))
    summary = b.groupBy(*part).agg(F.max(value).alias("_bmax"))
    w_blk = Window.partitionBy(*keys).orderBy(*group, "_blk").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("_carry", F.max("_bmax").over(w_blk)).drop("_bmax")
    j = b.join(summary, part, "left")
    return j.select(*df.columns, F.greatest("_in", "_carry").alias(out))


def lag_by_key(df: DataFrame, keys: list[str], pos: str, cols: list[str], prefix: str = "prev_",
               block_size: int | None = DEFAULT_BLOCK) -> DataFrame:
    """Previous row's ``cols`` within the key, ordered by ``pos`` (ties broken arbitrarily
    but consistently); adds ``prefix + col`` for each."""
    if block_size is None:
        w = Window.partitionBy(*keys).orderBy(pos)
        for c in cols:
            df = df.withColumn(prefix + c, F.lag(c).over(w))
        return df
    b = _blocks(df, pos, block_size)
    part = [*keys, "_blk"]
    w_in = Window.partitionBy(*part).orderBy(pos)
    for c in cols:
        b = b.withColumn("_in_" + c, F.lag(c).over(w_in))
    b = b.withColumn("_first", F.row_number().over(w_in) == 1)
    last = b.groupBy(*part).agg(F.max_by(F.struct(*cols), F.col(pos)).alias("_last"))
    w_blk = Window.partitionBy(*keys).orderBy("_blk")
    carry = last.withColumn("_carry", F.lag("_last").over(w_blk)).drop("_last")
    j = b.join(carry, part, "left")
    outs = [F.when(F.col("_first"), F.col("_carry")[c]).otherwise(F.col("_in_" + c)).alias(prefix + c) for c in cols]
    return j.select(*df.columns, *outs)


def lead_by_key(df: DataFrame, keys: list[str], pos: str, cols: list[str], prefix: str = "next_",
                block_size: int | None = DEFAULT_BLOCK) -> DataFrame:
    """Next row's ``cols`` within the key ordered by ``pos`` (mirror of ``lag_by_key``)."""
    neg = df.withColumn("_negpos", -F.col(pos))
    out = lag_by_key(neg, keys, "_negpos", cols, prefix, block_size)
    return out.drop("_negpos")


def in_ranges(df: DataFrame, order: list[str], purpose: str) -> DataFrame:
    """``df`` with ``_rng``: rows dealt by range of ``order`` into parts of about equal numbers of rows,
    numbered in order. Written once, so that all readers see the same ranges."""
    return written(df.repartitionByRange(*order).withColumn("_rng", F.spark_partition_id()), purpose)


def lead_by_rank(df: DataFrame, keys: list[str], pos: str, cols: list[str], prefix: str = "next_",
                 block_rows: int = DEFAULT_BLOCK) -> DataFrame:
    """Next row's ``cols`` within the key ordered by ``pos``, whatever the gaps between positions.

    Keys of at most ``block_rows`` rows take a plain window. The rows of longer keys are dealt by
    ranges of (key, position) that hold equal numbers of rows, looked up within their range, and
    the last row of a range takes the first of the next (one row a range). ``df`` is read several
    times: pass a written one."""
    numbers = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block_rows)
    long = written(numbers.select(*keys, F.lit(True).alias("_long")), "long-keys")
    window = Window.partitionBy(*keys).orderBy(pos)
    if long.isEmpty():
        return df.select("*", *[F.lead(c).over(window).alias(prefix + c) for c in cols])
    marked = df.join(long, keys, "left")
    short = marked.where("_long IS NULL").drop("_long").select("*", *[F.lead(c).over(window).alias(prefix + c) for c in cols])
    ranged = in_ranges(marked.where("_long").drop("_long"), [*keys, pos], "lead")
    head = F.struct(*keys, pos, *[c for c in cols if c != pos])
    after = F.lead(head).over(Window.partitionBy("_rng").orderBy(*keys, pos))
    firsts = ranged.groupBy("_rng").agg(F.min(head).alias("_first"))
    firsts = firsts.select("_rng", F.lead("_first").over(Window.orderBy("_rng")).alias("_border"))   # one row a range
    joined = ranged.withColumn("_after", after).join(firsts, "_rng", "left").withColumn("_after", F.coalesce("_after", "_border"))
    same = None
    for k in keys:
        one = F.col(f"_after.{k}").eqNullSafe(F.col(k))
        same = one if same is None else same & one
    return short.unionByName(joined.select(*df.columns, *[F.when(same, F.col(f"_after.{c}")).alias(prefix + c) for c in cols]))


def running(df: DataFrame, keys: list[str], pos: str, specs: dict[str, tuple[str, str]],
            block_size: int) -> DataFrame:
    """Inclusive running aggregates ordered by ``pos`` within ``keys`` (``specs``: output ->
    (``"sum"`` | ``"max"``, column)), computed per block of ``block_size`` positions plus a
    carry from earlier blocks' totals — so even a single long series (``keys=[]``) is
    spread over one task per block instead of one task in all."""
    fns = {"sum": F.sum, "max": F.max}
    b = _blocks(df, pos, block_size)
    part = [*keys, "_blk"]
    w_in = Window.partitionBy(*part).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    for out, (fn, col) in specs.items():
        b = b.withColumn("_in_" + out, fns[fn](col).over(w_in))
    summary = b.groupBy(*part).agg(*[fns[fn](col).alias("_tot_" + out) for out, (fn, col) in specs.items()])
    w_blk = (Window.partitionBy(*keys) if keys else Window).orderBy("_blk") \
        .rowsBetween(Window.unboundedPreceding, -1)   # over block totals only
    for out, (fn, _) in specs.items():
        summary = summary.withColumn("_carry_" + out, fns[fn]("_tot_" + out).over(w_blk))
    j = b.join(summary.select(*part, *["_carry_" + o for o in specs]), part, "left")
    outs = []
    for out, (fn, _) in specs.items():
        inner, carry = F.col("_in_" + out), F.col("_carry_" + out)
        outs.append((inner + F.coalesce(carry, F.lit(0)) if fn == "sum" else F.greatest(inner, carry)).alias(out))
    return j.select(*df.columns, *outs)


def trailing(df: DataFrame, keys: list[str], pos: str, specs: dict[str, tuple[str, str]],
             width: int, block_size: int) -> DataFrame:
    """Trailing range aggregates over positions ``pos - width + 1 .. pos`` within ``keys``
    (``specs``: output -> (``"sum"`` | ``"max"``, column)), partitioned by (keys, block).

    A row is also copied, as a halo row, into each later block that its window reaches, so
    every window is complete inside its block; halo rows only feed windows and are dropped
    from the output. Extra rows: about width / block_size a row.
    """
    fns = {"sum": F.sum, "max": F.max}
    blk = F.floor(F.col(pos) / F.lit(block_size))
    base = df.withColumn("_blk", blk).withColumn("_halo", F.lit(False))
    last = F.floor((F.col(pos) + F.lit(width - 1)) / F.lit(block_size))
    halo = df.filter(last > blk).withColumn("_blk", F.explode(F.sequence(blk + 1, last))).withColumn("_halo", F.lit(True))
    u = base.unionByName(halo)
    w = Window.partitionBy(*keys, "_blk").orderBy(pos).rangeBetween(-(width - 1), 0)
    outs = [fns[fn](col).over(w).alias(out) for out, (fn, col) in specs.items()]
    return u.select(*df.columns, "_halo", *outs).filter(~F.col("_halo")).drop("_halo")
