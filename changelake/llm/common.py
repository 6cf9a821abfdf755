"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.session import scratch_dir

#: Bytes of text that one numpy pass works on; a longer single text is a pass of its own.
SLICE_BYTES = 4 << 20


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most ``rows`` rows: a row may be a whole document, and a task's
    memory follows the batch."""
    now = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if now <= 0 or now > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def stable(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back, so later consumers
    neither recompute it nor depend on the executors that made it."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        base = spark.conf.get("spark.checkpoint.dir", None) or scratch_dir(spark, "checkpoints")
        spark.sparkContext.setCheckpointDir(base)
    return df.checkpoint()


def crc_fold(id_col: str, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds`` (null ids: fold of empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def uniform(*parts: str | Column, seed: int) -> Column:
    """A number in [0, 1) from a hash of the parts: the same on every run and retry.
    52 bits of an md5, so it is exact in a double and easy to repeat in SQL."""
    cols = [F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p.cast("string"), F.lit("")) for p in parts]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *cols).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(2 ** 52))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of length n + 1) of a string array; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, n + 1, column.offset * 8)
    first, last = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(buffers[2], np.uint8, last - first, first) if last > first else np.empty(0, np.uint8)
    return data, offsets - first


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts [a, b) of about ``limit`` bytes, at least one text each."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = b


def by_slice(column: pa.Array, work: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """``work(bytes, offsets)`` over slices of the texts, results joined in order."""
    data, offsets = utf8(column)
    out = [work(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]) for a, b in slices(offsets)]
    return np.concatenate(out) if out else work(data, offsets)
