"""The original sequential apply (no delete memory), computed blockwise.

Per key and in delivery order: an upsert is applied when nothing is stored
or the stored LSN is lower; a delete removes the stored row when its LSN is
higher. A block of a key's history acts on the stored LSN ``x`` (or nothing,
``x = -inf``) as a step function: the first event with LSN above ``x`` is the
first applied one, and from there on the run no longer depends on ``x``. So
a block is summarised by the record LSNs of its prefix maxima, each with the
outcome of the run that starts there, plus identity above its largest LSN.

Keys of at most ``block_size`` events, nearly all in practice, are folded by one
built-in aggregate over their events in order. The events of longer keys are sorted by
ranges of (key, position); each task cuts its range into blocks of ``block_size``
events of one key and summarises them. Step functions compose, so the summaries of ``FAN``
neighbouring blocks become one, round after round, until a key has few enough to be run in
order. No group is larger than one block of raw events or ``FAN`` summaries, however hot the
key, and a task goes through its groups in one call.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changelake.functions.scalar import doc_id
from changelake.functions.scan import DEFAULT_BLOCK
from changelake.session import written

#: Neighbouring blocks whose summaries become one in a round.
FAN = 64
#: Rows of a batch that a task hands back.
OUT_ROWS = 1000

# The task functions below travel with the job (pickled by value), so Python
# workers need pyarrow only, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SUMMARY_SCHEMA = "table string, pk string, _blk long, piece int, lo long, hi long, identity boolean, out_lsn long, out_doc string"
FINAL_SCHEMA = "table string, pk string, sourceLsn long, doc_json string"
_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}


def _summarise(events: list[tuple]) -> list[tuple]:
    """The step function of a block: (lsn, op, doc) in order -> pieces (lo, hi, identity, lsn, doc)."""
    L = [e[0] for e in events]
    ops = [e[1] for e in events]
    docs = [e[2] for e in events]
    n = len(L)
    nge = [-1] * n          # next strictly greater LSN
    nxt_up = [-1] * n       # next upsert
    stack: list[int] = []
    last_up = -1
    for j in range(n - 1, -1, -1):
        while stack and L[stack[-1]] <= L[j]:
            stack.pop()
        nge[j] = stack[-1] if stack else -1
        stack.append(j)
        nxt_up[j] = last_up
        if ops[j] != "d":
            last_up = j
    out: list[tuple] = [(None, None)] * n   # state after running the block from event j, j applied
    for j in range(n - 1, -1, -1):
        k = nge[j] if ops[j] != "d" else nxt_up[j]
        if k >= 0:
            out[j] = out[k]
        else:
            out[j] = (L[j], docs[j]) if ops[j] != "d" else (None, None)
    pieces: list[tuple] = []
    prev = None
    for j in range(n):
        if prev is None or L[j] > prev:          # a new prefix maximum starts a piece [prev, L[j])
            if pieces and pieces[-1][3:] == out[j]:
                pieces[-1] = (pieces[-1][0], L[j], False, *out[j])   # same outcome as the piece before: widen it
            else:
                pieces.append((prev, L[j], False, *out[j]))
            prev = L[j]
    return [*pieces, (prev, None, True, None, None)]


def _at(pieces: list[tuple], state: int | None) -> tuple:
    """The piece of a step function (lo, hi, identity, lsn, doc) that holds ``state``."""
    for piece in pieces:
        lo, hi, identity = piece[:3]
        if (lo is None if state is None else (lo is None or lo <= state) and (identity or state < hi)):
            return piece
    raise ValueError("a step function covers every state")


def _then(f: list[tuple], g: list[tuple]) -> list[tuple]:
    """The step function of ``f`` and then ``g``."""
    out: list[tuple] = []

    def add(piece):
        if out and not piece[2] and not out[-1][2] and out[-1][3:] == piece[3:]:
            out[-1] = (out[-1][0], *piece[1:])           # same outcome as the piece before: widen it
        else:
            out.append(piece)
    for lo, hi, identity, lsn, doc in f:
        if not identity:
            then = _at(g, lsn)
            add((lo, hi, False, lsn, doc) if then[2] else (lo, hi, False, *then[3:]))
            continue
        for piece in g:                                  # states from lo on reach g as they are
            if piece[2] or lo is None or piece[1] > lo:
                first = piece[0] if lo is None or (piece[0] is not None and piece[0] > lo) else lo
                add((first, *piece[1:]))
    return out


def _runs(batches, n: int):
    """Of sorted rows: (their first ``n`` values, the rest of each) for rows that agree in these."""
    key, rows = None, []
    for batch in batches:
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and r[:n] != key:
                yield key, rows
                rows = []
            key = r[:n]
            rows.append(r[n:])
    if rows:
        yield key, rows


def _out(rows, schema: str):
    """Rows as Arrow batches of a schema."""
    fields = pa.schema([(name, _ARROW[kind]) for name, kind in (f.split() for f in schema.split(", "))])

    def batch(part):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), fields)], schema=fields)
    part = []
    for r in rows:
        part.append(r)
        if len(part) == OUT_ROWS:
            yield batch(part)
            part = []
    if part:
        yield batch(part)


def _numbered(head: tuple, pieces: list[tuple]) -> list[tuple]:
    return [(*head, i, *piece) for i, piece in enumerate(pieces)]


def _cut(block_size: int):
    """Task function: events sorted by key and position -> summaries of blocks, numbered in order."""
    def rows(batches):
        key, block, nr = None, [], 0
        for batch in batches:
            for table, pk, rng, *event in zip(*(c.to_pylist() for c in batch.columns)):
                if block and (len(block) == block_size or (table, pk) != key[:2]):
                    yield from _numbered((*key[:2], (key[2] << 40) + nr), _summarise(block))
                    block, nr = [], nr + 1
                key = (table, pk, rng)
                block.append(tuple(event))
        if block:
            yield from _numbered((*key[:2], (key[2] << 40) + nr), _summarise(block))
    return lambda batches: _out(rows(batches), SUMMARY_SCHEMA)


def _compose(batches):
    """Task function: summaries sorted by (key, ``_up``, ``_blk``, piece) -> one for each ``_up``."""
    def rows():
        head, whole = None, None
        for (*up, _), block in _runs(batches, 4):
            pieces = [r[1:] for r in block]
            if up == head:
                whole = _then(whole, pieces)
                continue
            if head:
                yield from _numbered(tuple(head), whole)
            head, whole = up, pieces
        if head:
            yield from _numbered(tuple(head), whole)
    return _out(rows(), SUMMARY_SCHEMA)


def _chain(batches):
    """Task function: summaries sorted by (key, ``_blk``, piece), run in order -> the row a key is left with."""
    def rows():
        key, state, doc = None, None, None
        for (*now, _), block in _runs(batches, 3):
            if now != key:
                if state is not None:
                    yield (*key, state, doc)
                key, state, doc = now, None, None
            piece = _at([r[1:] for r in block], state)
            if not piece[2]:
                state, doc = piece[3:]
        if state is not None:
            yield (*key, state, doc)
    return _out(rows(), FINAL_SCHEMA)


def _fold_short(ev: DataFrame) -> DataFrame:
    """Keys with few events: one aggregate over the events in order."""
    def step(acc, x):
        newer = acc["lsn"].isNull() | (acc["lsn"] < x["lsn"])
        gone = F.struct(F.lit(None).cast("bigint").alias("lsn"), F.lit(None).cast("string").alias("doc"))
        put = F.struct(x["lsn"].alias("lsn"), x["aj"].alias("doc"))
        return F.when(x["op"] != "d", F.when(newer, put).otherwise(acc)).otherwise(F.when(acc["lsn"] < x["lsn"], gone).otherwise(acc))
    start = F.struct(F.lit(None).cast("bigint").alias("lsn"), F.lit(None).cast("string").alias("doc"))
    events = F.array_sort(F.collect_list(F.struct("partition", "offset", "lsn", "op", "aj")))
    folded = ev.groupBy("table", "pk").agg(events.alias("e")).select("table", "pk", F.aggregate("e", start, step).alias("s"))
    return folded.where("s.lsn IS NOT NULL").select("table", "pk", F.col("s.lsn").alias("sourceLsn"), F.col("s.doc").alias("doc_json"))


def _fold_long(ev: DataFrame, block_size: int) -> DataFrame:
    """Keys with many events: summaries of blocks, composed in rounds."""
    place = ["table", "pk", "partition", "offset"]
    events = ev.repartitionByRange(*place).withColumn("_rng", F.spark_partition_id().cast("bigint")) \
        .sortWithinPartitions(*place, "lsn", "op", "aj").select("table", "pk", "_rng", "lsn", "op", "aj")
    summaries = written(events.mapInArrow(_cut(block_size), SUMMARY_SCHEMA), "fold-blocks")
    # Blocks numbered from 0 within their key: a narrow row a block.
    number = F.row_number().over(Window.partitionBy("table", "pk").orderBy("_blk")) - 1
    numbers = summaries.where("piece = 0").select("table", "pk", "_blk").withColumn("_nr", number.cast("bigint"))
    pieces = ["piece", "lo", "hi", "identity", "out_lsn", "out_doc"]
    now = summaries.join(numbers, ["table", "pk", "_blk"]).select("table", "pk", F.col("_nr").alias("_blk"), *pieces)
    most = (numbers.agg(F.max("_nr")).first()[0] or 0) + 1
    while most > FAN:
        up = F.floor(F.col("_blk") / F.lit(FAN)).alias("_up")
        now = written(now.select("table", "pk", up, "_blk", *pieces).repartition("table", "pk", "_up")
                      .sortWithinPartitions("table", "pk", "_up", "_blk", "piece").mapInArrow(_compose, SUMMARY_SCHEMA), "fold-round")
        most = -(-most // FAN)
    return now.repartition("table", "pk").sortWithinPartitions("table", "pk", "_blk", "piece").mapInArrow(_chain, FINAL_SCHEMA)


def fold_reference(events: DataFrame, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Rows left by the sequential apply: ``_id, table, pk, sourceLsn, doc`` (the image of
    the applied upsert that set the LSN — the full-image contract)."""
    ev = written(events.select("table", "pk", "partition", "offset", "lsn", "op", F.to_json("after").alias("aj")), "fold")
    long = written(ev.groupBy("table", "pk").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_size).select("table", "pk"), "fold-long")
    if long.isEmpty():
        final = _fold_short(ev)
    else:
        final = _fold_short(ev.join(long, ["table", "pk"], "left_anti")).unionByName(
            _fold_long(ev.join(long, ["table", "pk"], "left_semi"), block_size))
    return final.select(doc_id("table", "pk").alias("_id"), "table", "pk", "sourceLsn",
                        F.from_json("doc_json", "map<string,string>").alias("doc"))
