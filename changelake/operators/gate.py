"""The sequence-number gate: compaction, classification, merge.

Ordering rule everywhere: a change with a higher log sequence number (LSN)
wins; between equal LSNs the one delivered first (lowest partition, offset)
wins, so exact replays and stale events change nothing. Deletes leave a
marker row (``_deleted``) that keeps its LSN, so a stale upsert after a
delete cannot bring the row back; ``fold_reference`` reproduces the original
sequential behaviour without that memory, for parity checks.

Compaction uses ``max_by`` — an aggregate with a map-side partial step — so a
hot key is reduced inside every map task before the shuffle, instead of a
window that would sort all of the key's rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelake.functions.scalar import doc_id
from changelake.functions.scan import DEFAULT_BLOCK, prefix_max_before

KEY = ["table", "pk"]


def win_order() -> Column:
    """Higher LSN first; on equal LSN the earliest delivery."""
    return F.struct(F.col("lsn"), (-F.col("partition")).alias("np"), (-F.col("offset")).alias("no"))


def _place(side: str) -> Column:
    """The same order over the fields of a struct column."""
    return F.struct(F.col(f"{side}.lsn"), (-F.col(f"{side}.partition")).alias("np"), (-F.col(f"{side}.offset")).alias("no"))


DOC_INPUT = ["lsn", "op", "after", "ts_ms", "partition", "offset"]


def compact(events: DataFrame, keys=KEY, cols: list[str] | None = None) -> DataFrame:
    """The winning change per key (full images), one row per key.

    ``cols`` limits what is carried through the aggregate (the winner's other
    columns); pass only what the consumer needs, the aggregate sorts it.
    """
    rest = [c for c in (cols or events.columns) if c not in keys]
    return (events.groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), win_order()).alias("_w"))
            .select(*keys, "_w.*"))


def latest_row_number(events: DataFrame, keys=KEY) -> DataFrame:
    """W4 cross-check of ``compact`` by ``row_number`` (sorts whole keys; parity tool)."""
    w = Window.partitionBy(*keys).orderBy(F.col("lsn").desc(), "partition", "offset")
    return events.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def to_documents(winners: DataFrame, versions: Column | int = 1) -> DataFrame:
    """Winners -> state rows: ``_id, table, pk, sourceLsn, schemaVersion, _deleted, doc``.

    P12/P13/P14: the document is the after image; deletes become markers.
    """
    v = versions if isinstance(versions, Column) else F.lit(versions)
    return winners.select(
        doc_id("table", "pk").alias("_id"), "table", "pk",
        F.col("lsn").alias("sourceLsn"), v.cast("int").alias("schemaVersion"),
        (F.col("op") == "d").alias("_deleted"),
        F.when(F.col("op") != "d", F.col("after")).alias("doc"),
        F.col("ts_ms").alias("appliedTsMs"),
        F.col("partition").alias("_srcPartition"), F.col("offset").alias("_srcOffset"),
        F.col("op").alias("lastOp"))


def current_state(events: DataFrame, versions: Column | int = 1) -> DataFrame:
    """Live documents from a whole change log: compact, drop deletes."""
    docs = to_documents(compact(events, cols=DOC_INPUT), versions)
    return docs.filter(~F.col("_deleted"))


def gate_merge(state: DataFrame, docs: DataFrame) -> DataFrame:
    """Merge compacted batch documents into stored state.

    A batch document replaces the stored one only when it wins the ordering
    (higher LSN; on equal LSN the earlier delivery), or when nothing is stored.
    Both sides carry the state row schema.
    """
    s = state.alias("s")
    b = docs.alias("b")
    j = s.join(b, F.col("s._id") == F.col("b._id"), "full_outer")

    def pos(side):
        return F.struct(F.col(f"{side}.sourceLsn"), -F.col(f"{side}._srcPartition"), -F.col(f"{side}._srcOffset"))
    take_b = F.col("b._id").isNotNull() & (F.col("s._id").isNull() | (pos("b") > pos("s")))
    cols = [c for c in docs.columns]
    return j.select(*[F.when(take_b, F.col(f"b.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in cols])


def classify_events(events: DataFrame, state: DataFrame | None = None,
                    block_size: int | None = DEFAULT_BLOCK) -> DataFrame:
    """Label each event ``applied``, ``duplicate`` (equal LSN) or ``stale`` (lower LSN).

    The bar an event must pass is the highest LSN among earlier deliveries of
    its key and the stored LSN. Earlier deliveries are found by a blocked
    prefix scan, so a hot key is spread over many tasks.
    """
    ev = events.withColumn("_pseudo", F.lit(False))
    if state is not None:
        # the stored LSN enters as a pseudo-event ordered before every delivery of its key,
        # so the prefix scan carries it — no join of (possibly hot) keys against state rows
        stored = state.select("table", "pk", F.col("sourceLsn").alias("lsn"),
                              F.lit(-1).cast("int").alias("partition"), F.lit(-1).cast("bigint").alias("offset"),
                              F.lit(True).alias("_pseudo"))
        ev = ev.unionByName(stored, allowMissingColumns=True)
    ev = prefix_max_before(ev, KEY, "offset", "lsn", "_prev", group=["partition"], block_size=block_size)
    ev = ev.filter(~F.col("_pseudo")).drop("_pseudo").withColumn("_stored", F.lit(None).cast("bigint"))
    bar = F.greatest("_prev", "_stored")
    status = (F.when(bar.isNull() | (F.col("lsn") > bar), F.lit("applied"))
               .when(F.col("lsn") == bar, F.lit("duplicate"))
               .otherwise(F.lit("stale")))
    return ev.withColumn("status", status).drop("_prev", "_stored")


def merge_set(events: DataFrame, state: DataFrame | None = None,
              block_size: int | None = DEFAULT_BLOCK, versions: Column | int = 1) -> DataFrame:
    """Gated ``$set`` merge of partial images.

    Fields absent from a new image survive from the stored document; an
    explicit null overwrites. Only applied events count, and only those after
    the last applied delete of the key; per field the highest-LSN value wins.
    Returns state rows (``_id, table, pk, sourceLsn, schemaVersion, _deleted, doc``);
    ``versions`` is the schemaVersion that a written document gets (an expression over ``table``).
    """
    version = (versions if isinstance(versions, Column) else F.lit(versions)).cast("int")
    touched = None
    if state is not None:
        # only stored rows of keys this batch touches take part; the others pass through
        marked = state.join(events.select(*KEY).distinct().withColumn("_hit", F.lit(True)), KEY, "left")
        touched = marked.filter("_hit").drop("_hit")
    cl = classify_events(events, touched, block_size).filter(F.col("status") == "applied")
    rows = cl.select(*KEY, "lsn", "op", "ts_ms", "partition", "offset", version.alias("version"), "after")
    if state is not None:
        # a stored document is one more applied change: its LSN is below all that were applied now
        rows = rows.unionByName(touched.select(
            *KEY, F.col("sourceLsn").alias("lsn"), F.when(F.col("_deleted"), F.lit("d")).otherwise(F.col("lastOp")).alias("op"),
            F.col("appliedTsMs").alias("ts_ms"), F.col("_srcPartition").alias("partition"),
            F.col("_srcOffset").alias("offset"), F.col("schemaVersion").alias("version"), F.col("doc").alias("after")))
    # one cell per field of a change and one (no name) for the change itself, reduced map-side,
    # so a key has at most one cell per field before its document is put together
    head = F.struct("op", "lsn", "ts_ms", "partition", "offset", "version")
    cell = "array<struct<f:string,v:string,h:struct<op:string,lsn:bigint,ts_ms:bigint,partition:int,offset:bigint,version:int>>>"
    entries = F.transform(F.map_entries("after"), lambda e: F.struct(e["key"].alias("f"), e["value"].alias("v"), F.lit(None).alias("h")))
    cells = F.concat(F.array(F.struct(F.lit(None).alias("f"), F.lit(None).alias("v"), head.alias("h"))).cast(cell),
                     F.when((F.col("op") != "d") & F.col("after").isNotNull(), entries.cast(cell)).otherwise(F.array().cast(cell)))
    per_field = rows.select(*KEY, "lsn", F.inline(cells)).groupBy(*KEY, "f").agg(
        F.max_by(F.struct("v", "lsn", "h"), "lsn").alias("c"), F.max(F.when(F.col("h.op") == "d", F.col("lsn"))).alias("_del"))
    merged = per_field.groupBy(*KEY).agg(
        F.collect_list(F.when(F.col("f").isNotNull(), F.struct("f", F.col("c.v").alias("v"), F.col("c.lsn").alias("lsn")))).alias("_fields"),
        F.max("_del").alias("_del"), F.first("c.h", ignorenulls=True).alias("_win"))
    # a field survives only if its newest value came after the key's last applied delete
    kept = F.filter("_fields", lambda x: F.col("_del").isNull() | (x["lsn"] > F.col("_del")))
    doc = F.map_from_entries(F.transform(kept, lambda x: F.struct(x["f"], x["v"])))
    out = merged.select(
        doc_id("table", "pk").alias("_id"), "table", "pk", F.col("_win.lsn").alias("sourceLsn"),
        F.col("_win.version").alias("schemaVersion"), (F.col("_win.op") == "d").alias("_deleted"),
        F.when(F.col("_win.op") != "d", doc).alias("doc"),
        F.col("_win.ts_ms").alias("appliedTsMs"),
        F.col("_win.partition").alias("_srcPartition"), F.col("_win.offset").alias("_srcOffset"),
        F.col("_win.op").alias("lastOp"))
    if state is None:
        return out
    return out.unionByName(marked.filter("_hit is null").select(*out.columns))


def merge_lww(events: DataFrame, state: DataFrame | None = None, versions: Column | int = 1) -> DataFrame:
    """G4 option: per-field last-writer-wins merge of partial images (order-free).

    Every field keeps the value of its newest write — higher LSN, on equal LSN the
    earlier delivery (partition, offset) — if that write is newer than the key's
    latest delete; the document is live when the key's newest change is not a
    delete. The result depends only on the set of changes, not on their order or on
    how they are cut into batches. Rows carry ``fieldVersion`` (per field: lsn,
    partition, offset of the kept write) and ``deletedAt`` (the latest delete's place) so the output can be
    passed back as ``state``. Every step is a per-key or per-(key, field) aggregate
    with map-side partial aggregation.
    """
    pos = F.struct(F.col("lsn"), (-F.col("partition")).alias("np"), (-F.col("offset")).alias("no"))
    ev = events.select(*KEY, "lsn", "op", "after", "ts_ms", "partition", "offset")
    heads = ev.drop("after")
    fields = ev.filter(F.col("op") != "d").select(*KEY, "lsn", "partition", "offset",
                                                  F.explode("after").alias("f", "v"))
    dels = ev.filter(F.col("op") == "d").select(*KEY, "lsn", "partition", "offset")
    if state is not None:
        heads = heads.unionByName(state.select(
            "table", "pk", F.col("sourceLsn").alias("lsn"), F.col("lastOp").alias("op"),
            F.col("appliedTsMs").alias("ts_ms"), F.col("_srcPartition").alias("partition"),
            F.col("_srcOffset").alias("offset")))
        stored = state.select("table", "pk", F.explode("doc").alias("f", "v"), "fieldVersion")
        fields = fields.unionByName(stored.select(
            "table", "pk", F.col("fieldVersion")[F.col("f")]["lsn"].alias("lsn"),
            F.col("fieldVersion")[F.col("f")]["partition"].alias("partition"),
            F.col("fieldVersion")[F.col("f")]["offset"].alias("offset"), "f", "v"))
        dels = dels.unionByName(state.filter(F.col("deletedAt").isNotNull()).select(*KEY, "deletedAt.*"))
    win = heads.groupBy(*KEY).agg(F.max_by(F.struct("op", "lsn", "ts_ms", "partition", "offset"), pos).alias("_w"))
    horizon = dels.groupBy(*KEY).agg(F.max_by(F.struct("lsn", "partition", "offset"), pos).alias("_del"))
    best = fields.groupBy(*KEY, "f").agg(F.max_by(F.struct("v", "lsn", "partition", "offset"), pos).alias("_b"))
    kept = (best.join(horizon, KEY, "left")
            .filter(F.col("_del").isNull() | (_place("_b") > _place("_del")))
            .groupBy(*KEY).agg(
                F.map_from_entries(F.collect_list(F.struct("f", F.col("_b.v")))).alias("_doc"),
                F.map_from_entries(F.collect_list(F.struct(
                    "f", F.struct(F.col("_b.lsn").alias("lsn"), F.col("_b.partition").alias("partition"),
                                  F.col("_b.offset").alias("offset"))))).alias("_fv")))
    out = win.join(horizon, KEY, "left").join(kept, KEY, "left")
    live = F.col("_w.op") != "d"
    fv_type = "map<string,struct<lsn:bigint,partition:int,offset:bigint>>"
    return out.select(
        doc_id("table", "pk").alias("_id"), "table", "pk", F.col("_w.lsn").alias("sourceLsn"),
        (versions if isinstance(versions, Column) else F.lit(versions)).cast("int").alias("schemaVersion"), (~live).alias("_deleted"),
        F.when(live, F.coalesce("_doc", F.create_map().cast("map<string,string>"))).alias("doc"),
        F.col("_w.ts_ms").alias("appliedTsMs"), F.col("_w.partition").alias("_srcPartition"),
        F.col("_w.offset").alias("_srcOffset"), F.col("_w.op").alias("lastOp"),
        F.coalesce("_fv", F.create_map().cast(fv_type)).alias("fieldVersion"),
        F.col("_del").alias("deletedAt"))


def fold_reference(events: DataFrame, block_size: int | None = None) -> DataFrame:
    """The original sequential apply without delete memory (see ``operators.fold``)."""
    from changelake.operators.fold import fold_reference as blocked_fold
    return blocked_fold(events, block_size) if block_size else blocked_fold(events)
