"""Decode and gate queries on the events-derived change log."""

from __future__ import annotations

from pyspark.sql import functions as F

from changelake.functions.scalar import doc_id, write_action
from changelake.operators import gate
from changelake.operators.decode import dead_letters, reprocess_dlq
from changelake.plans import fixtures as fx
from changelake.plans.registry import ORACLES, query
from changelake.plans.sql_fixtures import CLASSIFIED_CTE, LATEST_CTE, LOG_CTE, TYPED_DOC_SELECT, with_log
from changelake.session import scratch_dir
from changelake.sources.changelog import replay_from
from changelake.sources.state_store import StateStore, checkpoint_rows, vacuum_state
from changelake.streaming.apply import apply_batch

def event_key_cols():
    return [F.col("table").alias("table_name"), "pk", "lsn", "op",
            F.col("partition").alias("part"), F.col("offset").alias("off")]


@query("current_state", with_log(LATEST_CTE + f"""
SELECT {TYPED_DOC_SELECT} FROM latest WHERE op <> 'd'
"""))
def current_state(spark, sf_dir):
    """Flagship: decode the whole log, gate it, return the live documents."""
    return fx.typed_docs(gate.current_state(fx.good(spark, sf_dir)))


LATEST_SQL = with_log(LATEST_CTE + """
SELECT 'users:' || CAST(user_id AS VARCHAR) AS _id, lsn AS sourceLsn, op, off FROM latest
""")


@query("latest_row_number", LATEST_SQL)
def latest_row_number(spark, sf_dir):
    w = gate.latest_row_number(fx.good(spark, sf_dir))
    return w.select(doc_id("table", "pk").alias("_id"), F.col("lsn").alias("sourceLsn"), "op",
                    F.col("offset").alias("off"))


@query("compact_batch", LATEST_SQL)
def compact_batch(spark, sf_dir):
    w = gate.compact(fx.good(spark, sf_dir), cols=gate.DOC_INPUT)
    return w.select(doc_id("table", "pk").alias("_id"), F.col("lsn").alias("sourceLsn"), "op",
                    F.col("offset").alias("off"))


@query("gate_replay", with_log(LATEST_CTE + f"SELECT {TYPED_DOC_SELECT} FROM latest WHERE op <> 'd'"))
def gate_replay(spark, sf_dir):
    """G1: the whole log delivered a second time at later offsets changes nothing."""
    good = fx.good(spark, sf_dir)
    again = good.withColumn("offset", F.col("offset") + F.lit(1 << 41))
    return fx.typed_docs(gate.current_state(good.unionByName(again)))


@query("gated_delete", with_log(LATEST_CTE + """
SELECT 'users:' || CAST(user_id AS VARCHAR) AS _id, lsn AS sourceLsn FROM latest WHERE op = 'd'
"""))
def gated_delete(spark, sf_dir):
    """Keys whose winning change is a delete (kept as markers in state)."""
    d = gate.to_documents(gate.compact(fx.good(spark, sf_dir), cols=gate.DOC_INPUT))
    return d.filter("_deleted").select("_id", "sourceLsn")


CLASSIFY_SQL = with_log(CLASSIFIED_CTE + """
SELECT CAST(user_id AS VARCHAR) AS pk, off, lsn, status FROM classified
""")


@query("skip_classify", CLASSIFY_SQL)
def skip_classify(spark, sf_dir):
    """Every delivered event as applied / duplicate / stale."""
    c = gate.classify_events(fx.good(spark, sf_dir))
    return c.select("pk", F.col("offset").alias("off"), "lsn", "status")


@query("gate_stale", with_log(CLASSIFIED_CTE + """
SELECT CAST(user_id AS VARCHAR) AS pk, off, lsn FROM classified WHERE status = 'stale'
"""))
def gate_stale(spark, sf_dir):
    """Stale events (lower LSN than one already seen for the key)."""
    c = gate.classify_events(fx.good(spark, sf_dir))
    return c.filter(F.col("status") == "stale").select("pk", F.col("offset").alias("off"), "lsn")


@query("skips_by_table", with_log(CLASSIFIED_CTE + """
SELECT 'users' AS table_name,
       CAST(count(*) FILTER (WHERE status = 'applied') AS BIGINT) AS applied,
       CAST(count(*) FILTER (WHERE status = 'duplicate') AS BIGINT) AS duplicate,
       CAST(count(*) FILTER (WHERE status = 'stale') AS BIGINT) AS stale,
       CAST(count(*) FILTER (WHERE status <> 'applied') AS BIGINT) AS idempotent_skips
FROM classified
"""))
def skips_by_table(spark, sf_dir):
    """A5: idempotent skips per table (duplicates + stale)."""
    c = gate.classify_events(fx.good(spark, sf_dir))
    return c.groupBy(F.col("table").alias("table_name")).agg(
        F.count_if(F.col("status") == "applied").alias("applied"),
        F.count_if(F.col("status") == "duplicate").alias("duplicate"),
        F.count_if(F.col("status") == "stale").alias("stale"),
        F.count_if(F.col("status") != "applied").alias("idempotent_skips"))


@query("decode_ok", with_log("""
SELECT 'users' AS table_name, CAST(user_id AS VARCHAR) AS pk, lsn, op, part, off FROM good
"""))
def decode_ok(spark, sf_dir):
    """normalized events of every good record."""
    return fx.good(spark, sf_dir).select(*event_key_cols())


@query("decode_rejects", with_log("""
SELECT 'cdc.users' AS source_topic, part AS source_partition, off AS source_offset, reason AS error_reason
FROM log WHERE reason IS NOT NULL AND reason <> 'tombstone'
"""))
def decode_rejects(spark, sf_dir):
    """Dead letters with their reason; good records are unaffected."""
    return dead_letters(fx.decoded(spark, sf_dir)).select(
        "source_topic", "source_partition", "source_offset", "error_reason")


def _reason_rows(reason):
    def build(spark, sf_dir):
        d = fx.decoded(spark, sf_dir).filter(F.col("error_reason") == reason)
        return d.select(F.col("offset").alias("off"), F.col("partition").alias("part"))
    return build


for _name, _reason, _doc in (("tombstones", "tombstone", "F2: null / empty / 'null' values, skipped"),
                             ("lsn_invalid", "bad_lsn", "F4: LSN not an integer"),
                             ("pk_invalid", "bad_pk", "F5: key without a number id"),
                             ("after_missing", "after_missing", "F6: non-delete without after image"),
                             ("bad_op", "bad_op", "D15: unknown operation code")):
    _fn = _reason_rows(_reason)
    _fn.__doc__ = _doc
    query(_name, with_log(f"SELECT off, part FROM log WHERE reason = '{_reason}'"))(_fn)


@query("reject_reasons", with_log("""
SELECT reason AS error_reason, count(*) AS n FROM log WHERE reason IS NOT NULL GROUP BY reason
"""))
def reject_reasons(spark, sf_dir):
    d = fx.decoded(spark, sf_dir).filter(F.col("error_reason").isNotNull())
    return d.groupBy("error_reason").agg(F.count("*").alias("n"))


@query("reprocess_dlq", with_log("""
SELECT CAST(user_id AS VARCHAR) AS pk, off AS lsn, op, off FROM log
WHERE reason = 'bad_lsn' AND event_id % 83 <> 0
  AND NOT ((event_id % 71 = 0 OR op <> 'd') AND (op = 'd' OR event_id % 73 = 0))
  AND event_id % 71 <> 0
"""))
def reprocess_dlq_q(spark, sf_dir):
    """Dead letters fixed (the bad LSN replaced by the record offset) and decoded again."""
    dlq = dead_letters(fx.decoded(spark, sf_dir))
    again = reprocess_dlq(dlq, _fix_lsn)
    return again.filter(F.col("error_reason").isNull()).select(
        "pk", "lsn", "op", F.col("offset").alias("off"))


def _fix_lsn(log):
    """The repair of the LSN dead letters: the bad LSN replaced by the record offset."""
    return log.withColumn("value", F.regexp_replace(
        "value", F.lit(r'"lsn":5\.5'), F.concat(F.lit('"lsn":'), F.col("offset").cast("string"))))


REPAIRED_SQL = """
WHERE reason = 'bad_lsn' AND event_id % 83 <> 0
  AND NOT ((event_id % 71 = 0 OR op <> 'd') AND (op = 'd' OR event_id % 73 = 0))
  AND event_id % 71 <> 0"""


@query("dlq_round_trip", with_log(f"""
fixed AS (SELECT user_id, off AS lsn, op, part, off, event_type, value, props FROM log {REPAIRED_SQL}),
allg AS (SELECT user_id, lsn, op, part, off, event_type, value, props FROM good UNION ALL SELECT * FROM fixed),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC, part, off) AS rn
                          FROM allg) WHERE rn = 1)
SELECT {TYPED_DOC_SELECT} FROM latest WHERE op <> 'd'
"""))
def dlq_round_trip(spark, sf_dir):
    """S8 -> S9 -> S7: apply the log, read its dead letters back from the store, repair the
    bad LSNs and apply the repaired records as the next batch."""
    from changelake.operators.decode import dlq_to_log
    store = _store(spark, "dlq-round-trip")
    apply_batch(store, fx.events_log(spark, sf_dir), 0)
    repaired = _fix_lsn(dlq_to_log(store.read_side("dlq").filter(F.col("error_reason") == "bad_lsn")))
    apply_batch(store, repaired, 1)
    return fx.typed_docs(store.current())


def _partial(good):
    """Partial images: some updates omit props or value (by position in the log)."""
    pos = F.col("offset") % F.lit(1 << 40)
    drop = F.when(pos % 3 == 1, F.array(F.lit("props"))).otherwise(F.array().cast("array<string>"))
    drop = F.when(pos % 5 == 2, F.array_union(drop, F.array(F.lit("value")))).otherwise(drop)
    return good.withColumn("after", F.map_filter("after", lambda k, v: ~F.array_contains(drop, k)))


@query("merge_set", with_log(CLASSIFIED_CTE + """,
g2 AS (SELECT *, (off % 1099511627776) % 3 = 1 AS no_props, (off % 1099511627776) % 5 = 2 AS no_value
       FROM classified WHERE status = 'applied'),
last AS (SELECT user_id, max(lsn) AS wl, max(CASE WHEN op = 'd' THEN lsn END) AS dl FROM g2 GROUP BY user_id),
win AS (SELECT g.user_id, g.op, g.lsn FROM g2 g JOIN last l ON g.user_id = l.user_id AND g.lsn = l.wl),
ups AS (SELECT g.* FROM g2 g JOIN last l ON g.user_id = l.user_id
        WHERE g.op <> 'd' AND (l.dl IS NULL OR g.lsn > l.dl)),
f AS (SELECT user_id, arg_max(event_type, lsn) AS event_type,
             arg_max(value, lsn) FILTER (WHERE NOT no_value) AS value,
             arg_max(props, lsn) FILTER (WHERE NOT no_props) AS props
      FROM ups GROUP BY user_id)
SELECT 'users:' || CAST(w.user_id AS VARCHAR) AS _id, CAST(w.user_id AS VARCHAR) AS pk, w.user_id AS _pkId,
       f.event_type AS eventType, f.value AS amount, f.props, TRUE AS isActive, w.lsn AS sourceLsn,
       CAST(1 AS INTEGER) AS schemaVersion
FROM win w LEFT JOIN f ON w.user_id = f.user_id WHERE w.op <> 'd'
"""))
def merge_set_q(spark, sf_dir):
    """$set merge of partial images — absent fields survive, gated by LSN."""
    m = gate.merge_set(_partial(fx.good(spark, sf_dir)))
    return fx.typed_docs(m.filter(~F.col("_deleted")))


FOLD_SQL = "WITH RECURSIVE " + LOG_CTE.strip() + """,
ord AS (SELECT user_id, lsn, op, row_number() OVER (PARTITION BY user_id ORDER BY part, off) AS rn FROM good),
f(user_id, rn, s) AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT) FROM ord
  UNION ALL
  SELECT f.user_id, o.rn,
         CASE WHEN o.op <> 'd' THEN CASE WHEN f.s IS NULL OR f.s < o.lsn THEN o.lsn ELSE f.s END
              ELSE CASE WHEN f.s IS NOT NULL AND f.s < o.lsn THEN NULL ELSE f.s END END
  FROM f JOIN ord o ON o.user_id = f.user_id AND o.rn = f.rn + 1)
SELECT 'users:' || CAST(f.user_id AS VARCHAR) AS _id, f.s AS sourceLsn
FROM f JOIN (SELECT user_id, max(rn) AS mx FROM ord GROUP BY user_id) m ON m.user_id = f.user_id AND f.rn = m.mx
WHERE f.s IS NOT NULL
"""


@query("fold_reference", FOLD_SQL)
def fold_reference_q(spark, sf_dir):
    """The original sequential apply (no delete memory), blockwise; oracle = recursive SQL."""
    f = gate.fold_reference(fx.good(spark, sf_dir))
    return f.select("_id", "sourceLsn")


@query("fold_documents", FOLD_SQL.replace("user_id, lsn, op, row_number()", "user_id, lsn, op, event_id, row_number()")
       .replace("f(user_id, rn, s) AS", "f(user_id, rn, s, e) AS").replace("CAST(NULL AS BIGINT) FROM ord", "CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM ord")
       .replace("THEN NULL ELSE f.s END END\n", "THEN NULL ELSE f.s END END,\n         CASE WHEN o.op <> 'd' AND (f.s IS NULL OR f.s < o.lsn) THEN o.event_id ELSE f.e END\n")
       .replace("f.s AS sourceLsn\nFROM f JOIN", "f.s AS sourceLsn, v.event_type, v.value AS amount\nFROM f JOIN events v ON v.event_id = f.e JOIN"))
def fold_documents(spark, sf_dir):
    """G9 with documents: short keys by one aggregate, long ones (here above 16 events) by blocks whose
    summaries are composed in rounds."""
    f = gate.fold_reference(fx.good(spark, sf_dir), block_size=16)
    return f.select("_id", "sourceLsn", F.col("doc")["event_type"].alias("event_type"), F.col("doc")["value"].cast("double").alias("amount"))


def _store(spark, purpose):
    return StateStore(spark, scratch_dir(spark, purpose), buckets=16)


@query("apply_two_batches", with_log(LATEST_CTE + f"SELECT {TYPED_DOC_SELECT} FROM latest WHERE op <> 'd'"))
def apply_two_batches(spark, sf_dir):
    """The log applied as two batches (split at the middle of its time range)
    through the bucketed state store equals applying it at once."""
    log = fx.events_log(spark, sf_dir)
    mid = log.agg(((F.unix_micros(F.min("timestamp")) + F.unix_micros(F.max("timestamp"))) / 2)
                  .cast("bigint").alias("m")).first()["m"]
    store = _store(spark, "two-batches")
    apply_batch(store, log.filter(F.unix_micros("timestamp") < mid), 0)
    apply_batch(store, log.filter(F.unix_micros("timestamp") >= mid), 1)
    return fx.typed_docs(store.current())


@query("apply_restarted", with_log(LATEST_CTE + f"SELECT {TYPED_DOC_SELECT} FROM latest WHERE op <> 'd'"))
def apply_restarted(spark, sf_dir):
    """The log applied in batches, again by a second writer whose batch ids begin
    anew, then vacuumed of markers below every LSN, then its late half once more."""
    log = fx.events_log(spark, sf_dir).withColumn("late", F.pmod(F.xxhash64("offset"), F.lit(2)) == 1)
    store = _store(spark, "restarted")
    for writer in ("first", "second"):
        for batch, late in enumerate((False, True)):
            apply_batch(store, log.filter(F.col("late") == late).drop("late"), batch, writer=writer)
    store.vacuum(horizon_lsn=0)
    apply_batch(store, log.filter("late").drop("late"), 2, writer="second")
    return fx.typed_docs(store.current())


@query("replay_from", with_log(LATEST_CTE + f"SELECT {TYPED_DOC_SELECT} FROM latest WHERE op <> 'd'"))
def replay_from_q(spark, sf_dir):
    """State as of an LSN, then the log replayed from that LSN through the gate."""
    good = fx.good(spark, sf_dir)
    mid = good.agg(((F.min("lsn") + F.max("lsn")) / 2).cast("bigint").alias("m")).first()["m"]
    early = gate.to_documents(gate.compact(good.filter(F.col("lsn") < mid), cols=gate.DOC_INPUT))
    late = gate.to_documents(gate.compact(replay_from(good, mid), cols=gate.DOC_INPUT))
    final = gate.gate_merge(early, late)
    return fx.typed_docs(final.filter(~F.col("_deleted")))


@query("schema_version_mix", with_log(LATEST_CTE + """
SELECT CAST(1 AS INTEGER) AS schemaVersion, count(*) AS n FROM latest WHERE op <> 'd'
"""))
def schema_version_mix(spark, sf_dir):
    """Live documents per schemaVersion."""
    return gate.current_state(fx.good(spark, sf_dir)).groupBy("schemaVersion").agg(F.count("*").alias("n"))


@query("table_counts", with_log(LATEST_CTE + """
SELECT 'users' AS table_name, count(*) AS n FROM latest WHERE op <> 'd'
"""))
def table_counts(spark, sf_dir):
    """Live documents per target table."""
    return gate.current_state(fx.good(spark, sf_dir)).groupBy(F.col("table").alias("table_name")) \
        .agg(F.count("*").alias("n"))


@query("checkpoint_table", with_log("""
SELECT 'users' AS table_name, part, max(off) AS max_offset, max(lsn) AS max_lsn, count(*) AS events
FROM good GROUP BY part
"""))
def checkpoint_table(spark, sf_dir):
    """Highest offset / LSN applied per (table, partition)."""
    return checkpoint_rows(fx.good(spark, sf_dir)).select(
        F.col("table").alias("table_name"), F.col("partition").alias("part"),
        "max_offset", "max_lsn", "events")


@query("vacuum_state", with_log(LATEST_CTE + """,
h AS (SELECT CAST((min(lsn) + max(lsn)) / 2 AS BIGINT) AS horizon FROM latest)
SELECT 'users:' || CAST(user_id AS VARCHAR) AS _id, op = 'd' AS _deleted, lsn AS sourceLsn
FROM latest, h WHERE op <> 'd' OR lsn >= horizon
"""))
def vacuum_state_q(spark, sf_dir):
    """Delete markers older than the horizon are dropped; live rows stay."""
    st = gate.to_documents(gate.compact(fx.good(spark, sf_dir), cols=gate.DOC_INPUT))
    horizon = st.agg(((F.min("sourceLsn") + F.max("sourceLsn")) / 2).cast("bigint")).first()[0]
    return vacuum_state(st, horizon).select("_id", "_deleted", "sourceLsn")


@query("order_by_key", with_log("""
SELECT CAST(user_id AS VARCHAR) AS pk, off, lsn FROM good
"""))
def order_by_key(spark, sf_dir):
    """Events hash-partitioned by key and ordered by offset inside each partition."""
    g = fx.good(spark, sf_dir).repartition("table", "pk").sortWithinPartitions("table", "pk", "offset")
    return g.select("pk", F.col("offset").alias("off"), "lsn")


@query("write_action", with_log("""
SELECT off, 'users:' || CAST(user_id AS VARCHAR) AS _id,
       CASE WHEN op = 'd' THEN 'delete' ELSE 'upsert' END AS action FROM good
"""))
def write_action_q(spark, sf_dir):
    """Document id and write action of every good event."""
    g = fx.good(spark, sf_dir)
    return g.select(F.col("offset").alias("off"), doc_id("table", "pk").alias("_id"), write_action("op").alias("action"))


def _best_write(name, cond):
    return f"""{name} AS (SELECT * FROM (
  SELECT user_id, value, props, event_type, lsn,
         row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC, part, off) AS rn
  FROM g2 WHERE op <> 'd' AND {cond}) WHERE rn = 1)"""


@query("merge_lww", with_log(f"""
g2 AS (SELECT *, (off % 1099511627776) % 3 = 1 AS no_props, (off % 1099511627776) % 5 = 2 AS no_value FROM good),
win AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC, part, off) AS rn FROM g2)
        WHERE rn = 1),
dl AS (SELECT user_id, max(lsn) AS d FROM g2 WHERE op = 'd' GROUP BY user_id),
{_best_write("fu", "TRUE")},
{_best_write("fv", "NOT no_value")},
{_best_write("fp", "NOT no_props")}
SELECT 'users:' || CAST(w.user_id AS VARCHAR) AS _id, CAST(w.user_id AS VARCHAR) AS pk,
       CASE WHEN dl.d IS NULL OR fu.lsn > dl.d THEN w.user_id END AS _pkId,
       CASE WHEN dl.d IS NULL OR fu.lsn > dl.d THEN fu.event_type END AS eventType,
       CASE WHEN dl.d IS NULL OR fv.lsn > dl.d THEN fv.value END AS amount,
       CASE WHEN dl.d IS NULL OR fp.lsn > dl.d THEN fp.props END AS props,
       TRUE AS isActive, w.lsn AS sourceLsn, CAST(1 AS INTEGER) AS schemaVersion
FROM win w LEFT JOIN dl ON dl.user_id = w.user_id LEFT JOIN fu ON fu.user_id = w.user_id
     LEFT JOIN fv ON fv.user_id = w.user_id LEFT JOIN fp ON fp.user_id = w.user_id
WHERE w.op <> 'd'
"""))
def merge_lww_q(spark, sf_dir):
    """G4 option: per-field last-writer-wins of partial images — independent of delivery order."""
    m = gate.merge_lww(_partial(fx.good(spark, sf_dir)))
    return fx.typed_docs(m.filter(~F.col("_deleted")))


@query("apply_set_two_batches", ORACLES["merge_set"])
def apply_set_two_batches(spark, sf_dir):
    """S7 + G4: partial images applied as two batches through the state store with
    ``$set`` semantics; equals the one-shot merge."""
    log = fx.events_log(spark, sf_dir)
    mid = log.agg(((F.unix_micros(F.min("timestamp")) + F.unix_micros(F.max("timestamp"))) / 2)
                  .cast("bigint").alias("m")).first()["m"]
    store = _store(spark, "set-batches")
    for bid, part in enumerate((log.filter(F.unix_micros("timestamp") < mid),
                                log.filter(F.unix_micros("timestamp") >= mid))):
        apply_batch(store, part, bid, mode="set", transform=_partial)
    return fx.typed_docs(store.current())
