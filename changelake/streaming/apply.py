"""Streaming apply: change log -> decode -> gate -> state, one batch at a time.

Each micro-batch runs ``apply_batch`` inside ``foreachBatch``: decode once
(written once, it feeds state, dead letters and checkpoint rows), compact to one
change per key, merge the touched buckets, then write the side outputs.
Structured Streaming writes the offset log before and the commit log after
the function, so a batch that fails is re-run with the same id and rows;
the state store makes that re-run idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.operators.decode import dead_letters, decode, good_events
from changelake.operators.gate import DOC_INPUT, compact, merge_set, to_documents
from changelake.operators.mapping import apply_rule, emit_filter, emitted, rule_versions, shape_events, validate_enums, validate_types
from changelake.functions.scalar import doc_id
from changelake.session import scratch
from changelake.sources.state_store import StateStore, bucket_of, checkpoint_rows


def apply_batch(store: StateStore, log: DataFrame, batch_id: int, rules=None,
                max_value_bytes: int | None = None, fail_after_state: bool = False, mode: str = "full",
                transform=None, writer: str | None = None, shape: bool = False) -> None:
    """One batch: decode, (map), gate, write state, then side outputs.

    ``shape``: rules also type, format and embed the stored fields, fill in defaults, and reject
    values outside a field's ``enum``; without it they rename, cast-check and stamp.

    ``mode="full"``: every image is a full row (compaction, the fast path);
    ``mode="set"``: partial images merged field by field into the stored document.
    ``transform`` is applied to the good events before the gate (e.g. a projection).
    ``writer`` names who numbers the batches (a stream's id), so that one run again after
    its state was committed is recognised.
    """
    decoded = decode(log, max_value_bytes)
    if rules:
        decoded = validate_types(decoded, rules)
        if shape:
            decoded = validate_enums(decoded, rules)
    bad = F.col("error_reason").isNotNull()
    if rules and transform is None:   # good rows of lookup-only tables end here; their rejected rows are dead letters
        decoded = decoded.filter(bad | F.coalesce(emitted(rules), F.lit(False)))
    # a slim decode, written once: raw key/value are kept only on rejected rows (for the DLQ)
    slim = decoded.select(*[c for c in decoded.columns if c not in ("key", "value")],
                          F.when(bad, F.col("key")).alias("key"), F.when(bad, F.col("value")).alias("value"),
                          bucket_of(doc_id("table", "pk"), store.buckets).alias("_bucket"))
    with scratch(store.spark) as keep:
        slim = keep(slim, "decoded")
        good = good_events(slim)
        if transform is not None:
            good = transform(good)
        kept = slim.filter(~bad)
        versions = 1
        if rules:
            # mapping stage in the same job: lookup-only tables stay out of the written state,
            # images are renamed by their table's rule, documents carry the rule's version
            good = emit_filter(good, rules)
            good = shape_events(good, rules, mode == "set") if shape else apply_rule(good, rules, images=("after",))
            kept = emit_filter(kept, rules)
            versions = rule_versions(rules)
        touched = [r[0] for r in kept.select("_bucket").distinct().collect()]   # <= N small ints
        if mode == "set":
            store.rewrite(batch_id, touched, lambda old: merge_set(good, old, versions=versions), writer)
        else:
            store.apply(to_documents(compact(good, cols=DOC_INPUT), versions), batch_id, touched, writer)
        if fail_after_state:  # crash-test hook: die between the state write and the side outputs
            raise RuntimeError("injected failure after state write")
        store.write_side("dlq", dead_letters(slim), batch_id, writer)
        store.write_side("checkpoints", checkpoint_rows(good), batch_id, writer)


def stream_apply(spark: SparkSession, source_dir: str, store: StateStore, checkpoint: str,
                 fmt: str = "parquet", max_files_per_trigger: int | None = None,
                 available_now: bool = True, rules=None, pattern: str = ".*", mode: str = "full", shape: bool = False):
    """Start the apply stream over every topic matching ``pattern``; returns the query."""
    from changelake.sources.changelog import read_changelog
    log = read_changelog(spark, source_dir, pattern=pattern, stream=True, fmt=fmt,
                         max_files_per_trigger=max_files_per_trigger)
    writer = (log.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda df, bid: apply_batch(store, df, bid, rules, mode=mode, writer=stream_id(df), shape=shape)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    return writer.start()


def stream_id(df: DataFrame) -> str | None:
    """The id of the streaming query that runs this batch; it lives in the query's checkpoint."""
    return df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
