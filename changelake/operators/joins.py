"""Joins of the data model: embed children, incremental embed, orphans, cascade
deletes, insert-if-absent, natural-key upsert, deletion audit (J1-J9)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.session import written


def embed(parent: DataFrame, child: DataFrame, child_fk: str, parent_key: str, target: str,
          fields: list[str], sort_by: list[str] | None = None) -> DataFrame:
    """Children as a nested, sorted array on each parent; no children -> empty array.

    Children are aggregated per key first (partial aggregation map-side), then
    joined once to the parents, so only one row per parent crosses the join.
    """
    sort_by = sort_by or fields
    items = F.struct(*[F.col(c) for c in sort_by], *[F.col(c) for c in fields if c not in sort_by])
    agg = (child.groupBy(F.col(child_fk).alias("_fk"))
           .agg(F.sort_array(F.collect_list(items)).alias("_items")))
    j = parent.join(agg, parent[parent_key] == agg["_fk"], "left")
    proj = F.transform(F.coalesce(F.col("_items"), F.array().cast(agg.schema["_items"].dataType)),
                       lambda x: F.struct(*[x[c].alias(c) for c in fields]))
    return j.withColumn(target, proj).drop("_fk", "_items")


def embed_paged(parent: DataFrame, child: DataFrame, child_fk: str, parent_key: str, target: str,
                fields: list[str], page_size: int, sort_by: list[str] | None = None) -> DataFrame:
    """J1 for parents with very many children: the children of a parent are spread over
    ``ceil(n / page_size)`` pages by a hash of the child row, so no group (and no output
    row) holds more than about ``page_size`` items however hot the parent. Every child
    is kept; a parent without children gets page 0 with an empty array. Output adds ``page``.
    """
    sort_by = sort_by or fields
    counts = child.groupBy(F.col(child_fk).alias("_fk")).agg(F.count("*").alias("_n"))
    text = F.concat_ws(":", *[F.col(c).cast("string") for c in fields])
    pages = F.ceil(F.col("_n") / F.lit(float(page_size))).cast("bigint")
    c = child.join(counts, child[child_fk] == counts["_fk"]) \
             .withColumn("page", F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), pages))
    items = F.struct(*[F.col(x) for x in sort_by], *[F.col(x) for x in fields if x not in sort_by])
    agg = c.groupBy("_fk", "page").agg(F.sort_array(F.collect_list(items)).alias("_items"))
    j = parent.join(agg, parent[parent_key] == agg["_fk"], "left")
    proj = F.transform(F.coalesce(F.col("_items"), F.array().cast(agg.schema["_items"].dataType)),
                       lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    return j.withColumn("page", F.coalesce(F.col("page"), F.lit(0).cast("bigint"))) \
            .withColumn(target, proj).drop("_fk", "_items")


def touched_parents(changed_parent_keys: DataFrame, changed_children: DataFrame, child_fk: str) -> DataFrame:
    """Keys of parents whose own row or any child changed (one column ``_key``)."""
    return (changed_parent_keys.toDF("_key")
            .unionByName(changed_children.select(F.col(child_fk).alias("_key")))
            .distinct())


def embed_incremental(parent: DataFrame, child: DataFrame, touched: DataFrame, child_fk: str,
                      parent_key: str, target: str, fields: list[str], sort_by=None) -> DataFrame:
    """Re-embed only touched parents, reading children from current child state."""
    p = parent.join(touched, parent[parent_key] == touched["_key"], "left_semi")
    c = child.join(touched, child[child_fk] == touched["_key"], "left_semi")
    return embed(p, c, child_fk, parent_key, target, fields, sort_by)


def orphans(child: DataFrame, parent: DataFrame, child_fk: str, parent_key: str) -> DataFrame:
    """Children whose parent does not exist."""
    return child.join(parent, child[child_fk] == parent[parent_key], "left_anti")


def cascade_deletes(parent_deletes: DataFrame, child: DataFrame, child_fk: str, key: str = "pk") -> DataFrame:
    """Every child of a deleted parent, as the child delete it implies."""
    return child.join(parent_deletes, child[child_fk] == parent_deletes[key], "left_semi") \
                .withColumn("op", F.lit("d"))


@dataclass(frozen=True)
class ForeignKey:
    """``child.column`` holds a primary key of ``parent``; ``key`` is the child's own primary key."""
    child: str
    column: str
    parent: str
    key: str = "id"


def cascade(deletes: DataFrame, tables: dict[str, DataFrame], foreign_keys: list[ForeignKey]) -> DataFrame:
    """All deletes that a set of deletes (table, pk, lsn) implies over the foreign keys, as change
    events: table, pk, lsn, op ``d``, before (the row's image) and depth (1: child of a given delete).

    The rows found last are joined with the child tables of theirs until a round finds none, so
    chains of any length and cycles of keys end. A row that several parents take along goes
    once, at the first round and the lowest LSN of it. Each round is written to shared storage."""
    found = deletes.select("table", "pk", "lsn", F.lit(0).alias("depth"))
    frontier, reached, events, depth = found, {fk.parent for fk in foreign_keys}, [], 0
    while True:
        depth += 1
        parts = []
        for fk in foreign_keys:
            if fk.parent not in reached:
                continue
            gone = frontier.where(F.col("table") == fk.parent).select(F.col("pk").alias("_pk"), F.col("lsn").alias("_lsn"))
            rows = tables[fk.child]
            image = F.create_map(*[x for c in rows.columns for x in (F.lit(c), F.col(c).cast("string"))])
            parts.append(rows.join(gone, rows[fk.column].cast("string") == gone["_pk"]).select(
                F.lit(fk.child).alias("table"), F.col(fk.key).cast("string").alias("pk"), F.col("_lsn").alias("lsn"), image.alias("before")))
        if not parts:
            break
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        # Maps do not compare, so the image is that of the lowest LSN.
        once = every.groupBy("table", "pk").agg(F.min("lsn").alias("lsn"), F.min_by("before", "lsn").alias("before"))
        new = written(once.join(found.select("table", "pk"), ["table", "pk"], "left_anti").withColumn("depth", F.lit(depth)), "cascade")
        if new.isEmpty():
            break
        events.append(new)
        found = found.unionByName(new.select("table", "pk", "lsn", "depth"))
        frontier, reached = new, {fk.child for fk in foreign_keys if fk.parent in reached}
    if not events:
        events = [found.where("false").withColumn("before", F.lit(None).cast("map<string,string>"))]
    out = events[0]
    for part in events[1:]:
        out = out.unionByName(part)
    return out.select("table", "pk", "lsn", F.lit("d").alias("op"), "before", "depth")


def insert_absent(target: DataFrame, new: DataFrame, key: str, order_col: str | None = None) -> DataFrame:
    """``INSERT .. ON CONFLICT DO NOTHING``: new rows whose key is absent are added.

    Within ``new`` the first row per key (by ``order_col``) is the one inserted.
    """
    first = new
    if order_col:
        first = new.groupBy(key).agg(F.min_by(F.struct(*new.columns), F.col(order_col)).alias("_r")).select("_r.*")
    else:
        first = new.dropDuplicates([key])
    add = first.join(target.select(key), key, "left_anti")
    return target.unionByName(add)


def upsert_by(target: DataFrame, new: DataFrame, key: str, set_cols: list[str], order_col: str) -> DataFrame:
    """``ON CONFLICT (key) DO UPDATE SET set_cols``: matched rows take the new values of
    ``set_cols`` and keep every other column; unmatched new rows are inserted. Several new
    rows with one key: the last by ``order_col`` wins."""
    last = new.groupBy(key).agg(F.max_by(F.struct(*new.columns), F.col(order_col)).alias("_r")).select("_r.*")
    t = target.alias("t")
    n = last.alias("n")
    j = t.join(n, F.col(f"t.{key}") == F.col(f"n.{key}"), "full_outer")
    matched_or_new = F.col(f"n.{key}").isNotNull()
    out = []
    for c in target.columns:
        if c == key:
            out.append(F.coalesce(F.col(f"t.{c}"), F.col(f"n.{c}")).alias(c))
        elif c in set_cols:
            out.append(F.when(matched_or_new, F.col(f"n.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(F.col(f"t.{key}").isNotNull(), F.col(f"t.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
    return j.select(*out)


def deletion_audit(last_ops: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Keys whose last change is a delete but which are still present downstream."""
    deleted = last_ops.filter(F.col("op") == "d").select(key)
    return target.join(deleted, key, "left_semi")


def trace_rows(src: DataFrame, tgt: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """chosen keys in source and target side by side (full outer on the key)."""
    s = src.join(keys, key, "left_semi")
    t = tgt.join(keys, key, "left_semi")
    sc = [F.col(c).alias("src_" + c) for c in src.columns if c != key]
    tc = [F.col(c).alias("tgt_" + c) for c in tgt.columns if c != key]
    return s.select(key, *sc, F.lit(True).alias("in_src")).join(
        t.select(key, *tc, F.lit(True).alias("in_tgt")), key, "full_outer") \
        .fillna(False, subset=["in_src", "in_tgt"])
