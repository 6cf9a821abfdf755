"""Declarative per-table mapping rules.

A rule names a source table, the target it is written to, and per-field
settings: a target name, a type to cast to, a default for missing values,
an allowed value list, a rendering format, whether JSON text is embedded as
a nested value, and child tables embedded as arrays. Rules are small and
are turned into Column expressions on the driver when the plan is built.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class FieldRule:
    type: str = "string"
    target: str | None = None
    default: Any = None
    enum: tuple | None = None
    format: str | None = None
    embed: bool = False
    index: Any = None


@dataclass(frozen=True)
class JoinRule:
    kind: str
    source: str
    on: str
    target: str
    fields: dict[str, FieldRule] = field(default_factory=dict)

    @property
    def child_table(self) -> str:
        return table_of_source(self.source)

    def keys(self) -> tuple[str, str]:
        """(child column, parent column) of an ``a.x = b.y`` condition."""
        left, right = (s.strip() for s in self.on.split("="))
        lt, lc = left.split(".")
        rt, rc = right.split(".")
        return (lc, rc) if lt == self.child_table else (rc, lc)


@dataclass(frozen=True)
class Rule:
    source: str
    target: str
    fields: dict[str, FieldRule] = field(default_factory=dict)
    schema_version: int = 1
    id_strategy: str = "pk"
    emit: str | None = None
    joins: tuple[JoinRule, ...] = ()

    @property
    def table(self) -> str:
        return table_of_source(self.source)

    def renames(self) -> dict[str, str]:
        return {k: f.target for k, f in self.fields.items() if f.target}

    def validate(self) -> "Rule":
        if not self.table:
            raise ValueError(f"rule for {self.target!r}: empty source")
        targets = [f.target or k for k, f in self.fields.items()]
        if len(set(targets)) != len(targets):
            raise ValueError(f"rule {self.source}: two fields map to one target")
        return self


def table_of_source(src: str) -> str:
    """``public.users`` -> ``users`` (text after the last dot)."""
    return src.rsplit(".", 1)[-1] if src else ""


# ---------------------------------------------------------------------------
# The three mapping rules the source system ships with
# (users, orders, order_items), field by field as published.
# ---------------------------------------------------------------------------
USERS_RULE = Rule(
    source="public.users", target="users", schema_version=1, id_strategy="pk",
    fields={
        "id": FieldRule(type="bigint", target="_pkId"),
        "email": FieldRule(type="string", target="email", index={"kind": "unique"}),
        "full_name": FieldRule(type="string", target="fullName"),
        "profile": FieldRule(type="jsonb", target="profile", embed=True),
        "is_active": FieldRule(type="boolean", target="isActive", default=True),
        "created_at": FieldRule(type="timestamptz", target="createdAt", format="iso8601", index=True),
        "updated_at": FieldRule(type="timestamptz", target="updatedAt", format="iso8601"),
    })

ORDERS_RULE = Rule(
    source="public.orders", target="orders", schema_version=1, id_strategy="pk",
    fields={
        "id": FieldRule(type="bigint", target="_pkId"),
        "user_id": FieldRule(type="bigint", target="userId", index=True),
        "status": FieldRule(type="string", target="status", index=True,
                            enum=("pending", "paid", "shipped", "cancelled")),
        "total_cents": FieldRule(type="bigint", target="totalCents"),
        "created_at": FieldRule(type="timestamptz", target="createdAt", format="iso8601", index=True),
        "updated_at": FieldRule(type="timestamptz", target="updatedAt", format="iso8601"),
    },
    joins=(JoinRule(
        kind="embed", source="public.order_items", on="order_items.order_id = orders.id",
        target="items",
        fields={
            "id": FieldRule(type="bigint", target="_pkId"),
            "sku": FieldRule(type="string", target="sku"),
            "qty": FieldRule(type="int", target="qty"),
            "price_cents": FieldRule(type="bigint", target="priceCents"),
        }),))

ORDER_ITEMS_RULE = Rule(
    source="public.order_items", target="order_items", schema_version=1, id_strategy="pk",
    emit="lookup-only",
    fields={
        "id": FieldRule(type="bigint", target="_pkId"),
        "order_id": FieldRule(type="bigint", target="orderId", index=True),
        "sku": FieldRule(type="string", target="sku"),
        "qty": FieldRule(type="int", target="qty"),
        "price_cents": FieldRule(type="bigint", target="priceCents"),
    })

DEFAULT_RULES = {r.table: r for r in (USERS_RULE, ORDERS_RULE, ORDER_ITEMS_RULE)}


# ---------------------------------------------------------------------------
# Loading rules from a directory (S10). Rule files are tiny and read once on
# the driver; JSON always, YAML when PyYAML happens to be installed.
# ---------------------------------------------------------------------------
def _field(d: dict) -> FieldRule:
    enum = d.get("enum")
    return FieldRule(type=d.get("type", "string"), target=d.get("target"),
                     default=d.get("default"), enum=tuple(enum) if enum else None,
                     format=d.get("format"), embed=bool(d.get("embed", False)),
                     index=d.get("index"))


def rule_from_dict(d: dict) -> Rule:
    joins = tuple(JoinRule(kind=j["kind"], source=j["source"], on=j["on"], target=j["target"],
                           fields={k: _field(v) for k, v in (j.get("fields") or {}).items()})
                  for j in d.get("joins") or ())
    return Rule(source=d.get("source", ""), target=d.get("target", ""),
                fields={k: _field(v) for k, v in (d.get("fields") or {}).items()},
                schema_version=int(d.get("schemaVersion", 1)),
                id_strategy=d.get("idStrategy", "pk"), emit=d.get("emit"), joins=joins).validate()


def load_rules(directory: str) -> dict[str, Rule]:
    """Every rule file (``*.json``, ``*.yml``, ``*.yaml``) in a directory, by table. A rule file
    that cannot be read and a second rule for a table are errors: a rule is never left out."""
    out: dict[str, Rule] = {}
    for name in sorted(os.listdir(directory)):
        if not name.endswith((".json", ".yml", ".yaml")):
            continue
        with open(os.path.join(directory, name)) as fh:
            if name.endswith(".json"):
                d = json.load(fh)
            else:
                try:
                    import yaml  # type: ignore
                except ImportError as missing:
                    raise ValueError(f"{name}: reading YAML rules needs the yaml package") from missing
                d = yaml.safe_load(fh)
        r = rule_from_dict(d)
        if r.table in out:
            raise ValueError(f"{name}: table {r.table!r} has another rule already")
        out[r.table] = r
    return out


def rule_to_dict(r: Rule) -> dict:
    def f(x: FieldRule) -> dict:
        d = {"type": x.type, "target": x.target}
        for k in ("default", "format", "index"):
            if getattr(x, k) is not None:
                d[k] = getattr(x, k)
        if x.enum:
            d["enum"] = list(x.enum)
        if x.embed:
            d["embed"] = True
        return d
    d = {"source": r.source, "target": r.target, "schemaVersion": r.schema_version,
         "idStrategy": r.id_strategy, "fields": {k: f(v) for k, v in r.fields.items()}}
    if r.emit:
        d["emit"] = r.emit
    if r.joins:
        d["joins"] = [{"kind": j.kind, "source": j.source, "on": j.on, "target": j.target,
                       "fields": {k: f(v) for k, v in j.fields.items()}} for j in r.joins]
    return d
