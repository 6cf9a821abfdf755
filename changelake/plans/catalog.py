"""Imports every query module so the registry is complete."""

from changelake.plans import (alerts, core, embedding, mapping, measures, operations, ordering, reconcile, replay,  # noqa: F401
                              relations, streams, typed)
from changelake.plans.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
