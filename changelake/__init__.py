"""changelake — a Spark-native change-data engine.

Change logs (create / update / delete / snapshot-read events keyed by a
primary key and ordered by a log sequence number) are read as batch or
streaming DataFrames, decoded and validated, mapped by declarative per-table
rules and applied to current-state tables through a sequence-number gate.
"""

from changelake.session import get_spark, read_table, scratch_dir  # noqa: F401

__all__ = ["get_spark", "read_table", "scratch_dir"]
