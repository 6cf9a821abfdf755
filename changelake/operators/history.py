"""Row history: version intervals per key from a change log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.functions.scan import DEFAULT_BLOCK, lead_by_rank
from changelake.session import written


def history(events: DataFrame, keys=("table", "pk"), block_rows: int = DEFAULT_BLOCK) -> DataFrame:
    """One row per distinct (key, LSN): ``valid_from`` = LSN, ``valid_to`` = the key's next
    LSN (null for the current version), the op and image of the first delivery of that LSN.
    LSNs are byte positions with any gaps: the rows of a long key are cut by rank."""
    first = (events.groupBy(*keys, "lsn")
             .agg(F.min_by(F.struct("op", "after", "offset"), F.struct("partition", "offset")).alias("_f"))
             .select(*keys, "lsn", "_f.op", "_f.after"))
    h = lead_by_rank(written(first, "history"), list(keys), "lsn", ["lsn"], "next_", block_rows)
    return h.select(*keys, F.col("lsn").alias("valid_from"), F.col("next_lsn").alias("valid_to"),
                    "op", "after", F.col("next_lsn").isNull().alias("is_current"))
