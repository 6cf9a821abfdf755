"""Live progress counters of a streaming query.

Counters are declared with ``observe`` on the streaming DataFrame; each
micro-batch reports them in its progress event, and a listener keeps one row
per (query, batch) on the driver — a row per batch, not per record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from changelake.operators.decode import decode


class ProgressCollector(StreamingQueryListener):
    def __init__(self, name: str):
        self.name = name
        self.rows: list[dict] = []

    def onQueryStarted(self, event):  # noqa: N802 - listener API
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        m = p.observedMetrics.get(self.name)
        if m is not None:
            self.rows.append({"batch_id": p.batchId, "input_rows": p.numInputRows, **m.asDict()})

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass

    def wait_for(self, last_batch_id: int, timeout_s: float = 60.0) -> None:
        """Listener events arrive asynchronously; wait until the given batch was seen."""
        import time
        end = time.time() + timeout_s
        while time.time() < end:
            if any(r["batch_id"] >= last_batch_id for r in self.rows):
                return
            time.sleep(0.1)
        raise TimeoutError(f"no progress event for batch {last_batch_id}")


def decode_counters() -> list[Column]:
    reason = F.col("error_reason")
    return [F.count(F.lit(1)).alias("records"), F.count_if(reason.isNull()).alias("good"),
            F.count_if(reason.isNotNull() & (reason != "tombstone")).alias("rejected"),
            F.count_if(reason == "tombstone").alias("tombstones")]


def observed_decode(log: DataFrame, name: str = "decode_progress") -> DataFrame:
    """The decoded stream with its progress counters attached."""
    return decode(log).observe(name, *decode_counters())


def collect_progress(spark: SparkSession, name: str) -> ProgressCollector:
    c = ProgressCollector(name)
    spark.streams.addListener(c)
    return c
