"""Session helpers: building a session, loading tables, shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "changelake",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings every job here assumes (UTC, AQE on)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.mapKeyDedupPolicy", "LAST_WIN"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on; safe to call repeatedly."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # transform_keys (rename rules) may map two keys onto one; keep the last.
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    # A JSON object that repeats a key keeps the last value, in variants as in maps.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory under the shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used
    as is. Only when it is unset (local runs, tests) do we pick a local
    temporary folder and register it, so ``DataFrame.checkpoint`` works too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="changelake-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    path = os.path.join(base, f"{purpose}-{uuid.uuid4().hex[:12]}")
    return path


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to shared scratch storage and read back: computed once, whatever reads it
    later and whichever executors are lost meanwhile; readers get only the columns they use."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: What the job writes to read it again itself is packed tighter than by Spark's default codec.
PACKED = {"compression": "zstd"}
#: A query's shuffle files go when it ends, not when the driver's garbage collector comes to them: a
#: job of many steps else holds the shuffles of several on disk.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(conf: dict[str, str], *sessions: SparkSession):
    """The sessions' settings for the length of the block."""
    before = [(s, k, s.conf.get(k)) for s in sessions for k in conf]
    try:
        for s, k, _ in before:
            s.conf.set(k, conf[k])
        yield
    finally:
        for s, k, value in before:
            s.conf.set(k, value)


@contextmanager
def scratch(spark: SparkSession):
    """Gives ``keep(df, purpose)``, which is ``written`` for the length of the block: the files go
    at its end. For steps that read a result several times and repeat without end, as a stream's
    batches do; nothing stays in the executors' memory."""
    paths = []

    def keep(df: DataFrame, purpose: str) -> DataFrame:
        paths.append(scratch_dir(spark, purpose))
        df.write.options(**PACKED).parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])
    try:
        yield keep
    finally:
        for path in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def recommended_conf(input_bytes: int, state_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a cluster run, sized from the data instead of defaults.

    * shuffle partitions: the log is compacted to about the state's size before it is
      shuffled, so that size in 200 MB tasks, at least 3 waves of the cluster's cores and at
      most 40,000 (map tasks times partitions is what driver and shuffle service must track);
      AQE coalesces smaller stages and splits skewed partitions of joins;
    * file splits of 1 GB for scans, for fewer map tasks;
    * streaming aggregation state (``gate_stream``) in RocksDB, not on the JVM heap;
    * ``state_buckets``: number of state-store buckets so one bucket's file is ~512 MB —
      a batch then rewrites only the buckets it touches, each in one task.
    """
    mb = 1 << 20
    shuffle = min(max(cores * 3, int(state_bytes / (200 * mb)) + 1), 40_000)
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * mb),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(1024 * mb),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.session.timeZone": "UTC",
        "state_buckets": str(max(16, int(state_bytes / (512 * mb)) + 1)),
    }
