"""Current-state tables on plain Parquet, applied one batch at a time.

Layout under ``base``::

    data/<attempt>/bucket=<k>/part-*.parquet    documents of bucket k, written by one attempt, in up to
                                                ``files`` parts by a hash of the document id
    commits/<n>.json                            {bucket: attempt}, and the last batch of each writer
    _dlq/writer=<w>/batch=<b>/                  dead letters of a batch
    _checkpoints/writer=<w>/batch=<b>/          max offset / LSN applied per table, partition

The store numbers its commits itself; callers' batch ids never name a state. A
batch reads the buckets it touches (``pmod(xxhash64(_id), N)``) from the newest
commit, merges them through the LSN gate, writes a new ``data/<attempt>``
directory and then the next commit. Nothing live is ever overwritten: an attempt
that dies before its commit leaves only unused files. A commit remembers the last
batch of its writer (a stream's id), so a batch that is run again after its state
was committed is recognised; batches without a writer are simply applied again,
which the gate makes a no-op. A stream that starts anew, dead letters applied
beside a stream and a vacuum all build on the newest commit.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.session import PACKED, settings

STATE_COLS = ["_id", "table", "pk", "sourceLsn", "schemaVersion", "_deleted", "doc", "appliedTsMs",
              "_srcPartition", "_srcOffset", "lastOp"]


def bucket_of(id_col="_id", buckets: int = 64):
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


class StateStore:
    def __init__(self, spark: SparkSession, base: str, buckets: int = 64, files: int = 1, group_of=None,
                 keep: int | None = None, rounds: int = 1):
        """``files``: parts that a bucket is written in, a task each. ``group_of``: from the id
        column the column whose hash picks the bucket (so that documents of one group are read
        together); the id itself if not given. ``keep``: how many of the newest commits stay
        readable; the files that only older ones name are deleted after each commit. All, if not given.
        ``rounds``: in how many groups a write's buckets are written, one after the other, so that
        a round's shuffle is that share of the rows; the batch's rows are read in each."""
        if keep is not None and keep < 1:
            raise ValueError("keep: the newest commit is the state")
        self.spark = spark
        self.base = base.rstrip("/")
        self.buckets, self.files, self.keep, self.rounds = buckets, files, keep, rounds
        self._group_of = group_of or (lambda c: c)
        jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.base).getFileSystem(self._conf)

    def bucket_of(self, id_col="_id"):
        """The bucket of a document id."""
        return bucket_of(self._group_of(F.col(id_col) if isinstance(id_col, str) else id_col), self.buckets)

    # -- commits ----------------------------------------------------------
    def versions(self) -> list[int]:
        d = self._Path(self.base + "/commits")
        if not self._fs.exists(d):
            return []
        names = [st.getPath().getName() for st in self._fs.listStatus(d)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def _commit_at(self, version: int | None = None) -> dict:
        """Newest commit, or the newest up to ``version``."""
        vs = [v for v in self.versions() if version is None or v <= version]
        if not vs:
            return {"version": -1, "buckets": {}, "writers": {}}
        stream = self._fs.open(self._Path(f"{self.base}/commits/{vs[-1]:012d}.json"))
        try:
            reader = self.spark._jvm.java.io.BufferedReader(self.spark._jvm.java.io.InputStreamReader(stream))
            text = reader.readLine()
        finally:
            stream.close()
        c = json.loads(text)
        return {"version": vs[-1], "buckets": {int(k): v for k, v in c["buckets"].items()}, "writers": c["writers"]}

    def _commit(self, prior: dict, buckets: dict[int, str], writer: str | None, batch_id: int | None) -> None:
        """Publish the next commit by renaming a complete file to a name that is not taken."""
        writers = dict(prior["writers"])
        if writer is not None:
            writers[writer] = max(batch_id, writers.get(writer, batch_id))
        version = prior["version"] + 1
        dst = self._Path(f"{self.base}/commits/{version:012d}.json")
        tmp = self._Path(f"{self.base}/commits/.{version:012d}.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(tmp, False)
        try:
            out.write(bytearray(json.dumps({"buckets": {str(k): v for k, v in sorted(buckets.items())},
                                            "writers": writers}).encode()))
        finally:
            out.close()
        if self._fs.exists(dst) or not self._fs.rename(tmp, dst):
            raise RuntimeError(f"another writer has committed version {version}")

    def committed(self, writer: str | None, batch_id: int | None) -> bool:
        """Whether the state already holds this writer's batch."""
        return writer is not None and batch_id <= self._commit_at()["writers"].get(writer, -1)

    # -- reads ------------------------------------------------------------
    def _empty(self) -> DataFrame:
        schema = ("_id string, table string, pk string, sourceLsn bigint, schemaVersion int, "
                  "_deleted boolean, doc map<string,string>, appliedTsMs bigint, _srcPartition int, "
                  "_srcOffset bigint, lastOp string, bucket int")
        return self.spark.createDataFrame([], schema)

    def read(self, buckets: list[int] | None = None, version: int | None = None) -> DataFrame:
        """All state rows (delete markers included) of the given buckets."""
        return self._rows(self._commit_at(version)["buckets"], buckets)

    def _rows(self, where: dict[int, str], buckets=None) -> DataFrame:
        paths = [f"{self.base}/data/{d}/bucket={b}" for b, d in sorted(where.items())
                 if buckets is None or b in set(buckets)]
        if not paths:
            return self._empty()
        df = self.spark.read.schema(self._empty().drop("bucket").schema).parquet(*paths)
        return df.withColumn("bucket", self.bucket_of())

    def current(self, version: int | None = None) -> DataFrame:
        """Live documents only (delete markers dropped)."""
        return self.read(version=version).filter(~F.col("_deleted")).drop("bucket")

    # -- writes -----------------------------------------------------------
    def groups(self, touched) -> list[list[int]]:
        """Some buckets in the groups that are written one after the other."""
        touched = sorted(int(b) for b in touched)
        return [g for g in (touched[i::self.rounds] for i in range(self.rounds)) if g]

    def _within(self, rows: DataFrame, group: list[int], touched) -> DataFrame:
        """Rows (with ``bucket``) of a group of the touched buckets."""
        return rows if len(group) == len(touched) else rows.where(F.col("bucket").isin(group))

    def _replace(self, prior: dict, touched, rows_of, writer=None, batch_id=None) -> None:
        """Write the rows (with ``bucket``) that ``rows_of`` gives for each group of the touched
        buckets as their new content and commit. A bucket that is left without rows leaves the commit."""
        attempt = uuid.uuid4().hex
        out = f"{self.base}/data/{attempt}"
        for group in self.groups(touched):
            rows = rows_of(group)
            # A task has one bucket (``_dealt``): it needs no sort by bucket, which would spill its rows.
            with settings({"spark.sql.maxConcurrentOutputFileWriters": "2"}, rows.sparkSession):
                rows.drop("_part").write.options(**PACKED).mode("append").partitionBy("bucket").parquet(out)
        buckets = {b: d for b, d in prior["buckets"].items() if b not in set(touched)}
        buckets.update({b: attempt for b in self._written_buckets(out)})
        self._commit(prior, buckets, writer, batch_id)
        if self.keep is not None:
            self._forget(self.versions()[:-self.keep])

    def _forget(self, versions: list[int]) -> None:
        """Delete commits, oldest first, and then what no commit that is left names. A crash in
        between leaves unused files."""
        if not versions:
            return
        places = lambda vs: {(d, b) for v in vs for b, d in self._commit_at(v)["buckets"].items()}
        unused = places(versions) - places(v for v in self.versions() if v not in versions)
        for v in versions:
            self._fs.delete(self._Path(f"{self.base}/commits/{v:012d}.json"), False)
        for d, b in sorted(unused):
            self._fs.delete(self._Path(f"{self.base}/data/{d}/bucket={b}"), True)

    def apply(self, docs: DataFrame, batch_id: int | None = None, touched: list[int] | None = None,
              writer: str | None = None) -> int:
        """Merge compacted state rows of one batch; returns the number of touched buckets.

        ``touched`` (bucket ids of the batch) can be passed in when the caller already
        knows them cheaply; otherwise the documents are persisted and scanned for them.
        """
        if self.committed(writer, batch_id):
            return 0
        docs = docs.select(*STATE_COLS).withColumn("bucket", self.bucket_of())
        cached = touched is None
        if cached:
            docs = docs.persist()
            touched = [r[0] for r in docs.select("bucket").distinct().collect()]  # <= N small ints
        try:
            if not touched:
                return 0
            prior = self._commit_at()

            def merged(group: list[int]) -> DataFrame:
                rows, stored = self._within(docs, group, touched), [b for b in group if b in prior["buckets"]]
                if stored:
                    return merge_parts(self._dealt(self._rows(prior["buckets"], stored).unionByName(rows), group))
                return self._dealt(rows, group)   # first write of these buckets: batch rows are already one per document
            self._replace(prior, touched, merged, writer, batch_id)
            return len(touched)
        finally:
            if cached:
                docs.unpersist()

    def rewrite(self, batch_id: int | None, touched: list[int], build, writer: str | None = None) -> int:
        """Replace the touched buckets by ``build(stored rows of those buckets)``.

        For merges that need the stored rows themselves (``$set`` of partial images):
        ``build`` returns the complete new rows of the touched buckets, of which each round keeps its own.
        """
        if not touched or self.committed(writer, batch_id):
            return 0
        prior = self._commit_at()

        def built(group: list[int]) -> DataFrame:
            new = build(self._rows(prior["buckets"], group).drop("bucket")).select(*STATE_COLS).withColumn("bucket", self.bucket_of())
            return self._dealt(self._within(new, group, touched), group)
        self._replace(prior, touched, built, writer, batch_id)
        return len(touched)

    def _dealt(self, rows: DataFrame, touched) -> DataFrame:
        """Rows (with ``bucket``) dealt to one task per part of each touched bucket: ``_part`` is the
        task, so no two buckets meet in one while another idles. Rows of one id share a part."""
        touched = sorted(int(b) for b in touched)
        place = self.spark.range(len(touched)).select(
            F.element_at(F.lit(touched), (F.col("id") + 1).cast("int")).alias("bucket"), F.col("id").cast("int").alias("_at"))
        part = F.col("_at") * self.files + F.pmod(F.xxhash64("_id", F.lit("part")), F.lit(self.files)).cast("int")
        return rows.join(place, "bucket").withColumn("_part", part).drop("_at") \
            .repartitionById(len(touched) * self.files, "_part")

    def write_side(self, kind: str, df: DataFrame, batch_id: int, writer: str | None = None, more: bool = False) -> None:
        """Per-batch side output (dead letters, checkpoints), overwritten when the same writer
        runs the batch again. ``more``: added to what this run has written of it."""
        df.write.options(**PACKED).mode("append" if more else "overwrite") \
            .parquet(f"{self.base}/_{kind}/writer={writer or 'manual'}/batch={batch_id}")

    def read_side(self, kind: str) -> DataFrame | None:
        p = self._Path(f"{self.base}/_{kind}")
        if not self._fs.exists(p):
            return None
        return self.spark.read.parquet(f"{self.base}/_{kind}")

    def vacuum(self, horizon_lsn: int) -> None:
        """Rewrite every bucket without delete markers older than ``horizon_lsn``."""
        prior = self._commit_at()
        if prior["buckets"]:
            self._replace(prior, prior["buckets"], lambda group: self._dealt(
                vacuum_state(self._rows(prior["buckets"], group), horizon_lsn), group))

    def _written_buckets(self, path: str) -> list[int]:
        p = self._Path(path)
        if not self._fs.exists(p):
            return []
        return [int(st.getPath().getName().split("=", 1)[1]) for st in self._fs.listStatus(p)
                if st.isDirectory() and st.getPath().getName().startswith("bucket=")]


def merge_parts(rows: DataFrame) -> DataFrame:
    """Gate merge of stored rows and batch rows, both dealt by ``_part``, as one aggregation per
    document: the winner (higher LSN, on a tie the earlier delivery) is picked inside its part,
    so the output is laid out for the write. Equivalent to ``gate_merge``'s full outer join,
    with one shuffle instead of two."""
    rest = [c for c in STATE_COLS if c != "_id"]
    order = F.struct(F.col("sourceLsn"), (-F.col("_srcPartition")).alias("np"), (-F.col("_srcOffset")).alias("no"))
    return (rows.groupBy("_part", "bucket", "_id").agg(F.max_by(F.struct(*rest), order).alias("_w"))
            .select("_part", "_id", "_w.*", "bucket"))


def vacuum_state(state: DataFrame, horizon_lsn) -> DataFrame:
    """G14 as a transform: drop delete markers older than the horizon."""
    return state.filter(~F.col("_deleted") | (F.col("sourceLsn") >= F.lit(horizon_lsn)))


def checkpoint_rows(events: DataFrame) -> DataFrame:
    """Highest offset and LSN applied per (table, partition)."""
    return events.groupBy("table", "partition").agg(
        F.max("offset").alias("max_offset"), F.max("lsn").alias("max_lsn"), F.count("*").alias("events"))
