"""WARC archives in Zstandard frames: writing pages and reading archives back.

An archive begins with a skippable frame that holds the dictionary; then each record is a
frame of its own, compressed with that dictionary, with its size and checksum. The reader
loads the dictionary, finds each frame's end from its block headers, decodes one frame per
record and checks the record's version line, headers, lengths and payload digest.

Records of equal payloads of at least ``MIN_REVISIT`` bytes are written once: the one with
the smallest id is the response, the others are revisits that refer to it.

Spark's own writer commits the files, so a retried task leaves no half archive: a record's
frame is a "line" of the text format, and the line end is an empty skippable frame, which
readers pass over. One archive per task; its size follows the size of the input splits.

Edge cases: a null payload is empty; a null or odd URL becomes the record's URN (line ends
are escaped); a null id is written as ``null`` and read back as null, and never becomes a
response that others refer to (if all ids of a group are null, all are responses); rows that
repeat the smallest id are all responses; an empty table gives archives without records.
A record that fails a check is an error, or with ``strict=False`` a row with ``error`` set.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.llm.common import small_batches, stable, uniform

MIN_REVISIT = 100
DICTIONARY_BYTES = 32_768
SAMPLE_PAGES = 256
SAMPLE_CHARS = 8_192
LEVEL = 6
#: Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC = 0x184D2A50
FRAME_MAGIC = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: An empty skippable frame.
LINE_END = struct.pack("<II", SKIPPABLE_MAGIC, 0)


def train_dictionary(spark: SparkSession, pages: DataFrame, id_col: str, payload_col: str) -> bytes:
    """A dictionary from a bounded, hash-chosen sample (at most ``SAMPLE_PAGES`` payloads,
    ``SAMPLE_CHARS`` characters of each); empty if there is nothing to learn from."""
    picked = pages.select(uniform(id_col, seed=17).alias("u"), F.col(id_col).alias("id")).distinct() \
        .orderBy("u", "id").limit(SAMPLE_PAGES)
    texts = pages.join(F.broadcast(picked), pages[id_col] == picked["id"]) \
        .select("u", "id", F.substring(F.col(payload_col), 1, SAMPLE_CHARS).alias("t")).where("t <> ''") \
        .orderBy("u", "id", "t").limit(SAMPLE_PAGES).collect()
    samples = [r.t.encode() for r in texts]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:            # too few samples to train on: use them as they are
        return b"".join(samples)[:DICTIONARY_BYTES]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def record(page: str, url: str | None, payload: bytes, digest: str, leader: str | None) -> bytes:
    """One WARC record: a response, or a revisit of ``leader``."""
    urn = f"urn:page:{page}"
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url) if url else urn
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if leader is None else http
    lines = ["WARC/1.1", f"WARC-Type: {'response' if leader is None else 'revisit'}", f"WARC-Record-ID: <{urn}>",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha256:{digest}",
             "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if leader is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{leader}>"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends, from its header and block headers."""
    if len(data) - at < 8:
        raise ValueError("truncated frame")
    magic, size = struct.unpack_from("<II", data, at)
    if magic & ~0xF == SKIPPABLE_MAGIC:
        end = at + 8 + size
    elif magic == FRAME_MAGIC:
        flags = data[at + 4]
        single = flags >> 5 & 1
        end = at + 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + ((single, 2, 4, 8)[flags >> 6])
        last = 0
        while not last:
            if end + 3 > len(data):
                raise ValueError("truncated frame")
            head = int.from_bytes(data[end:end + 3], "little")
            last = head & 1
            end += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        end += 4 * (flags >> 2 & 1)
    else:
        raise ValueError(f"no frame at byte {at}")
    if end > len(data):
        raise ValueError("truncated frame")
    return end


def _headers(text: bytes) -> dict[str, str]:
    out = {}
    for line in text.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise ValueError("bad header line")
        out[name.decode().lower()] = value.strip().decode()
    return out


def parse_record(data: bytes) -> dict:
    """The checked fields of one decoded record."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or not version.startswith(b"WARC/1."):
        raise ValueError("no WARC version line")
    named = _headers(lines)
    for needed in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if needed not in named:
            raise ValueError(f"no {needed} header")
    size = int(named["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("record length differs from its header")
    status, gap, payload = rest[:size].partition(b"\r\n\r\n")
    if not gap or not status.startswith(b"HTTP/"):
        raise ValueError("no HTTP headers")
    full = int(_headers(status.partition(b"\r\n")[2])["content-length"])
    kind, digest = named["warc-type"], named["warc-payload-digest"].removeprefix("sha256:")
    page = named["warc-record-id"].strip("<>").removeprefix("urn:page:")
    refers = named.get("warc-refers-to", "").strip("<>").removeprefix("urn:page:") or None
    if kind == "response":
        if len(payload) != full or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("payload differs from its headers")
    elif kind != "revisit" or payload or refers is None:
        raise ValueError("neither a response nor a whole revisit")
    return {"page": None if page == "null" else page, "record_type": kind, "refers_to": refers,
            "target_uri": named.get("warc-target-uri"), "payload_bytes": full, "payload_digest": digest,
            "payload": payload if kind == "response" else None, "error": None}


def records(archive: memoryview) -> Iterator[dict]:
    """Rows of one archive; a bad record gives a row with ``error``, a bad frame ends the
    archive with one."""
    bad = dict.fromkeys(["page", "record_type", "refers_to", "target_uri", "payload_bytes", "payload_digest", "payload"])
    if not len(archive):
        return
    try:
        at = frame_end(archive, 0)
        if struct.unpack_from("<I", archive)[0] != DICTIONARY_MAGIC:
            raise ValueError("no dictionary frame at the start")
        decoder = zstandard.ZstdDecompressor(dict_data=_dictionary(bytes(archive[8:at])))
        while at < len(archive):
            end = frame_end(archive, at)
            if struct.unpack_from("<I", archive, at)[0] == FRAME_MAGIC:
                try:
                    yield parse_record(decoder.decompress(archive[at:end]))
                except (ValueError, KeyError, zstandard.ZstdError) as wrong:
                    yield bad | {"error": f"record at byte {at}: {wrong}"}
            at = end
    except ValueError as wrong:
        yield bad | {"error": str(wrong)}


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html") -> None:
    """Archives of all rows in the folder ``path``."""
    spark = pages.sparkSession
    small_batches(spark)
    dictionary = spark.sparkContext.broadcast(train_dictionary(spark, pages, id_col, payload_col))
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    digests = pages.select(F.col(id_col).alias("id"), F.sha2(payload, 256).alias("leader_digest"),
                           F.octet_length(payload).alias("size"))
    # Only payloads that occur again: usually few, and then joined without a shuffle.
    leaders = stable(digests.where(F.col("size") >= MIN_REVISIT).groupBy("leader_digest")
                     .agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload")) \
        .withColumn("digest", F.sha2("payload", 256)) \
        .join(leaders, F.col("digest") == F.col("leader_digest"), "left") \
        .select(F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("page"), "url", "payload", "digest",
                F.when(~F.col("id").eqNullSafe(F.col("leader")), F.col("leader").cast("string")).alias("leader"))

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = dictionary.value
        encoder = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(data), write_checksum=True)
        yield pa.RecordBatch.from_arrays([pa.array([struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data],
                                                   pa.binary())], ["value"])
        for batch in batches:
            frames = [encoder.compress(record(*row)) for row in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["value"])

    rows.mapInArrow(compress, "value binary").select(F.col("value").cast("string")) \
        .write.option("lineSep", LINE_END.decode()).option("maxRecordsPerFile", 0).text(path)


RECORD = ("page string, record_type string, refers_to string, target_uri string, payload_bytes bigint, "
          "payload_digest string, payload binary, error string")


def read_archives(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """One row per record of all archives in a folder (``RECORD``)."""
    small_batches(spark)
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(f.split()[0], kinds.get(f.split()[0], pa.string())) for f in RECORD.split(", ")])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for archive in batch.column(0):
                for row in records(memoryview(archive.as_buffer())):
                    if strict and row["error"]:
                        raise ValueError(row["error"])
                    rows.append(row)
                    size += len(row["payload"] or b"")
                    if len(rows) >= 1000 or size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(decode, RECORD)
