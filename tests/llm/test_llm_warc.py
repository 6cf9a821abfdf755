"""WARC archives: round trip, revisits, validation."""

import hashlib
import os
import struct

import pytest
import zstandard

from changelake.llm import warc


def pages(spark):
    long = "<p>" + "é😀 text " * 60
    rows = [(1, "http://a/1", long), (2, "http://a/2", long), (0, None, long + "!"), (7, "http://x/\r\nInjected: 1", "<b>"),
            (5, "", None), (6, "u", ""), (3, "http://a/3", "<b>"), (9, "v", "z" * 99), (8, "v", "z" * 99), (11, "v", "z" * 100), (10, "v", "z" * 100),
            (None, "n", long), (2, "http://a/2", long), (12, "w", "big " * 200_000), (13, "w", "a\r\n\r\nb\0c" * 30)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def expected(rows):
    first = {}
    for ident, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 100 and ident is not None:
            first[raw] = min(first.get(raw, ident), ident)
    out = []
    for ident, _, html in rows:
        raw = (html or "").encode()
        lead = first.get(raw)
        revisit = lead is not None and lead != ident
        out.append((None if ident is None else str(ident), len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response",
                    str(lead) if revisit else None, None if revisit else raw))
    return sorted(out, key=str)


def read(spark, path, **more):
    rows = warc.read_archives(spark, path, **more).collect()
    return sorted(((r.page, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload))
                   for r in rows), key=str)


def test_round_trip(spark, tmp_path):
    rows, df = pages(spark)
    path = str(tmp_path / "w")
    warc.write_archives(df, path)
    assert read(spark, path) == expected(rows)


def archives(path):
    return [os.path.join(path, f) for f in os.listdir(path) if f.startswith("part-")]


def test_archive_layout(spark, tmp_path):
    rows, df = pages(spark)
    path = str(tmp_path / "w")
    warc.write_archives(df, path)
    found = 0
    for f in archives(path):
        data = memoryview(open(f, "rb").read())
        magic, size = struct.unpack_from("<II", data)
        assert magic == warc.DICTIONARY_MAGIC
        plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(data[8:8 + size])))
        at = 8 + size
        while at < len(data):
            end = warc.frame_end(data, at)
            if struct.unpack_from("<I", data, at)[0] == warc.FRAME_MAGIC:
                text = plain.decompress(data[at:end])
                assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n") and b"\r\nInjected" not in text.split(b"\r\n\r\n")[0]
                found += 1
            at = end
    assert found == len(rows)


def test_damage_is_found(spark, tmp_path):
    _, df = pages(spark)
    path = str(tmp_path / "w")
    warc.write_archives(df.coalesce(1), path)
    whole = open(archives(path)[0], "rb").read()
    size = struct.unpack_from("<II", whole)[1]
    flipped = bytearray(whole)
    flipped[len(whole) // 2] ^= 1
    for bad in (whole[:-30], bytes(flipped), whole[8 + size:], b"no archive at all", whole[:-9] + b"????"):
        assert any(r["error"] for r in warc.records(memoryview(bad)))
    assert not any(r["error"] for r in warc.records(memoryview(whole)))
    broken = tmp_path / "b"
    broken.mkdir()
    (broken / "part-0").write_bytes(whole[:-30])
    with pytest.raises(Exception, match="truncated frame"):
        warc.read_archives(spark, str(broken)).collect()
    rows = warc.read_archives(spark, str(broken), strict=False).collect()
    assert sum(r.error is not None for r in rows) == 1 and len(rows) == 15


def test_record_checks():
    good = warc.record("1", "http://a", b"<p>hi", hashlib.sha256(b"<p>hi").hexdigest(), None)
    assert warc.parse_record(good)["payload"] == b"<p>hi"
    for old, new in ((b"WARC/1.1", b"HTTP/1.1"), (b"<p>hi", b"<p>ho"), (b"<p>hi", b"<p>hi!"), (b"WARC-Date: ", b"X: "),
                     (b"WARC-Type: response", b"WARC-Type: warcinfo"), (b"Content-Length: 5", b"Content-Length: 6"), (b"WARC-Type: response", b"no colon")):
        with pytest.raises((ValueError, KeyError)):
            warc.parse_record(good.replace(old, new, 1))


def test_empty_table_and_other_columns(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string, digest string, leader int")
    warc.write_archives(df, str(tmp_path / "e"))
    assert read(spark, str(tmp_path / "e")) == []
    df = spark.createDataFrame([(1, "u", "h", "d", 4)], df.schema)
    warc.write_archives(df, str(tmp_path / "c"))
    assert len(read(spark, str(tmp_path / "c"))) == 1
