"""WARC packages: exact round trip, revisits, ZIP64, edge rows."""

import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tollgate.llm import warc
from tollgate.llm.common import new_path

PAGES = "page_id long, url string, html string, id string, path string"


def trip(spark, rows, **how):
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)
    folder = new_path(spark, "warc-test")
    manifest = warc.write_packages(warc.plan_records(pages, "page_id", "url", F.col("html")), folder, **how)
    manifest = spark.createDataFrame(manifest.collect(), warc.MANIFEST)
    return manifest, warc.read_packages(manifest, range_bytes=500)


def brute(rows):
    """page -> (bytes, digest, type, refers_to) by the contract's words."""
    out = []
    for pid, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        best = max(same, default=None)
        revisit = len(data) >= 1000 and best is not None and pid != best
        out.append((pid, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", best if revisit else None))
    return sorted(out, key=repr)


def test_round_trip_with_copies_nulls_and_ties(spark):
    big, edge, less = "é" * 600, "a" * 1000, "a" * 999
    rows = [(1, "http://a/1", big), (9, "http://a/9", big), (5, None, big), (2, "u\r\nX: y%0A", edge), (3, "u", edge),
            (4, "u", less), (6, "u", less), (7, "u", None), (8, "u", ""), (None, "u", big), (10, "u", "x" * 200_000),
            (11, "u", "line\r\n\r\nHTTP/1.1 200\r\n\r\n" * 60), (11, "u", "line\r\n\r\nHTTP/1.1 200\r\n\r\n" * 60)]
    manifest, got = trip(spark, rows, roll_bytes=2000)
    assert sum(r.records for r in manifest.collect()) == len(rows) and manifest.count() > 1
    cols = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    found = got.collect()
    assert sorted((tuple(r[c] for c in cols) for r in found), key=repr) == brute(rows)
    urls = {r.id: r.url for r in found}
    assert urls[2] == "u\r\nX: y%0A" and urls[5] is None
    for r in found:
        assert (r.payload is None) == (r.record_type == "revisit")
        assert r.payload is None or hashlib.sha1(r.payload).hexdigest() == r.payload_digest


def test_empty_table(spark):
    manifest, got = trip(spark, [])
    assert manifest.count() == 0 and got.count() == 0


def test_directory_with_zip64_records_and_comment(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)          # every size and offset overflows
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_STORED) as z:
        z.writestr("archive/data.warc.gz", b"w" * 100)
        z.writestr("indexes/index.cdxj", b"i" * 50)
        z.writestr("packed.txt", b"p" * 500, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05 a comment"
    raw = data.getvalue()
    assert b"PK\x06\x06" in raw and b"PK\x06\x07" in raw
    read = lambda at, n: raw[at:at + n]
    found = {m["name"]: m for m in warc.zip_members(read, len(raw))}
    assert [(m["method"], m["size"]) for m in found.values()] == [(0, 100), (0, 50), (8, 500)]
    for name, byte in (("archive/data.warc.gz", b"w"), ("indexes/index.cdxj", b"i")):
        at = warc.data_offset(read, found[name])
        assert read(at, found[name]["size"]) == byte * found[name]["size"]
    with pytest.raises(ValueError):
        warc.zip_members(lambda at, n: b"x" * n, 100)
