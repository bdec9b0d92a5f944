"""WARC records in ZIP packages: written once, read by byte range without extraction.

A package is a ZIP whose members are *stored* (not deflated): ``archive/data.warc.gz`` (one gzip
member per record) and ``indexes/index.cdxj`` (one JSON line per record with its offset and
length). Because members are stored, a record's place in the package is the member's data
offset plus the index offset, so a reader seeks to the end of the file, parses the end record,
the ZIP64 records and the central directory, reads the index and then fetches exactly the byte
ranges it wants.

Defined results: a null payload is an empty one; a null id gives a record without an id (read
back as null); records below ``REVISIT_MIN_BYTES`` are always responses; every copy of the row
with the largest id of its group is a response; a group whose ids are all null has no record to
refer to and stays responses; of records with equal payloads and ids the tie changes nothing, as all of them are
responses; a payload of any length is one record, written and read whole; an empty table writes no package and reads
back no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm.common import dealt_anew, ship

REVISIT_MIN_BYTES = 1000      # smaller payloads are repeated, not referred to
ROLL_BYTES = 256 << 20        # a package is closed and a new one begun beyond this size
RANGE_BYTES = 4 << 20         # neighbouring records are fetched in ranges of about this size
CRAWL_DATE = "2024-01-01T00:00:00Z"

MANIFEST = "path string, records long, bytes long"
RANGES = "path string, start long, offsets array<long>, lengths array<long>"
RECORDS = ("id long, url string, record_type string, payload_bytes long, payload_digest string, "
           "refers_to long, payload binary, path string, offset long, length long")


# ---- which record answers, which refers back -----------------------------------------------

def plan_records(pages: DataFrame, id_col: str, url_col: str, payload: Column) -> DataFrame:
    """id, url, payload, payload_bytes, payload_digest, record_type, refers_to per input row.

    Groups of equal payloads are reduced to one row each before the join (map-side max), so
    a payload shared by a third of all rows only makes a skewed join partition, which adaptive
    execution splits.
    """
    empty = F.lit("").cast("binary")
    recs = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(payload.cast("binary"), empty).alias("payload"))
    recs = recs.withColumns({"payload_digest": F.sha1("payload"),
                             "payload_bytes": F.octet_length("payload").cast("long")})
    keepers = (recs.filter(F.col("payload_bytes") >= REVISIT_MIN_BYTES)
               .groupBy(F.col("payload_digest").alias("digest"))
               .agg(F.max("id").alias("keeper"), F.count(F.lit(1)).alias("n"))
               .filter("n > 1 and keeper is not null").select("digest", "keeper"))
    refers = F.when(~F.col("id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    return (recs.join(dealt_anew(keepers), F.col("payload_digest") == F.col("digest"), "left")
            .withColumn("refers_to", refers)
            .withColumn("record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))
            .select("id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"))


# ---- writing ---------------------------------------------------------------------------------

def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _from_urn(value: str | None):
    number = (value or "").removeprefix("<urn:page:").rstrip(">")
    return int(number) if number else None


def _one_line(value: str) -> str:
    """Header values hold no line breaks: they are percent-encoded."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _from_one_line(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def encode_record(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC/1.1 record as a gzip member; a revisit keeps the HTTP head, not the payload."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http + payload if kind == "response" else http
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {CRAWL_DATE}",
            "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
            f"Content-Length: {len(block)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_one_line(url)}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: {_urn(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


class PackageWriter:
    """Streams records into one package; the index is held until the package is closed."""

    def __init__(self, folder: str):
        self.path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.wacz"
        store, where = fs.FileSystem.from_uri(self.path)
        store.create_dir(where.rpartition("/")[0], recursive=True)
        self.raw = store.open_output_stream(where)
        self.zip = zipfile.ZipFile(self.raw, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open("archive/data.warc.gz", "w", force_zip64=True)
        self.lines, self.bytes = [], 0

    def add(self, record: bytes, url, kind: str) -> None:
        self.member.write(record)
        self.lines.append(json.dumps({"url": url, "type": kind, "offset": self.bytes, "length": len(record)}))
        self.bytes += len(record)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr("indexes/index.cdxj", "\n".join(self.lines))
        self.zip.writestr("datapackage.json", json.dumps(
            {"profile": "data-package", "records": len(self.lines), "bytes": self.bytes}))
        self.zip.close()
        self.raw.close()
        return self.path, len(self.lines), self.bytes


def write_packages(records: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Manifest (path, records, bytes) of the packages written below ``folder``.

    Each task attempt writes files of its own name. The manifest, committed by Spark, lists only
    those of successful attempts, so a file left by a lost executor is never read.
    """
    def write(batches):
        out, done = None, []
        for batch in batches:
            cols = [batch.column(c) for c in ("id", "url", "payload", "payload_digest", "record_type", "refers_to")]
            for i in range(batch.num_rows):
                page_id, url, payload, digest, kind, refers_to = (c[i].as_py() for c in cols)
                out = out or PackageWriter(folder)
                out.add(encode_record(page_id, url, payload, digest, kind, refers_to), url, kind)
                if out.bytes >= roll_bytes:
                    done.append(out.close())
                    out = None
        if out:
            done.append(out.close())
        yield pa.RecordBatch.from_pydict(
            {n: [d[k] for d in done] for k, n in enumerate(("path", "records", "bytes"))},
            pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return records.mapInArrow(write, MANIFEST)


# ---- the ZIP directory -------------------------------------------------------------------------

def _end_of_directory(read, size: int) -> tuple[int, int]:
    """(offset, length) of the central directory, from the end record or its ZIP64 form."""
    tail_at = max(0, size - 65557)                      # 22 bytes and a comment of up to 65535
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("no end-of-central-directory record: not a ZIP package")
    length, offset = struct.unpack_from("<II", tail, at + 12)
    count = struct.unpack_from("<H", tail, at + 10)[0]
    locator = read(tail_at + at - 20, 20) if tail_at + at >= 20 else b""
    if locator[:4] == b"PK\x06\x07" and (0xFFFFFFFF in (length, offset) or count == 0xFFFF):
        end64 = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if end64[:4] != b"PK\x06\x06":
            raise ValueError("broken ZIP64 end record")
        length, offset = struct.unpack_from("<QQ", end64, 40)
    return offset, length


def zip_members(read, size: int) -> list[dict]:
    """name, method, size, packed, header (offset of the local header) per central entry.

    ``read(offset, n)`` returns bytes of the package: only the directory is fetched.
    """
    offset, length = _end_of_directory(read, size)
    directory, at, found = read(offset, length), 0, []
    while at + 46 <= len(directory) and directory[at:at + 4] == b"PK\x01\x02":
        method = struct.unpack_from("<H", directory, at + 10)[0]
        packed, full = struct.unpack_from("<II", directory, at + 20)
        n_name, n_extra, n_comment = struct.unpack_from("<HHH", directory, at + 28)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46:at + 46 + n_name].decode("utf-8", "replace")
        extra = directory[at + 46 + n_name:at + 46 + n_name + n_extra]
        k = 0
        while k + 4 <= len(extra):
            tag, n = struct.unpack_from("<HH", extra, k)
            if tag == 1:                                 # ZIP64: only the fields that overflowed, in this order
                field = io.BytesIO(extra[k + 4:k + 4 + n])
                if full == 0xFFFFFFFF:
                    full = struct.unpack("<Q", field.read(8))[0]
                if packed == 0xFFFFFFFF:
                    packed = struct.unpack("<Q", field.read(8))[0]
                if header == 0xFFFFFFFF:
                    header = struct.unpack("<Q", field.read(8))[0]
            k += 4 + n
        found.append({"name": name, "method": method, "packed": packed, "size": full, "header": header})
        at += 46 + n_name + n_extra + n_comment
    return found


def data_offset(read, member: dict) -> int:
    """Where a stored member's bytes begin (the local header has name and extra of its own)."""
    head = read(member["header"], 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("broken local header")
    return member["header"] + 30 + sum(struct.unpack_from("<HH", head, 26))


def open_range(path: str):
    """(read(offset, n), size) of a file in any store Arrow knows."""
    store, where = fs.FileSystem.from_uri(path)
    f = store.open_input_file(where)

    def read(offset: int, n: int) -> bytes:
        f.seek(offset)
        return f.read(n)

    return read, f.size()


# ---- reading -------------------------------------------------------------------------------------

def record_ranges(packages: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Byte ranges of neighbouring records, from each package's directory and stored index."""
    def ranges(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                read, size = open_range(path)
                members = {m["name"]: m for m in zip_members(read, size) if m["method"] == 0}
                rows, run = [], []
                for name in sorted(n for n in members if n.startswith("indexes/") and n.endswith(".cdxj")):
                    warc = members["archive/data.warc.gz"]
                    base = data_offset(read, warc)
                    lines = read(data_offset(read, members[name]), members[name]["size"]).decode().splitlines()
                    for line in map(json.loads, lines):
                        run.append((base + line["offset"], line["length"]))
                        if run[-1][0] + run[-1][1] - run[0][0] >= range_bytes:
                            rows.append(run)
                            run = []
                    if run:
                        rows.append(run)
                        run = []
                yield pa.RecordBatch.from_pydict(
                    {"path": [path] * len(rows), "start": [r[0][0] for r in rows],
                     "offsets": [[o for o, _ in r] for r in rows], "lengths": [[n for _, n in r] for r in rows]},
                    pa.schema([("path", pa.string()), ("start", pa.int64()),
                               ("offsets", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))]))

    return packages.select("path").mapInArrow(ranges, RANGES)


def decode_record(packed: bytes) -> dict:
    """Fields of one record; a response's payload is checked against its digest."""
    head, _, block = zlib.decompress(packed, 31).partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, rest = block[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    n = next(int(x[15:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    response = fields["WARC-Type"] == "response"
    if response and (len(rest) != n or hashlib.sha1(rest).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    uri = fields.get("WARC-Target-URI")
    return {"id": _from_urn(fields["WARC-Record-ID"]), "url": None if uri is None else _from_one_line(uri),
            "record_type": fields["WARC-Type"], "payload_bytes": n, "payload_digest": digest,
            "refers_to": _from_urn(fields.get("WARC-Refers-To")), "payload": rest if response else None}


def read_records(ranges: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the given byte ranges; ``payload`` is null for revisits or if not asked for."""
    schema = pa.schema([("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                        ("payload", pa.binary()), ("path", pa.string()), ("offset", pa.int64()),
                        ("length", pa.int64())])

    def records(batches):
        for batch in batches:
            for row in batch.to_pylist():
                read, _ = open_range(row["path"])
                data, rows = read(row["start"], row["offsets"][-1] + row["lengths"][-1] - row["start"]), []
                for offset, length in zip(row["offsets"], row["lengths"], strict=True):
                    at = offset - row["start"]
                    rec = decode_record(data[at:at + length]) | {"path": row["path"], "offset": offset, "length": length}
                    rows.append(rec if with_payload else rec | {"payload": None})
                yield pa.RecordBatch.from_pylist(rows, schema)

    return ranges.mapInArrow(records, RECORDS)


def read_packages(packages: DataFrame, with_payload: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the packages listed in ``packages`` (a column ``path``).

    The ranges are dealt out anew, so one large package is read by many tasks.
    """
    ranges = record_ranges(packages, range_bytes)
    parts = packages.sparkSession.sparkContext.defaultParallelism * 4
    return read_records(ranges.repartition(parts, "path", "start"), with_payload)


def pages_round_trip(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    """Write one record per page, then the records as read back from the packages."""
    from tollgate.llm.common import write_table

    manifest = write_table(write_packages(plan_records(pages, "page_id", "url", F.col("html")), folder), "warc-manifest")
    return read_packages(manifest, with_payload=False)


ship(__name__)
