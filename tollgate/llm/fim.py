"""Fill-in-the-middle transformation: whole texts, cut twice at code points, rearranged around three marks.

Most of a text's bytes need not be decoded to find its cuts. A rolling hash over ``WINDOW`` bytes cuts
texts into chunks where the content says so, hence texts that share passages share chunks. What a
chunk contributes is its summary: code points, whether it holds a mark, and the bytes at its two ends, by which
neighbours are checked for a mark that lies across their border. Summaries are kept in a cache that
finds a chunk by its hash and verifies it by its bytes (a dictionary keyed by the bytes
themselves), so a shared chunk is counted once per task. Summaries combine associatively: the running sum of
the chunks' counts gives the text's length and the chunk in which a cut falls, and only that chunk is
searched for the byte.

The text never leaves its task, nothing is shuffled. A cache of its own per task of at most ``CACHE_BYTES``
replaces one for all tasks: handing chunks out would move every text, which costs more than a count. Forgetting
a chunk costs its recount, never a result.

Where the cuts fall depends on the id alone: ``draws`` are four 32-bit numbers of the SHA-256 of ``seed:id``.
Defined results: a null text counts as the empty one, an empty text or one that holds a mark stays as it is (form
``plain``, also drawn for some of the others), and then prefix and middle are null; a null id draws by the
empty word; texts of any length are cut whole, in memory of a small multiple of the text; rows with equal ids draw
alike, each row has a result of its own; an empty table gives no rows; only the id and the text column are read.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import ship

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
EDGE = max(map(len, MARKS)) - 1        # bytes of a mark that may lie on one side of a border

SEED = "1"
PLAIN_FROM = 90                        # of 100: texts that are drawn to stay as they are
SPM_BELOW = 20                         # of 100: the suffix comes first

WINDOW = 32
AVERAGE_BITS = 10                      # a chunk has 1 KB on average
MAX_CHUNK = 1 << 14
CACHE_BYTES = 32 << 20
OUTPUT_BYTES = 16 << 20

_GEAR = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 32, 256, np.uint32)

RESULT = "id long, n long, form string, prefix_chars long, middle_chars long, output string"
_SCHEMA = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                     ("middle_chars", pa.int64()), ("output", pa.string())])


def rolling(data: bytes) -> np.ndarray:
    """At every byte a hash of the last ``WINDOW`` bytes: each byte's number, shifted by its distance."""
    h = _GEAR[np.frombuffer(data, np.uint8)]
    width = 1
    while width < WINDOW:
        more = h.copy()
        more[width:] += h[:-width] << np.uint32(width)
        h, width = more, 2 * width
    return h


def chunks(data: bytes) -> list[bytes]:
    """``data`` in content-defined chunks of ``MAX_CHUNK`` bytes at most."""
    if len(data) <= WINDOW:
        return [data] if data else []
    ends = np.flatnonzero(rolling(data) >> np.uint32(32 - AVERAGE_BITS) == 0) + 1
    ends = ends[(ends >= WINDOW) & (ends < len(data))].tolist() + [len(data)]
    found, start = [], 0
    for end in ends:
        while end - start > MAX_CHUNK:
            found.append(data[start:start + MAX_CHUNK])
            start += MAX_CHUNK
        found.append(data[start:end])
        start = end
    return found


def summary(chunk: bytes) -> tuple[int, bool, bytes, bytes]:
    """(code points, holds a mark, first bytes, last bytes): all that a chunk contributes."""
    raw = np.frombuffer(chunk, np.uint8)
    return int(np.count_nonzero(raw & 0xC0 != 0x80)), any(m in chunk for m in MARKS), chunk[:EDGE], chunk[-EDGE:]


EMPTY = (0, False, b"", b"")


def combine(a: tuple, b: tuple) -> tuple:
    """Summary of two neighbours together; associative, with ``EMPTY`` as its unit."""
    if not a[2] or not b[2]:
        return b if not a[2] else a
    seam = a[3] + b[2]
    head = a[2] if len(a[2]) == EDGE else (a[2] + b[2])[:EDGE]
    tail = b[3] if len(b[3]) == EDGE else (a[3] + b[3])[-EDGE:]
    return a[0] + b[0], a[1] or b[1] or any(m in seam for m in MARKS), head, tail


class Cache:
    """Summaries of the chunks seen, verified by content, in bounded memory; the oldest go first."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.known: dict[bytes, tuple] = {}
        self.limit, self.held, self.hits = limit, 0, 0

    def summary(self, chunk: bytes) -> tuple:
        have = self.known.get(chunk)           # looked up by hash, accepted by equal bytes
        if have is not None:
            self.hits += 1
            return have
        self.known[chunk] = have = summary(chunk)
        self.held += len(chunk) + 200
        while self.held > self.limit and len(self.known) > 1:
            oldest = next(iter(self.known))
            del self.known[oldest]
            self.held -= len(oldest) + 200
        return have


def byte_of(chunk: bytes, code_point: int, count: int) -> int:
    """Where in ``chunk`` (of ``count`` code points) the numbered code point begins."""
    if count == len(chunk):
        return code_point
    raw = np.frombuffer(chunk, np.uint8)
    return int(np.flatnonzero(raw & 0xC0 != 0x80)[code_point])


class Text:
    """A text as the chunks it consists of."""

    def __init__(self, data: bytes, cache: Cache):
        self.data, self.parts = data, chunks(data)
        each = [cache.summary(c) for c in self.parts]
        whole = EMPTY
        for s in each:
            whole = combine(whole, s)
        self.n, self.marked = whole[0], whole[1]
        self.counts = [s[0] for s in each]
        self.before = [0, *accumulate(self.counts)]
        self.offsets = [0, *accumulate(map(len, self.parts))]

    def byte_at(self, code_point: int) -> int:
        """The byte at which a code point begins: its chunk by the running counts, its place by search."""
        if code_point >= self.n:
            return len(self.data)
        k = bisect_right(self.before, code_point) - 1
        return self.offsets[k] + byte_of(self.parts[k], code_point - self.before[k], self.counts[k])


def rearranged(data: bytes, h: list[int], cache: Cache) -> tuple:
    """(code points, form, prefix, middle, output) of one text and its four draws."""
    t = Text(data, cache)
    if not t.n or t.marked or h[2] % 100 >= PLAIN_FROM:
        return t.n, "plain", None, None, data
    first, second = sorted((h[0] % (t.n + 1), h[1] % (t.n + 1)))
    a, b = t.byte_at(first), t.byte_at(second)
    p, s, m = MARKS
    if h[3] % 100 < SPM_BELOW:
        return t.n, "spm", first, second - first, b"".join((s, data[b:], p, data[:a], m, data[a:b]))
    return t.n, "psm", first, second - first, b"".join((p, data[:a], s, data[b:], m, data[a:b]))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def _transform(batches):
    cache = Cache()
    for batch in batches:
        rows, size = [], 0
        ids, draws = batch.column(0).to_pylist(), zip(*[batch.column(k).to_pylist() for k in range(2, 6)])
        for doc_id, text, h in zip(ids, batch.column(1), draws):
            data = text.as_buffer()
            rows.append((doc_id, *rearranged(bytes(data) if data else b"", h, cache)))
            size += len(rows[-1][-1])
            if size > OUTPUT_BYTES:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)


def draws(doc_id: Column, seed: str = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED) -> DataFrame:
    """``<id_col>, n, form, prefix_chars, middle_chars, output`` of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
                       *draws(F.col(id_col), seed))
    return rows.mapInArrow(_transform, RESULT).withColumnRenamed("id", id_col)


def restored(output: Column, form: Column) -> Column:
    """The original text, from what ``transform`` made of it alone."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)      # a marked text is plain: there are three marks
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))


ship(__name__)
