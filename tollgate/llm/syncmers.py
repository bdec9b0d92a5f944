"""Document fingerprints from closed syncmers.

A ``K``-byte substring is an anchor (closed syncmer) if the least hash among its ``S``-byte
substrings lies at its first or last place. Whether it is one depends on its own bytes only, so
an edit moves no anchors outside the edited bytes: the anchors of an edited text are those of the
kept part, plus those of the new part and the seam.

The fingerprint keeps, for each of ``SLOTS`` ranges of anchor hashes, the least anchor: 16 bits of
its hash and its place in units of 16 bytes, as 12 hexadecimal digits (``ffffffffffff`` for a range
without an anchor). The likeness of two fingerprints is the share of text they have in common as
estimated from the slots whose anchors agree in hash and belong together: what is inserted or cut
out moves all that follows by the same offset, so an anchor counts if it has not moved or if
another one has moved as far, both up to ``DRIFT`` units.

Defined results: null and empty texts have no anchors and are alike to each other only
(likeness 1, else 0); any other text without a closed syncmer is its own anchor; equal texts have equal
fingerprints; in the order of documents null ids come first, equal ids are ordered by their
texts' hashes, and a single document is its own next one; texts of any length are read whole; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import ship, write_table
from tollgate.llm.rolling import mix

K, S = 16, 8              # S-mers are read as 64-bit numbers, two of which make up a K-mer
SLOTS = 64
UNIT = 16
DRIFT = 4
EMPTY = 0xFFFFFFFFFFFF

EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def syncmers(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the closed syncmers of ``data``."""
    if len(data) < K:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inner = np.ndarray(len(data) - S + 1, "<u8", data, strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
    inner ^= inner >> np.uint64(32)
    width = K - S + 1
    two = np.minimum(inner[:-1], inner[1:])
    four = np.minimum(two[:-2], two[2:])
    eight = np.minimum(four[:-4], four[4:])
    least = np.minimum(eight[:len(inner) - width + 1], inner[width - 1:])
    at = np.flatnonzero((inner[:len(least)] == least) | (inner[width - 1:] == least))
    return at, mix(mix(inner[at]) + inner[at + width - 1])


def or_whole(data: bytes, places: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of ``data``: its closed syncmers or, without any, the whole text."""
    if len(places) or not data:
        return places, hashes
    whole = np.frombuffer(hashlib.blake2b(data, digest_size=8).digest(), "<u8")
    return np.zeros(1, np.int64), whole.astype(np.uint64)


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchors of ``data``."""
    return or_whole(data, *syncmers(data))


def sketch(places: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The slots as 48-bit numbers: hash above, place below (32 bits: a text has at most 2 GB)."""
    slots = np.full(SLOTS, EMPTY, np.uint64)
    if len(hashes):
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        slot = (ranked >> np.uint64(64 - 6)).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(slot[1:] != slot[:-1]) + 1))
        place = (places[order[first]] // UNIT).astype(np.uint64)
        slots[slot[first]] = (ranked[first] & np.uint64(0xFFFF)) << np.uint64(32) | place
    return slots


def digits(slots: np.ndarray) -> str:
    return slots.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of text in common, 0 to 1 (Dice's measure from the slots' Jaccard estimate)."""
    has_a, has_b = a != EMPTY, b != EMPTY
    union = int((has_a | has_b).sum())
    if not union:
        return 1.0
    equal = has_a & has_b & (a >> np.uint64(32) == b >> np.uint64(32))
    place = np.uint64(0xFFFFFFFF)
    moved = np.sort((a[equal] & place).astype(np.int64) - (b[equal] & place).astype(np.int64))
    close = np.diff(moved) <= DRIFT
    together = (np.abs(moved) <= DRIFT) | np.append(close, False) | np.append(False, close)
    same = int(together[:len(moved)].sum())
    return 2 * same / (union + same)


def slots_of(fingerprint: str) -> np.ndarray:
    own = np.frombuffer(bytes.fromhex(fingerprint), np.uint8).reshape(-1, 6)
    return np.pad(own, ((0, 0), (2, 0))).view(">u8")[:, 0].astype(np.uint64)


def edited(text: str, following: str) -> tuple[str, int]:
    """The text with its last quarter replaced, and the length of what is kept."""
    cut = len(text) // 4
    kept = len(text) - cut
    return text[:kept] + following[:cut], kept


class Document:
    """One text with its anchors and slots."""

    def __init__(self, doc_id, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        self.data = self.text.encode()
        self.places, self.hashes = syncmers(self.data)
        self.slots = sketch(*or_whole(self.data, self.places, self.hashes))

    def edited_slots(self, new: str, kept: int) -> tuple[bytes, np.ndarray]:
        """Bytes and slots of the edited text; anchors of the kept part are not computed again."""
        data = new.encode()
        n = len(self.text[:kept].encode())
        if n < K:
            return data, sketch(*anchors(data))
        own = self.places <= n - K
        places, hashes = syncmers(data[n - K + 1:])
        return data, sketch(*or_whole(data, np.concatenate((self.places[own], places + n - K + 1)),
                                      np.concatenate((self.hashes[own], hashes))))

    def compare(self, following: Document) -> dict:
        new, kept = edited(self.text, following.text)
        data, slots = self.edited_slots(new, kept)
        return {"doc_id": self.doc_id, "n_chars": len(self.text), "edited_sha256": hashlib.sha256(data).hexdigest(),
                "fingerprint": digits(self.slots), "edited_fingerprint": digits(slots),
                "near_edited": likeness(self.slots, slots), "near_next": likeness(self.slots, following.slots)}


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                     ("near_edited", pa.float64()), ("near_next", pa.float64())])
_ORDERED = pa.schema([("part", pa.int32()), ("edge", pa.string()), ("text", pa.string()), *_RESULT])


def _along_partition(batches):
    """Compare each row of an ordered partition to the next; pass on its first and last document."""
    part, before = TaskContext.get().partitionId(), None
    edge = lambda which, d: {"part": part, "edge": which, "doc_id": d.doc_id, "text": d.text}
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            doc = Document(doc_id.as_py(), text.as_py())
            rows.append(before.compare(doc) if before else edge("first", doc))
            before = doc
        yield pa.RecordBatch.from_pylist(rows, _ORDERED)
    if before:
        yield pa.RecordBatch.from_pylist([edge("last", before)], _ORDERED)


def _pairs(batches):
    for batch in batches:
        rows = [Document(r["doc_id"], r["text"]).compare(Document(None, r["next_text"])) for r in batch.to_pylist()]
        yield pa.RecordBatch.from_pylist(rows, _RESULT)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness, in one shuffle of the texts.

    Texts are dealt out in ranges of ids and sorted there, so a document's next one is the next
    row of its partition. Only the first and last document of each partition meet in a join.
    """
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text")))
    found = write_table(rows.mapInArrow(_along_partition, f"part int, edge string, text string, {EDITED}"), "ordered")
    first = found.filter("edge = 'first'").select("part", F.col("text").alias("next_text"))
    by_part = Window.orderBy("part")                       # one row per partition
    follows = first.select("part").select(
        "part", F.coalesce(F.lead("part").over(by_part),
                           F.min("part").over(by_part.rowsBetween(Window.unboundedPreceding, 0))).alias("next_part"))
    seams = (found.filter("edge = 'last'").select("part", "doc_id", "text").join(follows, "part")
             .join(first.withColumnRenamed("part", "next_part"), "next_part")
             .select("doc_id", "text", "next_text").mapInArrow(_pairs, EDITED))
    return found.filter("edge is null").select(*[f.name for f in _RESULT]).union(seams)


ship(__name__)
