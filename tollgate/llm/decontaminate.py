"""Benchmark decontamination: occurrences of test items within an edit budget.

Texts and items are compared in lower case with white space runs as single spaces. An item of n
characters may be changed by ``ERROR_RATE * n`` edits (rounded down), whatever its length. Cut into
one piece more than that (of 6 to 10 characters), at least one piece stays intact in any such occurrence, so all pieces of
all items are searched exactly (one automaton over the whole text), and around each hit Myers'
bit-parallel distance decides. No occurrence within the budget can be missed. Short pieces hit
often by chance, so the pieces of an item are halved into a binary tree: if j neighbouring pieces hold
at most j - 1 edits, so does one of the halves, with its own number of pieces. From some intact piece up
all nodes are thus within their budgets, and a hit ends at the first node that is not.

An item shorter than ``MIN_ITEM`` characters occurs where it stands unchanged, as whole words.

Items are a stated query set: they are taken in blocks of ``BLOCK_CHARS`` characters, one after the other. A block
goes to the tasks and passes over all documents, and what it finds (or leaves) is written before the next one
is read, so the driver and a task hold one block at a time, whatever their number.

Defined results: null and empty items are ignored; null and empty texts contain nothing; texts of any
length are searched whole; repeated items and rows are reported each, of equally near occurrences the first; an empty
benchmark leaves all documents, an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import ship, write_table

ERROR_RATE = 0.1
MIN_ITEM = 20
BLOCK_CHARS = 4 << 20


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def budget(n: int, error_rate: float = ERROR_RATE) -> int:
    return int(error_rate * n) if n >= MIN_ITEM else 0


def stands_alone(text: str, start: int, end: int) -> bool:
    """Whether ``text[start:end]`` begins and ends where words do."""
    return not ((start > 0 and text[start - 1].isalnum() and text[start].isalnum())
                or (end < len(text) and text[end - 1].isalnum() and text[end].isalnum()))


def letters(pattern: str) -> dict[str, int]:
    """For each character the bit set of its places in the pattern."""
    places: dict[str, int] = defaultdict(int)
    for k, c in enumerate(pattern):
        places[c] |= 1 << k
    return dict(places)


def least_distance(places: dict[str, int], m: int, text: str, limit: int) -> tuple[int, int]:
    """(distance, end) of the best occurrence of an m-character pattern in ``text``.

    Myers' bit-parallel column update; distances above ``limit`` are returned as limit + 1.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m                          # vertical +1 and -1 steps of the column
    best, end = limit + 1, 0
    for at, c in enumerate(text, 1):
        eq = places.get(c, 0)
        x = eq | down
        d = (((eq & up) + up) ^ up) | eq
        plus, minus = down | (full & ~(d | up)), up & d
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        if score < best:
            best, end = score, at
        plus, minus = plus << 1, minus << 1
        up, down = (minus | ~(x | plus)) & full, plus & x
    return best, end


def nodes_above(piece: int, pieces: int) -> list[tuple[int, int]]:
    """The nodes (first, last + 1 piece) over a piece, the smallest first; without the root."""
    lo, hi, path = 0, pieces, []
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if piece < mid else (mid, hi)
        path.append((lo, hi))
    return path[-2::-1]


class ItemIndex:
    """Automaton over the pieces of a block of items."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.items, pieces = [], defaultdict(list)
        self.letters, self.nodes_above = lru_cache(1 << 14)(letters), lru_cache(1 << 14)(nodes_above)
        for item_id, text in items:
            n, k = len(text), len(self.items)
            edits = budget(n, error_rate)
            for j in range(edits + 1):
                at = j * n // (edits + 1)
                pieces[text[at:(j + 1) * n // (edits + 1)]].append((k, at, j))
            self.items.append((item_id, text, edits, letters(text)))
        self.automaton = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.automaton.add_word(piece, (len(piece), where))
        if self.items:
            self.automaton.make_automaton()

    def may_begin(self, k: int, piece: int, text: str, start: int) -> bool:
        """Whether the nodes over an intact piece are within their budgets, the item beginning about ``start``."""
        _, item, edits, _ = self.items[k]
        n = len(item)
        for lo, hi in self.nodes_above(piece, edits + 1):
            a, b, most = lo * n // (edits + 1), hi * n // (edits + 1), hi - lo - 1
            around = text[max(0, start + a - most):max(0, start + b + most)]
            if least_distance(self.letters(item[a:b]), b - a, around, most)[0] > most:
                return False
        return True

    def find(self, text: str):
        """(item id, distance, end in the normal text) for every item that occurs in ``text``."""
        if not self.items or not text:
            return
        near = defaultdict(list)                          # item -> where an occurrence would lie
        for last, (size, where) in self.automaton.iter(text):
            for k, at, piece in where:
                _, item, edits, _ = self.items[k]
                start = last + 1 - size - at
                if len(item) < MIN_ITEM and not stands_alone(text, start, last + 1):
                    continue
                if not self.may_begin(k, piece, text, start):
                    continue
                near[k].append((max(0, start - edits), min(len(text), start + len(item) + edits)))
        for k, spans in near.items():
            item_id, item, edits, places = self.items[k]
            best = (edits + 1, 0)
            spans.sort()
            lo, hi = spans[0]
            for a, b in [*spans[1:], (len(text) + 1, 0)]:
                if a <= hi:                               # hits that overlap are searched as one
                    hi = max(hi, b)
                    continue
                exact = text.find(item, lo, hi)
                d, end = (0, exact - lo + len(item)) if exact >= 0 else least_distance(places, len(item), text[lo:hi], edits)
                best = min(best, (d, lo + end))
                if not best[0]:
                    break
                lo, hi = a, b
            if best[0] <= edits:
                yield item_id, *best


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_chars: int) -> tuple[int, Iterator[list[tuple[int, str]]]]:
    """Number of blocks, and the blocks one by one: lists of (item id, normal text) of about ``block_chars`` characters."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")) \
        .filter("text is not null")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // block_chars))

    def block(b: int) -> list[tuple[int, str]]:
        part = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b).collect() if chars else []
        return sorted([(r.id, t) for r in part if (t := normal(r.text))], key=lambda x: (x[0] is None, x))
    return n, (items for items in map(block, range(n)) if items)


def find_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", error_rate: float = ERROR_RATE,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, end) for every item that occurs in a document.

    ``distance`` is the least number of edits; ``end`` is where the first such occurrence ends
    in the normal text.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("end", pa.int64())])

    def search(items):
        def run(batches):
            index = ItemIndex(items, error_rate)
            for batch in batches:
                rows = [(doc, *hit) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1))
                        if text.is_valid for hit in index.find(normal(text.as_py()))]
                yield pa.RecordBatch.from_pydict({n: [r[k] for r in rows] for k, n in enumerate(schema.names)}, schema)
        return run

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = "doc_id long, item_id long, distance int, end long"
    n, blocks = item_blocks(benchmark, item_id, item_text, block_chars)
    found = []
    for items in blocks:
        block = texts.mapInArrow(search(items), kind)
        found.append(block if n == 1 else write_table(block, "found-items"))
    return reduce(DataFrame.union, found) if found else docs.sparkSession.createDataFrame([], kind)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
                      item_text: str = "text", error_rate: float = ERROR_RATE,
                      block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that contain no item, as they came; without a shuffle. Several blocks write what each one leaves."""
    place = [c.lower() for c in docs.columns].index(text_col.lower())

    def keep(items):
        def run(batches):
            index = ItemIndex(items, error_rate)
            for batch in batches:
                clean = [not text.is_valid or next(index.find(normal(text.as_py())), None) is None
                         for text in batch.column(place)]
                yield batch.filter(pa.array(clean, pa.bool_()))
        return run

    n, blocks = item_blocks(benchmark, item_id, item_text, block_chars)
    for items in blocks:
        left = docs.mapInArrow(keep(items), docs.schema)
        docs = left if n == 1 else write_table(left, "uncontaminated")
    return docs


ship(__name__)
