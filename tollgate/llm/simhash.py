"""SimHash near-duplicates: 64-bit fingerprints linked by anchors of a covering code.

A fingerprint is cut into two halves of 32 bits. Two fingerprints that differ in at most
``max_bits`` bits agree up to ``t = max_bits // 2`` bits in one of the halves. Each half is
covered by the Hamming code of length 31 (covering radius 1) beside one free bit: every half
has a *home* anchor within 1 bit, and if two halves differ in at most ``t`` bits, the home of
the one lies within ``1 + t`` bits of the other. So every fingerprint is replicated to all
anchors within ``1 + t`` bits (17 a half for t = 1) and compared, per anchor, with those at home
there; no pair within ``max_bits`` can be missed.

Equal fingerprints are one fingerprint with many documents throughout, so a group of copies of
any size costs one row. Anchors that are home to many different fingerprints are compared in
blocks which return a spanning forest instead of all pairs; blocks are sized by the anchor's home fingerprints, with 17
replicated ones reckoned for each of them (the mean over all anchors, not counted anchor by anchor).

Defined results: a null or empty text, or one of white space only, has fingerprint zero and is
linked like any other; with fewer words than a shingle the whole sequence is the shingle; rows
with a null id take part, and a component whose ids are all null has a null id; repeated rows
share a fingerprint; texts of any length are read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import dealt_anew, doc_key, ship, write_table
from tollgate.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
HOME_LIMIT = 64        # an anchor with more fingerprints at home is compared in blocks
BLOCK_ROWS = 2048      # fingerprints of one side of a block


# ---- fingerprints ----------------------------------------------------------------------------

def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the whole text: bit set where over half the shingle hashes have it."""
    words = (text or b"").lower().split()                 # bytes: only A-Z are lower-cased
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    digest, ones, step = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 1 << 15
    for at in range(0, n, step):
        part = words[at:at + min(step, n - at) + shingle_words - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(shingle_words)))) if len(words) >= shingle_words else [b" ".join(words)]
        hashes = np.fromiter((digest(s, SEED) for s in shingles), "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, key_text, fp) for every row; ``fp`` is the 64-bit fingerprint as a long."""
    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            fps = [fingerprint(t.as_py(), shingle_words) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps, pa.int64())],
                                             ["doc_id", "key_text", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       doc_key(id_col, text_col)[1])
    return rows.mapInArrow(run, "doc_id long, key_text long, fp long")


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# ---- anchors -----------------------------------------------------------------------------------

def anchor_patterns(bits: int) -> list[list[int]]:
    """By syndrome: the bit patterns that lead from a half to the anchors within 1 + ``bits``.

    Bits 0..30 are the Hamming code's places 1..31 and bit 31 is the free bit, whose change
    costs one of the ``bits``. The first pattern of each list leads home.
    """
    found: list[list[int]] = [[] for _ in range(32)]
    for weight in range(bits + 2):
        for places in combinations(range(1, 32), weight):
            syndrome = 0
            for p in places:
                syndrome ^= p
            found[syndrome].append(sum(1 << (p - 1) for p in places))
    with_free = [[e | 1 << 31 for e in row if e.bit_count() <= bits] for row in found]
    return [a + (b if bits else []) for a, b in zip(found, with_free)]


def _anchors(fp: Column, half: int, patterns: list[list[int]]) -> Column:
    """Array of the anchors of one half, the home anchor first, told apart by the half's number."""
    value = F.shiftrightunsigned(fp, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
    syndrome = F.lit(0)
    for b in range(5):
        mask = sum(1 << (p - 1) for p in range(1, 32) if p >> b & 1)
        syndrome = syndrome + (F.bit_count(value.bitwiseAND(F.lit(mask))) % 2) * (1 << b)
    table = F.array(*[F.array(*[F.lit(e).cast("long") for e in row]) for row in patterns])
    return F.transform(F.element_at(table, syndrome + 1),
                       lambda e: value.bitwiseXOR(e).bitwiseOR(F.lit(half << 32)))


def _block_forest(max_bits: int):
    """Spanning forest of the links between those at home and all members of one block."""
    def run(rows):
        import pandas as pd

        members = np.unique(rows["fp"].to_numpy())
        homes = np.unique(rows.loc[rows["home"], "fp"].to_numpy())
        label, links = np.arange(len(members)), []
        place = np.searchsorted(members, homes)
        for fp, me in zip(homes, place):
            near = np.flatnonzero(np.bitwise_count((members ^ fp).view(np.uint64)) <= max_bits)
            for other, at in zip(*np.unique(label[near], return_index=True)):
                if other != label[me]:
                    links.append((members[near[at]], members[me]))
                    label[label == other] = label[me]
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return run


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, home_limit: int = HOME_LIMIT,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b) links between different fingerprints within ``max_bits`` bits.

    Every link is there, except that anchors home to more than ``home_limit`` fingerprints
    give a spanning forest of theirs: the components are the same.
    ``fps`` has one row per different fingerprint, column ``fp``.
    """
    patterns = anchor_patterns(max_bits // 2)
    anchors = F.concat(*[_anchors(F.col("fp"), h, patterns) for h in (0, 1)])
    homes_of = F.array(*[F.element_at(_anchors(F.col("fp"), h, patterns), 1) for h in (0, 1)])
    # The planner's size estimate does not know that a fingerprint becomes 34 rows here, so a
    # broadcast of this side would not be checked by its real size: it is always shuffled.
    members = fps.select("fp", F.explode(anchors).alias("anchor")).hint("merge")
    homes = fps.select("fp", F.explode(homes_of).alias("anchor")).hint("merge")
    sized = homes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))

    few = homes.join(dealt_anew(sized.filter(F.col("n") <= home_limit).select("anchor")), "anchor")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = (members.select("anchor", F.col("fp").alias("a"))
             .join(few.select("anchor", F.col("fp").alias("b")), "anchor")
             .filter((F.col("a") != F.col("b")) & close)
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))

    # The hash of a fingerprint deals it to one of g groups; blocks are the pairs of groups.
    many = sized.filter(F.col("n") > home_limit).select("anchor", F.ceil(F.col("n") * 17 / block_rows).cast("int").alias("g"))
    group = F.pmod(F.xxhash64("fp"), F.col("g")).cast("int")
    each = F.sequence(F.lit(0), F.col("g") - 1)
    tag = lambda df, own, other: df.join(many, "anchor").select(
        "anchor", group.alias(own), F.explode(each).alias(other), "fp", F.lit(own == "i").alias("home"))
    blocks = tag(homes, "i", "j").unionByName(tag(members, "j", "i"))
    forest = blocks.groupBy("anchor", "i", "j").applyInPandas(_block_forest(max_bits), "a long, b long")
    return pairs.union(forest).distinct()


# ---- documents ---------------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, key_text, fp, component, component_id) per row: component is the least fingerprint
    reachable, component_id the smallest id among its documents."""
    prints = write_table(fingerprints(docs, id_col, text_col, shingle_words), "simhash")
    by_fp = write_table(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    linked = components(near_links(by_fp.select("fp"), max_bits), "a", "b")
    named = (by_fp.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("component", F.coalesce("component", "fp")))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = write_table(named.join(ids, "component").select("fp", "component", "component_id"), "simhash-components")
    return prints.join(named, "fp").select("doc_id", "key_text", "fp", "component", "component_id")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """The document with the smallest id of each component, as it came; one row of repeated ones.

    Ids that are null come last. Each row of the input goes through one join on its key.
    """
    classes = near_duplicates(docs, id_col, text_col, **limits)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), *doc_key("doc_id", None))
    kept = (classes.groupBy("component", order.alias("key")).agg(F.count(F.lit(1)).alias("copies"))
            .groupBy("component").agg(F.min(F.struct("key", "copies")).alias("least"))
            .select("least.key.key_id", "least.key.key_text", "least.copies"))
    rows = docs.select(F.struct("*").alias("row"), *doc_key(id_col, text_col)).join(kept, ["key_id", "key_text"])
    once = rows.filter("copies = 1").select("row")
    repeated = rows.filter("copies > 1").groupBy("key_id", "key_text").agg(F.first("row").alias("row")).select("row")
    return once.union(repeated).select("row.*")


ship(__name__)
