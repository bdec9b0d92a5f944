"""Repeated substrings of words over a compacted de Bruijn graph.

Edges of the graph are the windows of ``WINDOW`` consecutive words of one document. Windows
are not shuffled one by one. Neighbouring windows that share their least inner ``ANCHOR_WORDS``-
gram (the anchor) form a *path*; equal windows have equal anchors, so a window can only recur
within paths of the same anchor. Spark joins compact and compare paths:

1. anchors seen in one document only are dropped (an aggregate per anchor);
2. equal paths are one node: the copy in the smallest document is its source, and every other
   copy repeats it whole, named by its source coordinates;
3. where an anchor has different paths (a branch: the border of a repeated span, an edit), each
   distinct path is expanded into its windows once, at its source, and windows are compared.

The words covered by repeated windows are the spans to remove. Paths and windows are compared by
two independent 64-bit hashes (anchor and content, or two bases); the words themselves stay at
home.

Defined results: a null text has no words; fewer words than a window are never removed; a null
id counts as the smallest; documents with equal ids do not repeat each other, nor does a
repeated row; within one document nothing is removed for the document's own sake; texts of any length
are read whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import doc_key, ship, write_table
from tollgate.llm.rolling import BASES, Runs, mix, sliding_min, word_hashes

WINDOW = 50
ANCHOR_WORDS = 6

PATHS = ("doc_id long, key_id long, key_text long, n_words long, sha256 string, "
         "start array<int>, windows array<int>, anchor array<long>, content array<long>")
KEY = ["key_id", "key_text"]


def joined_sha256(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def paths_of(words: np.ndarray, window: int, anchor_words: int):
    """(start, windows, anchor, content) arrays: the paths of one document's word hashes."""
    if len(words) < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    grams = Runs(words, BASES[0])
    at = np.arange(len(words) - anchor_words + 1)
    least = sliding_min(mix(grams.hash(at, at + anchor_words)), window - anchor_words + 1)
    start = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
    count = np.diff(np.concatenate((start, [len(least)])))
    content = mix(Runs(words, BASES[1]).hash(start, start + count + window - 1) + count.astype(np.uint64))
    return start, count, least[start].view(np.int64), content.view(np.int64)


def document_paths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, anchor_words: int = ANCHOR_WORDS) -> DataFrame:
    """One row per document: word count, digest of all words, and its paths as arrays."""
    def run(batches):
        for batch in batches:
            n_words, sha, cols = [], [], ([], [], [], [])
            for text in batch.column(3).cast(pa.binary()):
                data = text.as_py() or b""
                words = data.split()
                n_words.append(len(words))
                sha.append(joined_sha256(words))
                for col, values in zip(cols, paths_of(word_hashes(data), window, anchor_words)):
                    col.append(values)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
            lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(v) for v in col]), pa.int32()),
                                              pa.array(np.concatenate(col), kind))
                     for col, kind in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(n_words, pa.int64()), pa.array(sha), *lists],
                ["doc_id", *KEY, "n_words", "sha256", "start", "windows", "anchor", "content"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *doc_key(id_col, text_col),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, PATHS)


def repeated_paths(documents: DataFrame) -> DataFrame:
    """Paths that recur, with ``source_id`` and ``source_start``, the first copy's coordinates.

    ``whole``: the source lies in a smaller document, so every window repeats. The others are
    sources themselves, kept where their anchor has other paths too.
    """
    paths = documents.select(*KEY, F.explode(F.arrays_zip("start", "windows", "anchor", "content")).alias("p")) \
        .select(*KEY, "p.*")
    shared = (paths.groupBy("anchor")
              .agg(F.min("key_id").alias("lo"), F.max("key_id").alias("hi"),
                   F.min("content").alias("c0"), F.max("content").alias("c1"))
              .filter("lo < hi").select("anchor", (F.col("c0") < F.col("c1")).alias("branch")))
    recur = write_table(paths.join(shared, "anchor"), "paths")
    nodes = recur.groupBy("anchor", "content").agg(F.min(F.struct("key_id", "start")).alias("source"))
    found = (recur.join(nodes, ["anchor", "content"])
             .withColumn("whole", F.col("source.key_id") < F.col("key_id"))
             .filter("whole or branch")
             .select(*KEY, "start", "windows", "whole", F.col("source.key_id").alias("source_id"),
                     F.col("source.start").alias("source_start")))
    return write_table(found, "paths-found")


def _windows_of(window: int):
    """Rows (key, w1, w2, starts) of the different windows of all paths that are sources."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                todo = [p for p in batch.column(3)[i].as_py() if not p["whole"]]
                if not todo:
                    continue
                words = word_hashes(batch.column(2)[i].as_py())
                at = np.unique(np.concatenate([np.arange(p["start"], p["start"] + p["windows"]) for p in todo]))
                w1, w2 = (mix(Runs(words, b).hash(at, at + window)).view(np.int64) for b in BASES)
                order = np.lexsort((w2, w1))               # a window that recurs in the document is one row
                w1, w2, at = w1[order], w2[order], at[order]
                first = np.flatnonzero(np.concatenate(([True], (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1]))))
                n, ends = len(first), np.append(first, len(at)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, batch.column(k)[i].as_py(), np.int64)) for k in (0, 1)]
                    + [pa.array(w1[first]), pa.array(w2[first]),
                       pa.ListArray.from_arrays(pa.array(ends), pa.array(at.astype(np.int32)))],
                    [*KEY, "w1", "w2", "starts"])

    return run


def repeated_windows(candidates: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, starts): windows at sources of branching paths that also start in a smaller document."""
    rows = candidates.select(*KEY, F.col("text").cast("binary"), "paths")
    each = write_table(rows.mapInArrow(_windows_of(window), "key_id long, key_text long, w1 long, w2 long, starts array<int>"),
                       "windows")
    first = each.groupBy("w1", "w2").agg(F.min("key_id").alias("lo"), F.max("key_id").alias("hi")).filter("lo < hi").select("w1", "w2", "lo")
    return (each.join(first, ["w1", "w2"]).filter("lo < key_id")
            .groupBy(*KEY).agg(F.flatten(F.collect_list("starts")).alias("starts")))


def covered(n_words: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True for every word inside one of the half-open spans."""
    depth = np.zeros(n_words + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return depth.cumsum()[:n_words] > 0


def _cut(window: int):
    def run(batches):
        for batch in batches:
            removed, sha = [], []
            for i in range(batch.num_rows):
                words = batch.column(2)[i].as_py().split()
                spans = [(p["start"], p["start"] + p["windows"] + window - 1)
                         for p in batch.column(3)[i].as_py() if p["whole"]]
                spans += [(s, s + window) for s in batch.column(4)[i].as_py() or ()]
                gone = covered(len(words), *np.array(spans, np.int64).reshape(-1, 2).T)
                removed.append(int(gone.sum()))
                sha.append(joined_sha256([w for w, g in zip(words, gone.tolist()) if not g]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(removed, pa.int64()), pa.array(sha)],
                                             [*KEY, "n_removed", "kept_sha256"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, anchor_words: int = ANCHOR_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per row.

    Only documents with recurring paths meet their text again; the digest of the others was
    made when their paths were read.
    """
    documents = write_table(document_paths(docs, id_col, text_col, window, anchor_words), "document-paths")
    by_doc = repeated_paths(documents).groupBy(*KEY).agg(
        F.collect_set(F.struct("start", "windows", "whole")).alias("paths"))
    texts = docs.select(*doc_key(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    candidates = write_table(texts.join(by_doc, KEY), "path-texts")
    todo = candidates.join(repeated_windows(candidates, window), KEY, "left")
    cut = (todo.select(*KEY, F.col("text").cast("binary"), "paths", "starts")
           .mapInArrow(_cut(window), "key_id long, key_text long, n_removed long, kept_sha256 string")
           .groupBy(*KEY).agg(F.first("n_removed").alias("n_removed"), F.first("kept_sha256").alias("kept_sha256")))
    return (documents.select("doc_id", *KEY, "n_words", "sha256").join(cut, KEY, "left")
            .select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
                    F.coalesce("kept_sha256", "sha256").alias("kept_sha256")))


ship(__name__)
