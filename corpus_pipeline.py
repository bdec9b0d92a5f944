"""Training-corpus pipeline over ``documents``: each stage reads what its predecessor kept.

1. quality classifier: documents that it rejects (low quality, toxic) go;
2. line dedup: later copies of repeated line runs go, documents keep their other lines;
3. SimHash near-dedup: of each component of near-equal documents the one with the smallest id stays;
4. benchmark decontamination: documents that contain a test item within its edit budget go;
5. mixing: what is left is drawn to the target weights; a document comes once per epoch, with
   ``n_tokens``, ``epoch``, ``block`` and ``turn`` (read the mix in the order of ``turn``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tollgate.llm import decontaminate, lines, mixing, quality, simhash
from tollgate.llm.common import write_table
from tollgate.sources.tables import read_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps, as they came. Null and empty texts are judged by their metadata; texts
    of any length count whole; repeated rows share a verdict; without labels of both kinds, or without documents, all stay."""
    return quality.keep_clean(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without later copies of repeated line runs, ``n_chars`` brought up to date. The copy in the
    smallest id (null first) stays, then the first in its text; null texts stay null; a text may become empty."""
    return lines.without_repeats(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal ones, that with the smallest id. Null, empty and blank texts are one
    group; of rows that share the id one stays; a text of any length has one fingerprint; no documents give none."""
    return simhash.keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in whose whole text no test item occurs within its edit budget, as they came, repeated rows
    too. Null and empty texts and an empty benchmark leave all."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per document and epoch. Null is a source of its own; documents without words are in no
    block; equal hashes go by id; no documents give no mix."""
    return mixing.mix(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

# A trained classifier decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
