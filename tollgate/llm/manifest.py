"""Merkle manifest of a dataset as a persistent tree: an altered leaf copies its path, all else is shared.

Every row is a leaf: the digest of its columns. The leaves of a group (``source``), in the order
of their ids, are hashed in runs of ``FAN`` up to one node per group (subroot), and the subroots in the
order of their groups up to one root. A digest is the lower-case hexadecimal SHA-256 of its
inputs, digests as hexadecimal text.

In Spark terms a tree is stacked from aligned blocks of ``FAN ** LEVELS`` consecutive nodes. A block is one row
that holds its nodes in order, hashes them up by ``LEVELS`` levels on its own, and hands its top on as one node of
the next storey; storeys are added until every group has one node. Places come from one range
shuffle of the leaf digests (texts are not shuffled): a row's place is its place in its partition plus the
rows of its group in earlier partitions, so no task holds a group.

The base tree is never changed. ``proofs`` hands the siblings of a path down from the root,
block by block, so that every join is one block to its parent's entry for it; each parent has
``FAN ** LEVELS`` entries at most. A version (``path_of``) is then the altered leaf and the copies of its
ancestors, each the hash of the copy below between the untouched siblings.

Defined results: a null column is ``-`` in the digest, so null and empty texts differ; null groups
come first and are one group; null ids come first in their group, equal ids are ordered by their
leaves' digests, and rows equal in everything are leaves of their own; a group with one row has
that leaf as its subroot, a table with one group its subroot as its root; an empty table gives no rows.
A text counts with all its bytes, whatever its length. Columns other than those named in ``COLUMNS`` are
ignored and never passed on, so their names do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import write_table

FAN = 3
LEVELS = 6                 # a block has 729 nodes at most
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon, value: no two rows have the same text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**replaced: Column) -> Column:
    """Digest of a row, with some columns replaced."""
    return F.sha2(F.concat(*[field(replaced.get(c, F.col(c))) for c in COLUMNS]), 256)


def packed(digest: Column) -> Column:
    return F.unhex(digest)


def unpacked(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def placed(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place within the key by ``order``, and ``n``, the key's rows.

    Rows are dealt in ranges and numbered where they are; a small table of (key, partition) counts shifts
    the numbers. Both tables are written: a repeated task may deal the ranges otherwise.
    """
    by = [F.col(c).asc_nulls_first() for c in (key, *order)]
    dealt = write_table(rows.repartitionByRange(*by).sortWithinPartitions(*by)
                        .withColumn("at", F.monotonically_increasing_id())
                        .withColumn("part", F.shiftright("at", 33)), "merkle-order")
    runs = dealt.groupBy(F.col(key).alias("run_key"), F.col("part").alias("run_part")).agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("here"))
    of_key = Window.partitionBy("run_key")            # one row per partition that holds the key
    earlier = of_key.orderBy("run_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = write_table(runs.select("run_key", "run_part", "first", F.sum("here").over(of_key).alias("n"),
                                   F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("before")), "merkle-runs")
    own = F.col(key).eqNullSafe(F.col("run_key")) & (F.col("part") == F.col("run_part"))
    return dealt.join(runs, own).withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop(
        "at", "part", "run_key", "run_part", "first", "before")


def in_blocks(nodes: DataFrame, key: str) -> DataFrame:
    """One row per block of ``FAN ** LEVELS`` consecutive nodes, in order."""
    rest = [c for c in nodes.columns if c not in (key, "n")]
    return (nodes.groupBy(key, F.floor(F.col("pos") / FAN ** LEVELS).alias("block"), "n")
            .agg(F.sort_array(F.collect_list(F.struct("pos", *[c for c in rest if c != "pos"]))).alias("nodes")))


def hashed_up(nodes: Column) -> Column:
    """The level above: every run of ``FAN`` digests becomes their digest."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * FAN + 1, F.lit(FAN)), ""), 256))


def with_levels(blocks: DataFrame) -> DataFrame:
    """Column ``levels``: the digests of the block's own nodes, those one level up, and so on to its top.

    A block among others goes up all levels, also where one node is left; a key's only block stops at one node.
    """
    own = F.transform("nodes", lambda x: unpacked(x["digest"]))

    def one_up(levels: Column, _: Column) -> Column:
        below = F.element_at(levels, -1)
        return F.when((F.col("n") > FAN ** LEVELS) | (F.size(below) > 1), F.concat(levels, F.array(hashed_up(below)))).otherwise(levels)
    return blocks.withColumn("levels", F.aggregate(F.sequence(F.lit(1), F.lit(LEVELS)), F.array(own), one_up))


def top(levels: Column) -> Column:
    return packed(F.element_at(levels, -1)[0])


def steps(levels: Column, place: Column) -> Column:
    """The way up from a node of a block: per level the digests to its left and to its right in its run."""
    def beside(nodes: Column, k: Column) -> Column:
        p = F.floor(place / F.pow(F.lit(FAN), k)).cast("int")
        before = F.pmod(p, F.lit(FAN))
        return F.struct(F.array_join(F.slice(nodes, p - before + 1, before), "").alias("left"),
                        F.array_join(F.slice(nodes, p + 2, F.lit(FAN - 1) - before), "").alias("right"))
    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), beside)


def storeys(nodes: DataFrame, key: str) -> list[DataFrame]:
    """Written block tables from the leaves up; the last one has one block, with its top, per key."""
    most = nodes.agg(F.max("n")).first()[0] or 1
    built = []
    while True:
        rest = [c for c in nodes.columns if c not in ("n", "pos", key)]
        built.append(write_table(in_blocks(nodes.select(key, "n", "pos", *rest), key), "merkle-blocks"))
        most = -(-most // FAN ** LEVELS)
        if most == 1:
            return built
        nodes = with_levels(built[-1]).select(key, F.col("block").alias("pos"), top(F.col("levels")).alias("digest"),
                                              F.ceil(F.col("n") / FAN ** LEVELS).alias("n"))


def tops(storey: DataFrame, key: str) -> DataFrame:
    """The one node that is left of every key."""
    return with_levels(storey).select(key, top(F.col("levels")).alias("digest"))


def proofs(built: list[DataFrame], key: str, way_on: DataFrame) -> DataFrame:
    """Every leaf's ``way``: its steps in its own block, then those of its block's top, and so on to the root.

    ``way_on`` holds for every key the way from its top onwards; its other columns are handed down.
    """
    handed = [c for c in way_on.columns if c not in (key, "way")]
    way_on = way_on.select(F.col(key).alias("up_key"), F.lit(0).cast("bigint").alias("up"), F.col("way").alias("on"), *handed)
    for storey in reversed(built):
        own = F.col(key).eqNullSafe(F.col("up_key")) & (F.col("block") == F.col("up"))
        blocks = with_levels(storey.join(way_on, own))
        each = F.transform("nodes", lambda x, i: F.struct(x.alias("node"), F.concat(steps(F.col("levels"), i), F.col("on")).alias("way")))
        rows = blocks.select(key, *handed, F.explode(each).alias("x")).select(key, *handed, "x.node.*", "x.way")
        way_on = rows.select(F.col(key).alias("up_key"), F.col("pos").alias("up"), F.col("way").alias("on"), *handed)
    return rows


def siblings(way: Column) -> Column:
    """All digests beside a path, level by level and left to right, as one text."""
    return F.array_join(F.transform(way, lambda s: F.concat(s["left"], s["right"])), "")


def path_of(start: Column, way: Column) -> Column:
    """A version's own nodes: the (altered) leaf and the copies of its ancestors, the root last."""
    return F.aggregate(way, F.array(start), lambda path, s: F.concat(path, F.array(
        F.sha2(F.concat(s["left"], F.element_at(path, -1), s["right"]), 256))))


def build(docs: DataFrame, altered: Column | None = None) -> DataFrame:
    """Leaves with their proofs and versions.

    ``altered`` is the text a row is altered to; null leaves the row as it is. Gives ``doc_id, source, leaf,
    subroot, root``, ``way`` (the siblings, ``left`` and ``right`` of each level) and ``version`` (the altered, or
    else the original, leaf and its ancestors folded from it).
    """
    other = F.lit(None).cast("binary") if altered is None else F.when(altered.isNotNull(), packed(leaf(text=altered)))
    leaves = docs.select("doc_id", "source", packed(leaf()).alias("digest"), other.alias("other"))
    per_source = storeys(placed(leaves, "source", ["doc_id", "digest"]), "source")
    subroots = tops(per_source[-1], "source").withColumn("dataset", F.lit(0))
    whole = storeys(placed(subroots, "dataset", ["source"]), "dataset")
    root = tops(whole[-1], "dataset")
    start = root.select("dataset", F.col("digest").alias("root"),
                        F.array().cast("array<struct<left:string,right:string>>").alias("way"))
    of_source = write_table(proofs(whole, "dataset", start).select(
        "source", F.col("digest").alias("subroot"), "root", "way"), "merkle-subroots")
    return proofs(per_source, "source", of_source).select(
        "doc_id", "source", unpacked(F.col("digest")).alias("leaf"), unpacked(F.col("subroot")).alias("subroot"),
        unpacked(F.col("root")).alias("root"), "way",
        path_of(unpacked(F.coalesce("other", "digest")), F.col("way")).alias("version"))
