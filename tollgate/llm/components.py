"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import dealt_anew, write_table


def _towards_least(edges: DataFrame) -> DataFrame:
    """Per edge (u, v): the least of u and all its v, as column ``m``."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(dealt_anew(least), "u").withColumn("m", F.least("u", "m"))


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; edges run from the larger to the smaller node."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = (_towards_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    small = _towards_least(large)
    return (small.select("u", F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
            .filter("u <> v").distinct())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least node reachable, for every node that has an edge.

    A round replaces links by links to lesser nodes and stops when nothing changes; the number of
    rounds grows with the logarithm of the longest path. Each round is written, so none is
    computed twice and no lineage builds up. Edges with a null end and loops are ignored.
    """
    cur = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    cur, before = write_table(cur, "links"), None
    while True:
        mark = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == before:
            break
        before, cur = mark, write_table(_round(cur), "links")
    roots = cur.select(F.col("v").alias("node")).distinct()
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(roots.select("node", F.col("node").alias("component"))))
