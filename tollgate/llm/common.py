"""Helpers the text operators share: intermediate tables, whole-text words, task code shipping."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.session import scratch_path

# The word rule of the contracts: runs of anything but space, tab, LF, VT, FF, CR.
# ``bytes.split()`` cuts UTF-8 text at exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"


def ship(module: str) -> None:
    """Send the module's functions to executors by value: they need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the reread of a file, not the plan above it.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_by_worker(name: str, key: object, make: Callable[[], object]):
    """What a Python worker keeps from task to task under ``name``: made anew where ``key`` differs from the last one's.

    Task code comes by value, with globals of its own for every task, so it is kept in a module of the process.
    """
    place = sys.modules.setdefault("_tollgate_worker", types.ModuleType("_tollgate_worker")).__dict__
    if name not in place or place[name][0] != key:
        place[name] = key, make()
    return place[name][1]


def dealt_anew(per_key: DataFrame) -> DataFrame:
    """An aggregate per key, to be joined to the rows it was made of, in partitions of its own.

    Joined as it is, it would keep the aggregate's partitioning, and adaptive execution cannot split
    a hot key of the other side where one side of the join is not a plain shuffle. The
    aggregate has one row per key, so dealing it out once more is cheap.
    """
    return per_key.hint("rebalance")


def doc_key(doc_id: str = "doc_id", text: str | None = "text") -> list[Column]:
    """Columns that tell rows apart: ``key_id`` (null ids sort first) and ``key_text``.

    Rows equal in both are the same document read twice and get the same result. Without
    ``text``, the column ``key_text`` is there already.
    """
    key_text = F.col("key_text") if text is None else F.xxhash64(F.col(text).cast("string")).alias("key_text")
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("key_id"), key_text]


ship(__name__)
