"""Blacklist records, expiry and restore (B4-B6, J5, F8, A13, IO14-IO17)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.streaming import storage

# Fixed value: blacklist time-to-live in seconds.
BLACKLIST_TTL_S = 3600


def to_blacklist_records(decisions: DataFrame, ttl_s: int = BLACKLIST_TTL_S,
                         issued_at: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``(key_exp_time, key, value)``; expiry = issue time + TTL in epoch ms.
    The issue time defaults to the end of the metric window (deterministic)."""
    t = issued_at if issued_at is not None else F.unix_millis(F.col("window_end"))
    return decisions.select(
        (t + F.lit(ttl_s * 1000)).cast("bigint").alias("key_exp_time"),
        F.col("key"),
        F.to_json(F.struct("flow_id", "crawler_type", "score", "hit_rules")).alias("value"), *keep)


def latest_per_key(records: DataFrame, key: str = "key", exp: str = "key_exp_time") -> DataFrame:
    """J5 as the reference's self-join: max expiry per key (A13, map-side
    partial) joined back; ties all survive. Reads ``records`` twice, so use it on
    a stored table; ``rank_latest`` is the single-pass form."""
    mx = records.groupBy(key).agg(F.max(F.col(exp).cast("bigint")).alias("_max_exp"))
    return (records.join(mx, [key]).filter(F.col(exp).cast("bigint") == F.col("_max_exp"))
                   .drop("_max_exp"))


def restore(records: DataFrame, now_ms: Column, live_keys: DataFrame | None = None,
            min_left_ms: int = 1000) -> DataFrame:
    """B5/IO17: latest unexpired record per key with at least ``min_left_ms`` to
    live, only for keys not already live (insert-if-absent).

    Uses the single-pass ``rank() = 1`` form: records per key are bounded by
    windows x flows (not by traffic), so the per-key sort is small, and the
    upstream plan is computed once instead of twice."""
    r = rank_latest(records)
    r = r.filter(F.col("key_exp_time").cast("bigint") - now_ms >= min_left_ms)
    if live_keys is not None:
        r = r.join(live_keys.select(F.col(live_keys.columns[0]).alias("key")), "key", "left_anti")
    return r.withColumn("ttl_ms", F.col("key_exp_time").cast("bigint") - now_ms)


def rank_latest(records: DataFrame, key: str = "key", exp: str = "key_exp_time") -> DataFrame:
    """J5 in its window form (``rank() = 1``, ties kept): one shuffle on the key."""
    w = Window.partitionBy(key).orderBy(F.col(exp).cast("bigint").desc())
    return records.withColumn("_r", F.rank().over(w)).filter("_r = 1").drop("_r")


# ---- hour-partitioned parquet (IO14-IO16) --------------------------------------

HOUR_PARTS = ["y", "m", "d", "h"]
RECORDS = "key_exp_time long, key string, value string, y int, m int, d int, h int, run_id string"


def write_hourly(df: DataFrame, path: str, written_at: Column, run_id: str) -> None:
    """IO14/IO15: write below ``path/y=/m=/d=/h=/run_id=`` by the hour of *writing*.

    ``written_at`` is the run's logical time: a retried run has the same one and the same id, and
    replaces its own files instead of adding them again.
    """
    formats = zip(HOUR_PARTS, ("yyyy", "MM", "dd", "HH"))
    (df.withColumns({c: F.date_format(written_at, f).cast("int") for c, f in formats})
       .withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(*HOUR_PARTS, "run_id").parquet(path))


def read_hours(spark: SparkSession, path: str, hours: list[str]) -> DataFrame:
    """IO16: the records written in the given hours (``yyyy-MM-dd HH``); literal predicates on the
    partition columns prune directories, missing hours (and a missing table) are simply empty."""
    wanted = F.lit(False)
    for hour in hours:
        y, m, d = hour[:10].split("-")
        wanted = wanted | ((F.col("y") == int(y)) & (F.col("m") == int(m)) & (F.col("d") == int(d))
                           & (F.col("h") == int(hour[11:13])))
    if not storage.exists(spark, path):                   # nothing was ever written
        return spark.createDataFrame([], RECORDS).filter(wanted)
    return spark.read.parquet(path).filter(wanted)


def hours_to_restore(now_ms: int) -> list[str]:
    """The current and the previous hour (UTC), those of which records may still live."""
    at = datetime.fromtimestamp(now_ms / 1000, UTC)
    return [(at - timedelta(hours=k)).strftime("%Y-%m-%d %H") for k in (0, 1)]
