"""Appended tables with keys, expiry and compaction (IO12, IO17, IO19, A11).

A key/value store with a time to live becomes a table that runs append to: a key is inserted if it is not
live, and a reader sees the live rows. Compaction keeps it small: live rows are written as the next *base*, which
names the runs it has taken in; those are then deleted, with the base before. A reader takes the newest finished
base and the runs it does not name, so it sees the same rows before, during and after a compaction, and an
interrupted one is simply not finished. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.streaming import storage


class AppendedTable:
    """Runs appended below ``path/runs`` and compacted into ``path/base``; a run of a known id replaces itself."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _bases(self) -> list[int]:
        found = [storage.number_of(f) for f in storage.folders(self.spark, f"{self.path}/base")]
        return [v for v in sorted(found) if storage.exists(self.spark, f"{self.path}/base/v={v}/taken/_SUCCESS")]

    def _taken(self, version: int) -> set[str]:
        return {r.run for r in self.spark.read.schema("run string").parquet(f"{self.path}/base/v={version}/taken").collect()}

    def _open_runs(self) -> list[str]:
        runs = storage.folders(self.spark, f"{self.path}/runs")
        bases = self._bases()
        taken = self._taken(bases[-1]) if bases else set()
        return [r for r in runs if r not in taken and storage.exists(self.spark, f"{self.path}/runs/{r}/_SUCCESS")]

    def append(self, rows: DataFrame, run: str) -> None:
        bases = self._bases()
        if not bases or run not in self._taken(bases[-1]):  # a run that was taken into the base is done
            rows.select(*self._names()).write.mode("overwrite").parquet(f"{self.path}/runs/{run}")

    def _names(self) -> list[str]:
        return [c.strip().split(" ")[0] for c in self.schema.split(",")]

    def paths(self) -> list[str]:
        """The folders that hold the rows now."""
        bases = self._bases()
        return ([f"{self.path}/base/v={bases[-1]}/rows"] if bases else []) + [f"{self.path}/runs/{r}" for r in self._open_runs()]

    def read(self) -> DataFrame:
        """All rows of the newest base and of the runs after it."""
        paths = self.paths()
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def rewrite(self, rows: DataFrame) -> None:
        """Make ``rows`` (derived from ``read()``) the next base and drop what they were read from."""
        old, runs = self._bases(), self._open_runs()
        # the last run may be repeated after a restart, so its id stays known; so do those whose folders are still there
        there = storage.folders(self.spark, f"{self.path}/runs")
        known = sorted(set(runs) | ({r for r in self._taken(old[-1]) if r in there or not runs} if old else set()))
        seen = [storage.number_of(f) for f in storage.folders(self.spark, f"{self.path}/base")]
        version = max(seen, default=0) + 1
        base = f"{self.path}/base/v={version}"
        rows.select(*self._names()).coalesce(1).write.mode("overwrite").parquet(f"{base}/rows")
        self.spark.createDataFrame([(r,) for r in known], "run string").coalesce(1).write.mode("overwrite").parquet(f"{base}/taken")
        for v in seen:
            storage.delete(self.spark, f"{self.path}/base/v={v}")
        for r in known:
            storage.delete(self.spark, f"{self.path}/runs/{r}")


class KeyedTable(AppendedTable):
    """Keys with a value that live until ``expires_at`` (ms)."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, "key string, value string, expires_at long")

    def live(self, now_ms: int) -> DataFrame:
        """One row per live key: the latest to expire; of equal ones the least value."""
        w = Window.partitionBy("key").orderBy(F.desc("expires_at"), "value")   # rows per key: its runs since the compaction
        rows = self.read().where(F.col("expires_at") > now_ms)
        return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")

    def insert_absent(self, rows: DataFrame, run: str, now_ms: int) -> None:
        """IO17: insert the keys of ``rows`` that are not live; one row per key, expired ones never."""
        w = Window.partitionBy("key").orderBy(F.desc("expires_at"), "value")
        new = (rows.select("key", "value", "expires_at").where(F.col("key").isNotNull() & (F.col("expires_at") > now_ms))
               .withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r"))
        others = [r for r in self.paths() if not r.endswith(f"/runs/{run}")]      # a run that is repeated does not see itself
        if others:
            before = self.spark.read.schema(self.schema).parquet(*others).where(F.col("expires_at") > now_ms)
            new = new.join(before.select("key").distinct(), "key", "left_anti")
        self.append(new, run)

    def put(self, rows: DataFrame, run: str) -> None:
        """IO12: set keys; the row that expires last counts."""
        self.append(rows, run)

    def compact(self, now_ms: int) -> None:
        """Keep one live row per key; expired rows go."""
        self.rewrite(self.live(now_ms))
