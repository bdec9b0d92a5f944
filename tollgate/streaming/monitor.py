"""Query progress as data (IO19, A11, V17).

The engine keeps the progress of the last batches only. ``ProgressTable`` is a listener that
appends one row per batch to a table as it ends, so totals and monthly means cover all of them;
there is no HTTP to the UI. A day's batches are a table of their own and are compacted into one file, now and then
while the day lasts and once it is over, so the history of a year is a few hundred files.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tollgate.streaming import storage
from tollgate.streaming.keyed_table import AppendedTable

PROGRESS = ("query string, run string, batch_id long, timestamp string, num_input_rows long, duration_ms long, tier string")


class ProgressTable(StreamingQueryListener):
    """Appends every batch of the queries named in ``tiers`` (query name -> tier) to ``path``."""

    def __init__(self, spark: SparkSession, path: str, tiers: dict[str, str], compact_every: int = 1000):
        self.spark, self.path, self.tiers, self.compact_every = spark, path, tiers, compact_every
        self.day, self.batches = "", 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        if p.get("name") in self.tiers:
            row = (p["name"], str(p["runId"]), int(p["batchId"]), p["timestamp"], int(p.get("numInputRows", 0)),
                   int((p.get("durationMs") or {}).get("triggerExecution", 0)), self.tiers[p["name"]])
            day = row[3][:10]
            run = f"{row[0]}-{row[1]}-{row[2]}-{row[3]}".replace(":", "")
            _day_table(self.spark, self.path, day).append(self.spark.createDataFrame([row], PROGRESS).coalesce(1), run)
            self.batches += 1
            if self.day and day != self.day or self.batches % self.compact_every == 0:
                compact_history(self.spark, self.path)
            self.day = day

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def _day_table(spark: SparkSession, path: str, day: str) -> AppendedTable:
    return AppendedTable(spark, f"{path}/day={day}", PROGRESS)


def _day_tables(spark: SparkSession, path: str) -> list[AppendedTable]:
    return [_day_table(spark, path, f.removeprefix("day=")) for f in storage.folders(spark, path) if f.startswith("day=")]


_KEY = ["query", "run", "batch_id", "timestamp"]


def compact_history(spark: SparkSession, path: str) -> None:
    """Every day that has appended batches becomes one file; days that have none are left alone."""
    for table in _day_tables(spark, path):
        if len(table.paths()) > 1 or not any("/base/" in p for p in table.paths()):
            table.rewrite(table.read().dropDuplicates(_KEY))


def progress_frame(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch of the stored history: rows, duration and rows per ms (0 when duration 0).
    A batch reported twice (a listener retried) counts once."""
    paths = [p for table in _day_tables(spark, path) for p in table.paths()]
    stored = spark.read.schema(PROGRESS).parquet(*paths) if paths else spark.createDataFrame([], PROGRESS)
    df = stored.dropDuplicates(_KEY)
    return df.withColumn("rows_per_ms", F.when(F.col("duration_ms") > 0, F.col("num_input_rows") / F.col("duration_ms"))
                         .otherwise(F.lit(0.0)))


def batch_summary(progress: DataFrame) -> DataFrame:
    """A11 over all batches: total rows, total duration and throughput."""
    return progress.agg(F.sum("num_input_rows").alias("rows"), F.sum("duration_ms").alias("duration_ms")) \
        .withColumn("rows_per_ms", F.when(F.col("duration_ms") > 0, F.col("rows") / F.col("duration_ms"))
                    .otherwise(F.lit(0.0)))


def mean_latency_by_tier(progress: DataFrame) -> DataFrame:
    """Mean batch duration per tier and month."""
    month = F.date_format(F.to_timestamp("timestamp"), "yyyy-MM")
    return progress.groupBy("tier", month.alias("month")).agg(F.avg("duration_ms").alias("mean_duration_ms"))
