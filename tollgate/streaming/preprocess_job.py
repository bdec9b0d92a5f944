"""Streaming pre-process job (3.1): raw lines -> structured records.

One ``foreachBatch`` per micro-batch:
* dimensions are re-read every batch (G5/W6: a file-backed DataFrame created
  once does not see later changes; re-reading does);
* the parsed lines and the processed messages are each persisted once and feed the link
  statistics, the routed records (table and Kafka) and the rejects;
* every output is written under ``batch_id=<id>`` with dynamic partition
  overwrite, so a retried batch (lost executor, restart from the checkpoint)
  replaces its own output instead of duplicating it.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.codec import to_record_line
from tollgate.functions.text import iso_to_ts
from tollgate.operators.metrics import link_counts
from tollgate.plans.preprocess import Dimensions, parse_complete_lines, process_messages, structured
from tollgate.streaming.keyed_table import KeyedTable
from tollgate.streaming.metrics_job import blacklisted_ips
from tollgate.streaming.sources import PREPROCESS_TRIGGER, with_topic

# Fixed value: monitor records live for 1800 s.
MONITOR_TTL_S = 1800
MONITOR_COMPACT = 100      # batches between compactions of the monitor table


def _write(df: DataFrame, path: str, batch_id: int, *parts: str) -> None:
    # a level of 10 000 batches above the batch keeps directories short
    (df.withColumn("batch_group", F.lit(batch_id // 10_000)).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_group", "batch_id", *parts).parquet(path))


def monitor_records(msgs: DataFrame, batch_time_ms: int) -> DataFrame:
    """IO12/A9/A10/P17: one JSON document per batch with per-server request counts
    and latest active connections, keyed by batch time, expiring after the TTL."""
    lc = link_counts(msgs.withColumn("ts", iso_to_ts(F.col("time_iso8601"))))
    doc = lc.agg(F.to_json(F.struct(
        F.map_from_entries(F.collect_list(F.struct("server_addr", "request_count"))).alias("servers_count"),
        F.map_from_entries(F.collect_list(F.struct("server_addr", "active_user_num"))).alias("active_num"),
    )).alias("json"))
    return doc.select(F.concat(F.lit("monitor:link:"), F.lit(str(batch_time_ms))).alias("key"), "json",
                      (F.lit(batch_time_ms) + F.lit(MONITOR_TTL_S * 1000)).alias("expires_at"))


def make_batch_handler(out_dir: str, dims_loader: Callable[[SparkSession], Dimensions],
                       kafka_servers: str | None = None, console: bool = False, blacklist: str | None = None,
                       clock_ms: Callable[[], int] = lambda: int(time.time() * 1000)):
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        dims = dims_loader(spark)                       # G5: fresh dimensions per batch
        now_ms = clock_ms()                             # driver clock, like current_timestamp()
        if blacklist:                                   # B6: what the metrics job has blacklisted by now
            dims = replace(dims, black_ips=dims.black_ips.toDF("ip_name").union(blacklisted_ips(spark, blacklist, now_ms)))
        parsed = parse_complete_lines(batch).persist()
        ok = parsed.filter("is_valid_number")
        done = process_messages(ok, dims).persist()     # parsed once for records, rejects and Kafka
        try:
            monitor = KeyedTable(spark, os.path.join(out_dir, "monitor"))
            monitor.put(monitor_records(ok, now_ms).withColumnRenamed("json", "value"), f"batch-{batch_id}")
            if batch_id % MONITOR_COMPACT == MONITOR_COMPACT - 1:
                monitor.compact(now_ms)                 # expired records go
            rejects = parsed.filter(~F.col("is_valid_number")).select("value").unionByName(
                done.filter("parse_failed").select("value"))
            _write(rejects, os.path.join(out_dir, "rejects"), batch_id)
            rec = structured(done)
            routed = with_topic(rec).withColumn("value", to_record_line(rec))
            if kafka_servers:
                from tollgate.streaming.sources import write_kafka
                write_kafka(routed, kafka_servers)
            _write(routed.drop("value"), os.path.join(out_dir, "records"), batch_id, "behavior_type")
            if console:                                 # IO13: banner, skip empty batches
                n = ok.count()
                if n:
                    t = time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime(now_ms / 1000))
                    print(f"---- batch {batch_id} at {t}: {n} rows ----")
        finally:
            done.unpersist()
            parsed.unpersist()
    return handle


def start_preprocess(lines: DataFrame, out_dir: str, checkpoint: str,
                     dims_loader: Callable[[SparkSession], Dimensions] = Dimensions.defaults,
                     trigger: dict | None = None, kafka_servers: str | None = None,
                     console: bool = False, blacklist: str | None = None,
                     clock_ms: Callable[[], int] = lambda: int(time.time() * 1000)):
    """Start the job; ``trigger`` defaults to the 3 s processing-time interval;
    ``console`` prints a banner with the batch time and row count (IO13). ``blacklist`` is the
    blacklist table of the metrics job: IPs on it are tagged from the next batch on (B6)."""
    handler = make_batch_handler(out_dir, dims_loader, kafka_servers, console, blacklist, clock_ms)
    w = lines.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"processingTime": PREPROCESS_TRIGGER}))
    return w.start()
