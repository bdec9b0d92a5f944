"""The reference's three jobs as batch plans (§3.1-3.3).

Long plans are cut by *written tables* under the shared folder named by
``spark.checkpoint.dir`` (never a machine-local folder), so a lost executor
recomputes from the last written table, not from the raw log.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.operators import metrics as M
from tollgate.operators.blacklist import hours_to_restore, read_hours, restore, to_blacklist_records, write_hourly
from tollgate.operators.catalogue import booking_metrics, catalogue_long, unpaid_bookings
from tollgate.operators.scoring import RuleBook, blacklist_decisions, evaluate_rules, flow_scores
from tollgate.operators.tags import flag_critical
from tollgate.operators.filters import by_behavior
from tollgate.plans.preprocess import Dimensions, parse_complete_lines, process_messages, structured
from tollgate.session import scratch_path
from tollgate.streaming.keyed_table import KeyedTable


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")   # two runs never share a table
    df.write.parquet(path)
    return spark.read.parquet(path)


def preprocess_job(spark: SparkSession, lines: DataFrame, out_dir: str,
                   dims: Dimensions | None = None) -> None:
    """3.1 in batch: raw lines -> routed structured records (by behaviour) + rejects."""
    dims = dims or Dimensions.defaults(spark)
    parsed = materialise(spark, parse_complete_lines(lines), "complete-lines")
    done = materialise(spark, process_messages(parsed.filter("is_valid_number"), dims), "processed")
    by_behavior(structured(done), "Query", "Book").write.mode("overwrite") \
        .partitionBy("behavior_type").parquet(os.path.join(out_dir, "records"))
    rejects = parsed.filter(~F.col("is_valid_number")).select("value").unionByName(
        done.filter("parse_failed").select("value"))
    rejects.write.mode("overwrite").parquet(os.path.join(out_dir, "rejects"))


def rule_metrics_job(spark: SparkSession, requests: DataFrame, booking_events: DataFrame | None,
                     book: RuleBook, critical_pages: DataFrame, out_dir: str,
                     *, window: str = "1 day", rule_type: int = 2, run_id: str = "run",
                     written_at: str | None = None) -> DataFrame:
    """3.2: all metrics in long form (written once), scored, decisions written as
    hour-partitioned blacklist records. Returns the written blacklist.

    ``written_at`` (UTC time) is the run's logical time, by default the end of each record's
    window; a rerun with the same id replaces its records."""
    req = flag_critical(requests, critical_pages)
    parts = [M.to_long(M.ip_metrics(req, window=window, gap_ms=book.gaps(rule_type))),
             M.ip_block_counts(requests, window=window).select(
                 *M.WIN, F.lit("ip_block_access").alias("metric"), F.col("ip_block").alias("key"),
                 F.col("access_count").alias("value"))]
    if booking_events is not None:
        parts.append(catalogue_long(booking_metrics(booking_events, window),
                                    unpaid_bookings(booking_events, window)))
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p, allowMissingColumns=True)
    long = materialise(spark, long, f"{run_id}-metrics-long")          # lineage cut
    scores = flow_scores(evaluate_rules(long, book, rule_type))
    bl = to_blacklist_records(blacklist_decisions(scores), keep=["window_end"])
    at = F.to_timestamp(F.lit(written_at)) if written_at else F.col("window_end")
    write_hourly(bl.withColumn("_at", at).drop("window_end"), os.path.join(out_dir, "blacklist"), F.col("_at"), run_id)
    return spark.read.parquet(os.path.join(out_dir, "blacklist"))


def restore_job(spark: SparkSession, blacklist_path: str, now_ms: int,
                live_keys: DataFrame | None = None, enabled: bool = True) -> DataFrame | None:
    """3.3: latest unexpired record per key of those written in the current and previous hour
    (partition pruning), only for keys not already live. ``enabled`` is the guard flag."""
    if not enabled:
        return None
    recs = read_hours(spark, blacklist_path, hours_to_restore(now_ms)).select("key_exp_time", "key", "value")
    return restore(recs, F.lit(now_ms), live_keys)


def restore_into(spark: SparkSession, store: KeyedTable, blacklist_path: str, now_ms: int, run_id: str) -> None:
    """3.3 with IO17: the restored records are inserted into the live store where their key is not live; expired
    ones go from it."""
    found = restore_job(spark, blacklist_path, now_ms).select("key", "value", F.col("key_exp_time").alias("expires_at"))
    store.insert_absent(found, run_id, now_ms)
    store.compact(now_ms)


DASHBOARDS = {
    "funnel": "funnel", "funnel_by_class": "funnel_by_class", "funnel_scope": "funnel_scope",
    "scraper_travel_frequency": "scraper_travel_frequency",
    "scraper_route_ranking": "scraper_route_ranking",
    "hoarding_flight_ranking": "hoarding_flight_ranking", "look_to_book": "look_to_book",
    "user_class_counts": "user_class_counts", "customer_type_daily": "customer_type_daily", "traffic_share": "traffic_share",
    "scraper_daily_cumulative": "scraper_daily_cumulative", "link_traffic": "link_traffic",
}


def dashboards_job(spark: SparkSession, classified: DataFrame, out_dir: str,
                   run_id: str = "run") -> dict[str, str]:
    """V1-V16 together: the classified requests (scoring + class joins) are
    written once under the shared checkpoint folder, and every dashboard table
    is built from that written table. Returns table name -> output path."""
    from tollgate.operators import dashboards as D
    base = materialise(spark, classified, f"{run_id}-classified")
    out = {}
    for name, fn in DASHBOARDS.items():
        path = os.path.join(out_dir, name)
        getattr(D, fn)(base).write.mode("overwrite").parquet(path)
        out[name] = path
    spine = D.date_spine(base.filter("is_scraper").groupBy("day").agg(F.count(F.lit(1)).alias("scraper_requests")))
    spine.write.mode("overwrite").parquet(os.path.join(out_dir, "scraper_traffic_spine"))
    out["scraper_traffic_spine"] = os.path.join(out_dir, "scraper_traffic_spine")
    return out
