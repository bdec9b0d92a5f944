"""Streaming metrics job (W1-W4, A1-A8, B1-B4): record lines -> panes -> metrics -> scores -> blacklist.

The job is two queries on one stream of rows:

* *rows*: each batch of lines is parsed and flagged with the critical pages of that moment. Rows that are later
  than the watermark go to a side output and are counted, all others are handed over. Both queries
  take the same watermark of event time, so the second one drops nothing.
* *panes*: rows are aggregated in the state store into ``(pane, key, kind, value)`` with a count; panes are as wide
  as the greatest common divisor of window and slide. State holds the open panes only, and a row of it never grows: a
  value that rotates (cookies of a bot) makes more rows, spread by value. Closed panes are appended to a table,
  and the windows that they complete are computed from it by the batch operator (``sliding.py``): no
  row, value or critical second is copied into its windows.

A window is complete once a pane at or after its end has closed. The pane table keeps what open windows still
need; handed-over rows are deleted once they were read, and emptied folders with them, so no listing grows.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.codec import from_record_line
from tollgate.functions.text import ip_block, is_ipv4_shape, iso_to_ts, route
from tollgate.operators.blacklist import hours_to_restore, rank_latest, read_hours, to_blacklist_records, write_hourly
from tollgate.operators.filters import unexpired
from tollgate.operators.metrics import to_long
from tollgate.operators.scoring import RuleBook, blacklist_decisions, evaluate_rules, flow_scores
from tollgate.operators.sliding import duration_ms, pane_ms, windows_of
from tollgate.operators.tags import flag_critical
from tollgate.session import COUNT_STATE
from tollgate.streaming import storage
from tollgate.streaming.sources import METRICS_TRIGGER


def prepare(records: DataFrame, *, ts_col="ts", ip_col="remote_addr", critical_col="is_critical",
            ua_col="user_agent", session_col="session_id", dep_col="dep", arr_col="arr") -> DataFrame:
    return records.select(
        F.date_trunc("second", F.col(ts_col).cast("timestamp")).alias("ts"), F.col(ip_col).alias("ip"),
        F.coalesce(F.col(critical_col), F.lit(False)).alias("crit"),
        F.coalesce(F.col(ua_col), F.lit("")).alias("ua"), F.col(session_col).alias("sid"),
        route(F.coalesce(F.col(dep_col), F.lit("")), F.coalesce(F.col(arr_col), F.lit(""))).alias("rt"))


PANE_ROWS = "pane_start long, pane_end long, scope string, key string, kind string, value string, n long"
HOUR_MS = 3_600_000


def stream_panes(p: DataFrame, *, window: str = "5 minutes", slide: str = "5 seconds", watermark: str = "1 minute") -> DataFrame:
    """Input: ``prepare``d rows. Output (append mode): the closed panes, one row per (pane, scope, key, kind, value).

    ``scope`` is ``ip`` or ``block`` (A1: a /16 block, accesses only). Kinds are ``ua``, ``sid``, ``rt`` and ``hit``,
    whose value is the time of a critical hit or empty.
    """
    pane = f"{pane_ms(window, slide)} milliseconds"
    ip, second = F.col("ip"), F.when(F.col("crit"), F.unix_millis("ts").cast("string")).otherwise("")
    items = [(F.lit("ip"), ip, F.lit("hit"), second), (F.lit("ip"), ip, F.lit("ua"), F.col("ua")),
             (F.lit("ip"), ip, F.lit("sid"), F.col("sid")), (F.lit("ip"), ip, F.lit("rt"), F.col("rt")),
             (F.lit("block"), F.when(is_ipv4_shape(ip), ip_block(ip)), F.lit("hit"), F.lit(""))]
    each = F.filter(F.array(*[F.struct(*[c.alias(n) for c, n in zip(i, ("scope", "key", "kind", "value"))]) for i in items]),
                    lambda x: x["key"].isNotNull() & x["value"].isNotNull())
    rows = p.withWatermark("ts", watermark).select("ts", F.explode(each).alias("x")).select("ts", "x.*")
    by = ["scope", "key", "kind", "value"]
    panes = rows.groupBy(F.window("ts", pane).alias("pane"), *by).agg(F.count(F.lit(1)).alias("n"))
    return panes.select(F.unix_millis("pane.start").alias("pane_start"), F.unix_millis("pane.end").alias("pane_end"), *by, "n")


def window_metrics(panes: DataFrame, *, window: str = "5 minutes", slide: str = "5 seconds",
                   gap_ms: int | list[int] = 5000) -> DataFrame:
    """All windows that hold one of the ``panes``: one row per window, scope and key, wide."""
    gaps = {f"close_interval_count_{g}": g for g in gap_ms} if isinstance(gap_ms, list) else {"close_interval_count": gap_ms}
    key = F.struct("scope", "key").alias("ip")
    critical = F.col("value") != ""
    hits = panes.where("kind = 'hit'").select(
        key, F.when(critical, F.col("value").cast("bigint")).otherwise(F.col("pane_start")).alias("t"), "n",
        F.when(critical, F.col("n")).otherwise(F.lit(0)).alias("c"))
    values = panes.where("kind <> 'hit'").select(key, F.col("pane_start").alias("t"), "kind", F.col("value").alias("v"))
    m = windows_of(hits, values, window, slide, gaps)
    return m.select("window_start", "window_end", F.col("ip.scope").alias("scope"), F.col("ip.key").alias("key"),
                    *[c for c in m.columns if c not in ("window_start", "window_end", "ip")])


def metrics_to_long(m: DataFrame) -> DataFrame:
    """Closed windows (a table or batch of ``stream_key_metrics``) as long metrics, A1 included."""
    ips = to_long(m.filter("scope = 'ip'"), "key")
    blocks = m.filter("scope = 'block'").select("window_start", "window_end", F.lit("ip_block_access").alias("metric"), "key",
                                                F.col("access_count").alias("value"), F.lit(None).cast("double").alias("arg1"))
    return ips.unionByName(blocks)


# ---- the job ------------------------------------------------------------------------------

@dataclass
class Rules:
    """What the job reads anew in every batch."""

    critical_pages: DataFrame
    book: RuleBook


def _split_late(spark: SparkSession, rows: DataFrame, counts_dir: str, batch_id: int, pane: int, delay: int) -> tuple[DataFrame, int | None]:
    """``rows`` with ``is_late``, and the latest event time before this batch.

    A row is late if its pane has closed: the watermark is the latest time of earlier batches less the delay.
    """
    before = storage.batch_path(counts_dir, batch_id - 1)
    latest = spark.read.parquet(before).first()["latest"] if batch_id and storage.exists(spark, before) else None
    t = F.unix_millis("ts")
    ends = t - F.pmod(t, F.lit(pane)) + pane
    return rows.withColumn("is_late", F.lit(False) if latest is None else ends <= latest - delay), latest


def _drop_emptied(spark: SparkSession, path: str, group: int) -> None:
    """Remove the folders of earlier groups of batches whose files were all read and deleted."""
    for name in storage.folders(spark, path):
        if name.startswith("batch_group=") and storage.number_of(name) < group - 1 and not storage.has_files(spark, f"{path}/{name}"):
            storage.delete(spark, f"{path}/{name}")


def _prepare_batch(out_dir: str, loader: Callable[[SparkSession], Rules], pane: int, delay: int):
    rows_dir, late_dir, counts_dir = (os.path.join(out_dir, d) for d in ("rows", "late", "counts"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if storage.exists(spark, storage.batch_path(rows_dir, batch_id)):
            return                                        # a committed batch that is run again adds nothing
        rec = from_record_line(batch).withColumn("ts", iso_to_ts(F.col("time_iso8601")))
        rec = flag_critical(rec, loader(spark).critical_pages, "request")
        rows = prepare(rec, ua_col="http_user_agent", dep_col="dep_city", arr_col="arr_city").filter("ts is not null")
        rows, before = _split_late(spark, rows, counts_dir, batch_id, pane, delay)
        rows = rows.withColumns({"batch_group": F.lit(batch_id // storage.GROUP), "batch_id": F.lit(batch_id)}).persist()
        try:
            count = rows.agg(F.count_if(~F.col("is_late")).alias("on_time"), F.count_if("is_late").alias("late"),
                             F.greatest(F.unix_millis(F.max("ts")), F.lit(before).cast("bigint")).alias("latest"))
            for df, path in ((count.withColumns({"batch_group": F.lit(batch_id // storage.GROUP), "batch_id": F.lit(batch_id)}), counts_dir),
                             (rows.filter("is_late").drop("is_late"), late_dir), (rows.filter("NOT is_late").drop("is_late"), rows_dir)):
                (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("batch_group", "batch_id").parquet(path))
        finally:
            rows.unpersist()
        if batch_id % storage.GROUP == 0:
            _drop_emptied(spark, rows_dir, batch_id // storage.GROUP)
    return handle


def late_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """Rows on time and late per batch; together they are the rows read with a valid time."""
    return spark.read.parquet(os.path.join(out_dir, "counts")).select("batch_id", "on_time", "late")


def _frontier(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """Up to where panes had closed before this batch."""
    before = f"{path}/batch_id={batch_id - 1}"
    return spark.read.parquet(before).first()["upto"] if batch_id and storage.exists(spark, before) else None


def close_windows(spark: SparkSession, batch: DataFrame, batch_id: int, out_dir: str, *, window: str, slide: str,
                  gap_ms: int | list[int]) -> tuple[DataFrame | None, int | None]:
    """Append the closed panes of a batch; give the windows they complete, from the pane table, and up to where panes have closed.

    Everything is written by batch id, so a batch that is run again finds the same state and writes the same.
    """
    panes_dir, marks = os.path.join(out_dir, "panes"), os.path.join(out_dir, "frontier")
    width = duration_ms(window)
    hour = F.floor(F.col("pane_start") / HOUR_MS)
    before = _frontier(spark, marks, batch_id)
    newest = batch.agg(F.max("pane_end")).first()[0]
    upto = newest if before is None or (newest is not None and newest > before) else before
    done = None
    if newest is not None:
        # a backfill closes panes of many hours at once: a few files each
        (batch.withColumns({"pane_hour": hour, "batch_id": F.lit(batch_id)})
         .repartition("pane_hour", F.pmod(F.hash("key", "value"), F.lit(4))).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("pane_hour", "batch_id").parquet(panes_dir))
        known = spark.read.parquet(panes_dir).where(F.col("batch_id") <= batch_id)
        if before is not None:                            # panes of windows that end after the frontier
            known = known.where((F.col("pane_hour") >= (before - width) // HOUR_MS) & (F.col("pane_start") >= before - width))
        ends = F.unix_millis("window_end")
        done = window_metrics(known, window=window, slide=slide, gap_ms=gap_ms)
        done = done.where((ends <= upto) & (F.lit(True) if before is None else ends > before))
    return done, upto


def _forget(spark: SparkSession, out_dir: str, batch_id: int, upto: int | None, width: int) -> None:
    """Drop panes that no open window holds, and frontiers before the last."""
    panes_dir = os.path.join(out_dir, "panes")
    for name in storage.folders(spark, panes_dir) if upto is not None else []:
        if name.startswith("pane_hour=") and storage.number_of(name) < (upto - 2 * width) // HOUR_MS - 1:
            storage.delete(spark, f"{panes_dir}/{name}")
    storage.delete(spark, os.path.join(out_dir, "frontier", f"batch_id={batch_id - 2}"))


def _score_batch(out_dir: str, loader: Callable[[SparkSession], Rules], rule_type: int, window: str, slide: str, gap_ms: list[int]):
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            done, upto = close_windows(spark, batch, batch_id, out_dir, window=window, slide=slide, gap_ms=gap_ms)
        finally:
            batch.unpersist()
        if done is not None:
            metrics = os.path.join(out_dir, "metrics")
            (done.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(metrics))
            part = f"{metrics}/batch_id={batch_id}"
            if storage.exists(spark, part):
                closed = spark.read.parquet(part)
                scores = flow_scores(evaluate_rules(metrics_to_long(closed), loader(spark).book, rule_type))
                records = to_blacklist_records(blacklist_decisions(scores), keep=["window_end"])
                write_hourly(records, os.path.join(out_dir, "blacklist"), F.col("window_end"), f"stream-{batch_id}")
        spark.createDataFrame([(upto,)], "upto long").coalesce(1).write.mode("overwrite").parquet(
            os.path.join(out_dir, "frontier", f"batch_id={batch_id}"))
        _forget(spark, out_dir, batch_id, upto, duration_ms(window))
    return handle


ROWS = "ts timestamp, ip string, crit boolean, ua string, sid string, rt string, batch_group int, batch_id int"


def start_metrics(lines: DataFrame, out_dir: str, checkpoint: str, loader: Callable[[SparkSession], Rules], *,
                  window: str = "5 minutes", slide: str = "5 seconds", watermark: str = "1 minute",
                  rule_type: int = 0, trigger: dict | None = None, max_files_per_trigger: int | None = None):
    """Start the job on record lines; returns its two queries.

    The first flags critical pages with the rules of the batch and hands the rows on; the second
    closes panes, and scores each closed window with the rules of its batch. The
    gaps that close intervals are counted by are those of the rules at the start.
    """
    spark = lines.sparkSession
    rows_dir = os.path.join(out_dir, "rows")
    trigger = trigger or {"processingTime": METRICS_TRIGGER}
    first = (lines.writeStream.foreachBatch(_prepare_batch(out_dir, loader, pane_ms(window, slide), duration_ms(watermark)))
             .option("checkpointLocation", os.path.join(checkpoint, "rows")).trigger(**trigger).start())
    # files are deleted once the batch that read them is committed
    source = spark.readStream.schema(ROWS).option("cleanSource", "delete")
    if max_files_per_trigger:
        source = source.option("maxFilesPerTrigger", max_files_per_trigger)
    if trigger.get("availableNow"):
        first.awaitTermination()
    second = start_scores(source.parquet(rows_dir), out_dir, os.path.join(checkpoint, "scores"), loader, window=window, slide=slide,
                          watermark=watermark, rule_type=rule_type, trigger=trigger)
    return first, second


def start_scores(rows: DataFrame, out_dir: str, checkpoint: str, loader: Callable[[SparkSession], Rules], *, window: str = "5 minutes",
                 slide: str = "5 seconds", watermark: str = "1 minute", rule_type: int = 0, trigger: dict | None = None):
    """The second query on a stream of ``prepare``d rows: panes, closed windows (``metrics``), scores, ``blacklist``.

    Its progress does not count all state rows, unless the session asks for it (``COUNT_STATE``).
    """
    spark = rows.sparkSession
    panes = stream_panes(rows, window=window, slide=slide, watermark=watermark)
    handler = _score_batch(out_dir, loader, rule_type, window, slide, loader(spark).book.gaps(rule_type))
    query = (panes.writeStream.outputMode("append").foreachBatch(handler).option("checkpointLocation", checkpoint)
             .trigger(**(trigger or {"processingTime": METRICS_TRIGGER})))
    own = spark.conf.get(COUNT_STATE, None)
    spark.conf.set(COUNT_STATE, own or "false")
    try:
        return query.start()                              # takes a copy of the session's settings
    finally:
        if own is None:
            spark.conf.unset(COUNT_STATE)


def blacklisted_ips(spark: SparkSession, path: str, now_ms: int) -> DataFrame:
    """The keys whose latest record, of those written in the current and previous hour, still
    lives; given to the pre-process job as (more) black IPs, it tags their requests. No table yet: none."""
    records = rank_latest(read_hours(spark, path, hours_to_restore(now_ms)))
    return unexpired(records, F.lit(now_ms)).select(F.col("key").alias("ip_name")).distinct()


def stream_booking_metrics(events: DataFrame, *, window: str = "1 hour",
                           watermark: str = "1 hour") -> DataFrame:
    """§2.11 near-real-time catalogue on a stream: bookings / payments /
    cancellations per (window, key kind, key), append mode."""
    from tollgate.operators.catalogue import key_kinds
    kinds = F.explode(F.array(*[F.struct(F.lit(n).alias("key_kind"), v.alias("key"))
                                for n, v in key_kinds().items()]))
    k = events.withWatermark("ts", watermark).select("ts", "step", kinds.alias("_k")) \
              .select("ts", "step", "_k.key_kind", "_k.key")
    return (k.groupBy(F.window("ts", window).alias("w"), "key_kind", "key")
             .agg(F.count_if(F.col("step") == "book").cast("bigint").alias("bookings"),
                  F.count_if(F.col("step") == "pay").cast("bigint").alias("payments"),
                  F.count_if(F.col("step") == "cancel").cast("bigint").alias("cancellations"))
             .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                     "key_kind", "key", "bookings", "payments", "cancellations"))


def stream_unpaid_bookings(events: DataFrame, *, window: str = "1 day",
                           watermark: str = "1 day") -> DataFrame:
    """Booked-not-paid on a stream. ``left_anti`` is refused between streams, so:
    left outer join of bookings with payments of the same order inside the
    booking's window (time-bounded, so state is purged by the watermarks), keep
    the unmatched, count per key (append mode, emitted once the window closes)."""
    from tollgate.operators.catalogue import key_kinds
    ev = events.withWatermark("ts", watermark)
    w = F.window("ts", window)
    books = ev.filter(F.col("step") == "book").select(
        "*", w.start.alias("window_start")).withColumn(
        "window_end", F.col("window_start") + F.expr(f"INTERVAL {window}"))
    pays = ev.filter(F.col("step") == "pay").select(F.col("order_key").alias("p_order_key"),
                                                    F.col("ts").alias("pay_ts"))
    j = books.join(pays, F.expr("p_order_key = order_key AND pay_ts >= window_start "
                                f"AND pay_ts < window_end AND pay_ts >= ts - INTERVAL {window} "
                                f"AND pay_ts <= ts + INTERVAL {window}"), "leftOuter")
    unpaid = j.filter(F.col("pay_ts").isNull())
    kinds = F.explode(F.array(*[F.struct(F.lit(n).alias("key_kind"), v.alias("key"))
                                for n, v in key_kinds().items()]))
    k = unpaid.select("ts", "window_start", "window_end", kinds.alias("_k")) \
              .select("ts", "window_start", "window_end", "_k.key_kind", "_k.key")
    return (k.groupBy(F.window("ts", window).alias("w"), "key_kind", "key")
             .agg(F.count(F.lit(1)).alias("unpaid"))
             .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                     "key_kind", "key", "unpaid"))
