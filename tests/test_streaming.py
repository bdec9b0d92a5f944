"""Stream == batch: the streaming jobs reproduce the batch operators."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from table_dirs import SF_SMALL
from tollgate.operators import metrics as M
from tollgate.plans.preprocess import Dimensions, process_messages, requests_as_messages, structured
from tollgate.plans.registry import tagged_requests
from tollgate.session import scratch_path
from tollgate.sources import dimensions as dim
from tollgate.sources.requests import raw_lines
from tollgate.streaming import metrics_job as SM
from tollgate.streaming import storage
from tollgate.streaming.keyed_table import AppendedTable, KeyedTable
from tollgate.streaming.monitor import ProgressTable, compact_history, batch_summary, mean_latency_by_tier, progress_frame
from tollgate.streaming.preprocess_job import start_preprocess


def _dir(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


@pytest.mark.parametrize("window, slide", [("1 hour", "10 minutes"), ("1 hour", "25 minutes"), ("1 day", "1 day")])
def test_stream_metrics_equal_batch(spark, window, slide):
    base = _dir(spark, "stream-metrics")
    req = tagged_requests(spark, SF_SMALL)
    prepared = SM.prepare(req)
    prepared.coalesce(1).write.parquet(os.path.join(base, "in", "a"))
    # far-future rows: the first closes every pane, the second the first one's, which completes every window
    for name, year in (("b", 2030), ("c", 2031)):
        sentinel = prepared.limit(1).withColumn("ts", F.to_timestamp(F.lit(f"{year}-01-01 00:00:00"))).withColumn("ip", F.lit("sentinel"))
        sentinel.coalesce(1).write.parquet(os.path.join(base, "in", name))
    src = (spark.readStream.format("parquet").schema(prepared.schema).option("maxFilesPerTrigger", 1)
           .load(os.path.join(base, "in", "*")))
    out_dir = os.path.join(base, "out")

    def handle(batch, batch_id):
        done, upto = SM.close_windows(spark, batch, batch_id, out_dir, window=window, slide=slide, gap_ms=600_000)
        if done is not None:
            done.write.mode("overwrite").parquet(os.path.join(out_dir, "closed", str(batch_id)))
        spark.createDataFrame([(upto,)], "upto long").write.mode("overwrite").parquet(
            os.path.join(out_dir, "frontier", f"batch_id={batch_id}"))
    q = (SM.stream_panes(src, window=window, slide=slide, watermark="0 seconds").writeStream.outputMode("append").foreachBatch(handle)
         .option("checkpointLocation", os.path.join(base, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(os.path.join(out_dir, "closed", "*")).filter("scope = 'ip'").withColumnRenamed("key", "ip") \
        .filter(F.col("ip") != "sentinel")
    # state rows are (pane, value) pairs of open panes; a window has none
    most = max(p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators)
    pane = SM.pane_ms(window, slide)
    panes = prepared.withColumn("pane", F.floor(F.unix_millis("ts") / pane))
    hits = F.when(F.col("crit"), F.unix_millis("ts")).otherwise(-1)
    states = sum(panes.select("pane", "ip", c.alias("v")).where("v IS NOT NULL").distinct().count() for c in (hits, F.col("ua"), F.col("sid"), F.col("rt")))
    blocks = panes.select("pane", F.substring_index("ip", ".", 2)).distinct().count()
    assert most <= states + blocks + 5
    exp = M.ip_metrics(req, window=window, slide=slide, gap_ms=600_000)
    cols = ["window_start", "ip", *M.WIDE_METRICS]
    g = sorted(tuple(r) for r in got.select(*cols).collect())
    e = sorted(tuple(r) for r in exp.select(*cols).collect())
    assert len(g) == len(e) and g == e


def _lines_to_text(df, path):
    df.select("value").coalesce(1).write.text(path)


def test_preprocess_stream_equals_batch_and_refreshes_dims(spark):
    base = _dir(spark, "stream-pre")
    req = tagged_requests(spark, SF_SMALL)
    lines = raw_lines(req)
    first, second = lines.filter(F.col("event_id") % 2 == 0), lines.filter(F.col("event_id") % 2 == 1)
    _lines_to_text(first, os.path.join(base, "in", "1"))
    black_dir = os.path.join(base, "black")
    spark.createDataFrame([("10.4.4.4",)], "ip_name string").write.parquet(os.path.join(black_dir, "v1"))

    def loader(s):
        d = Dimensions.defaults(s)
        d.black_ips = s.read.parquet(os.path.join(black_dir, "*"))   # re-read per batch
        return d

    src = spark.readStream.format("text").load(os.path.join(base, "in", "*"))
    out_dir, ck = os.path.join(base, "out"), os.path.join(base, "ckpt")
    start_preprocess(src, out_dir, ck, loader, trigger={"availableNow": True}).awaitTermination()
    # a new black IP arrives between triggers, then more lines
    hot = req.groupBy("remote_addr").count().orderBy(F.desc("count"), "remote_addr").first()["remote_addr"]
    spark.createDataFrame([(hot,)], "ip_name string").write.parquet(os.path.join(black_dir, "v2"))
    _lines_to_text(second, os.path.join(base, "in", "2"))
    src = spark.readStream.format("text").load(os.path.join(base, "in", "*"))
    start_preprocess(src, out_dir, ck, loader, trigger={"availableNow": True}).awaitTermination()

    rec = spark.read.parquet(os.path.join(out_dir, "records"))
    assert sorted(r.batch_id for r in rec.select("batch_id").distinct().collect()) == [0, 1]
    # batch 0 ran before the refresh, batch 1 after it
    flags = {(r.batch_id, r.high_freq_ip) for r in
             rec.filter(F.col("remote_addr") == hot).select("batch_id", "high_freq_ip").distinct().collect()}
    assert (0, False) in flags and (1, True) in flags
    # same rows as the batch pipeline (black IP flag aside)
    from tollgate.plans.preprocess import ingest_lines
    ok, _ = ingest_lines(lines)
    exp = structured(process_messages(ok, Dimensions.defaults(spark)))
    key = ["request", "remote_addr", "time_iso8601", "behavior_type", "travel_type", "session_id"]
    e = sorted(tuple(r) for r in exp.filter(F.col("behavior_type") != "Other").select(*key).collect())
    g = sorted(tuple(r) for r in rec.select(*key).collect())
    assert g == e
    rej = spark.read.parquet(os.path.join(out_dir, "rejects"))
    assert rej.count() == ingest_lines(lines)[1].count()
    mon = KeyedTable(spark, os.path.join(out_dir, "monitor")).read()
    assert mon.count() == 2 and mon.first()["value"].startswith('{"servers_count"')


def test_stream_booking_catalogue_equals_batch(spark):
    from tollgate.operators.catalogue import booking_metrics, unpaid_bookings
    from tollgate.sources.bookings import booking_events, bookings
    base = _dir(spark, "stream-book")
    ev = booking_events(bookings(spark, SF_SMALL))
    ev.coalesce(1).write.parquet(os.path.join(base, "in", "a"))
    ev.limit(1).withColumn("ts", F.to_timestamp(F.lit("2030-01-01"))).coalesce(1) \
      .write.parquet(os.path.join(base, "in", "b"))

    def run(df, name):
        q = (df.writeStream.format("memory").queryName(name).outputMode("append")
             .option("checkpointLocation", os.path.join(base, "ck-" + name))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        return spark.table(name).filter(F.year("window_start") < 2030)

    def src():
        return (spark.readStream.format("parquet").schema(ev.schema).option("maxFilesPerTrigger", 1)
                .load(os.path.join(base, "in", "*")))
    tag = uuid.uuid4().hex[:6]
    got_m = run(SM.stream_booking_metrics(src(), window="1 day", watermark="0 seconds"), "bm" + tag)
    got_u = run(SM.stream_unpaid_bookings(src(), window="1 day", watermark="0 seconds"), "ub" + tag)
    exp_m = booking_metrics(ev, "1 day")
    exp_u = unpaid_bookings(ev, "1 day")
    cm = ["window_start", "key_kind", "key", "bookings", "payments", "cancellations"]
    assert sorted(map(tuple, got_m.select(*cm).collect())) == sorted(map(tuple, exp_m.select(*cm).collect()))
    cu = ["window_start", "key_kind", "key", "unpaid"]
    assert sorted(map(tuple, got_u.select(*cu).collect())) == sorted(map(tuple, exp_u.select(*cu).collect()))


def test_console_banner_only_for_non_empty_batches(spark, capsys):
    from tollgate.streaming.preprocess_job import make_batch_handler
    base = _dir(spark, "console")
    lines = raw_lines(tagged_requests(spark, SF_SMALL)).select("value")
    handler = make_batch_handler(base, Dimensions.defaults, console=True)
    handler(lines.limit(50), 0)
    handler(lines.limit(0), 1)
    out = capsys.readouterr().out
    assert "batch 0 at" in out and "batch 1 at" not in out


def test_both_jobs_on_files_equal_the_batch_plan(spark):
    """Raw lines -> records -> metrics -> blacklist, and the blacklist back as black IPs."""
    from tollgate.functions.codec import to_record_line
    from tollgate.operators.blacklist import to_blacklist_records
    from tollgate.operators.scoring import RuleBook, blacklist_decisions, evaluate_rules, flow_scores
    from tollgate.operators.tags import flag_critical
    from tollgate.plans.preprocess import ingest_lines
    base = _dir(spark, "both-jobs")
    lines = raw_lines(tagged_requests(spark, SF_SMALL)).select("value")
    _lines_to_text(lines, os.path.join(base, "in", "1"))
    dims = Dimensions.defaults(spark)
    src = spark.readStream.format("text").load(os.path.join(base, "in", "*"))
    start_preprocess(src, os.path.join(base, "pre"), os.path.join(base, "ck1"), trigger={"availableNow": True}).awaitTermination()
    rec = spark.read.parquet(os.path.join(base, "pre", "records"))
    rec.select(to_record_line(rec).alias("value")).coalesce(1).write.text(os.path.join(base, "rec", "1"))
    # far-future records in batches of their own complete every window
    for k, year in ((2, 2030), (3, 2031)):
        rec.limit(1).withColumn("time_iso8601", F.lit(f"{year}-01-01T00:00:00+00:00")).transform(
            lambda d: d.select(to_record_line(d).alias("value"))).coalesce(1).write.text(os.path.join(base, "rec", str(k)))

    def loader(s):
        low = [(1, 1, "ip_access", 2, 0, 0, 2.0, None, 5), (2, 1, "critical_close_intervals", 2, 0, 0, 1.0, 3.6e6, 4),
               (3, 1, "critical_close_intervals", 2, 0, 0, 1.0, 3.6e7, 2), (4, 1, "ip_block_access", 2, 0, 0, 4.0, None, 7)]
        flows, strategies = ((1, "default", 0),), ((1, 6.0, 5.0),)
        return SM.Rules(dim.critical_page_rules(s), RuleBook.load(
            s.createDataFrame(flows, dim.FLOW_SCHEMA), s.createDataFrame(strategies, dim.STRATEGY_SCHEMA),
            s.createDataFrame(low, dim.SCORE_RULE_SCHEMA), dim.maintenance(s)))
    source = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(os.path.join(base, "rec", "*"))
    out = os.path.join(base, "metrics-out")
    for _ in range(2):                                      # the second start finds nothing new
        queries = SM.start_metrics(source, out, os.path.join(base, "ck2"), loader, window="1 day", slide="1 day", rule_type=2,
                                   watermark="0 seconds", trigger={"availableNow": True}, max_files_per_trigger=1)
        for q in queries:
            q.awaitTermination()
    got = spark.read.parquet(os.path.join(out, "blacklist")).where("value LIKE '%score%' AND key_exp_time < 1893456000000")

    ok, _ = ingest_lines(lines)
    plain = structured(process_messages(ok, dims)).filter(F.col("behavior_type") != "Other")
    r = flag_critical(plain, dim.critical_page_rules(spark), "request").withColumn("ts", F.to_timestamp("time_iso8601"))
    book = loader(spark).book
    wide = M.ip_metrics(r, window="1 day", gap_ms=book.gaps(2), ua_col="http_user_agent",
                        dep_col="dep_city", arr_col="arr_city")
    blocks = M.ip_block_counts(r, window="1 day").select(*M.WIN, F.lit("ip_block_access").alias("metric"),
                                                         F.col("ip_block").alias("key"), F.col("access_count").alias("value"))
    long = M.to_long(wide).unionByName(blocks, allowMissingColumns=True)
    exp = to_blacklist_records(blacklist_decisions(flow_scores(evaluate_rules(long, book, 2))))
    cols = ["key_exp_time", "key", "value"]
    e = sorted(map(tuple, exp.select(*cols).collect()))
    assert e and sorted(map(tuple, got.select(*cols).collect())) == e

    now = e[0][0] - 50 * 60_000
    black = SM.blacklisted_ips(spark, os.path.join(out, "blacklist"), now)
    want = {k for x, k, _ in e if x - 3_600_000 <= now < x}
    assert {r.ip_name for r in black.collect()} == want
    dims.black_ips = black
    tagged = process_messages(ok, dims)
    assert {r.remote_addr for r in tagged.filter("high_freq_ip").select("remote_addr").distinct().collect()} <= want


def test_progress_history_keeps_every_batch(spark):
    """More batches than the engine remembers (100 by default; 5 here)."""
    base = _dir(spark, "progress")
    for i in range(8):
        spark.range(3).coalesce(1).write.parquet(os.path.join(base, "in", str(i)))
    listener = ProgressTable(spark, os.path.join(base, "history"), {"tiny": "real_time"})
    spark.streams.addListener(listener)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        src = (spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "in", "*")))
        q = (src.writeStream.format("noop").queryName("tiny").option("checkpointLocation", os.path.join(base, "ck"))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        assert len(q.recentProgress) <= 5
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
        spark.streams.removeListener(listener)
    prog = progress_frame(spark, os.path.join(base, "history"))
    assert batch_summary(prog).first()["rows"] == 24
    assert prog.filter("num_input_rows > 0").count() == 8
    assert [r.tier for r in mean_latency_by_tier(prog).collect()] == ["real_time"]
    before = sorted(map(tuple, prog.collect()))
    days = storage.folders(spark, os.path.join(base, "history"))
    for _ in range(2):                                      # compacting again changes nothing
        compact_history(spark, os.path.join(base, "history"))
        assert sorted(map(tuple, progress_frame(spark, os.path.join(base, "history")).collect())) == before
        assert all(storage.folders(spark, os.path.join(base, "history", d, "runs")) == [] for d in days)
    assert len(progress_frame(spark, os.path.join(base, "history")).inputFiles()) == len(days)


def records(spark, rows):
    """Record lines (remote_addr, time) of query requests to a critical page."""
    from tollgate.functions.codec import to_record_line
    req = structured(process_messages(requests_as_messages(tagged_requests(spark, SF_SMALL)), Dimensions.defaults(spark)))
    one = req.filter("behavior_type = 'Query'").orderBy("event_id").limit(1).drop("event_id", "remote_addr", "time_iso8601")
    new = spark.createDataFrame(rows, "remote_addr string, time_iso8601 string")
    full = one.crossJoin(new).select(*[c for c in req.columns if c != "event_id"])
    return full.select(to_record_line(full).alias("value"))


def loader_of(threshold):
    def loader(s):
        rules = s.createDataFrame([(1, 1, "ip_access", 0, 0, 0, 3.0, None, 9)], dim.SCORE_RULE_SCHEMA)
        from tollgate.operators.scoring import RuleBook
        return SM.Rules(dim.critical_page_rules(s), RuleBook.load(
            s.createDataFrame([(1, "default", 0)], dim.FLOW_SCHEMA), s.createDataFrame([(1, threshold, 5.0)], dim.STRATEGY_SCHEMA),
            rules, dim.maintenance(s)))
    return loader


def run_metrics(spark, base, **how):
    source = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(os.path.join(base, "rec", "*"))
    queries = SM.start_metrics(source, os.path.join(base, "out"), os.path.join(base, "ck"), loader_of(5.0), trigger={"availableNow": True},
                               max_files_per_trigger=1, **how)
    for q in queries:
        q.awaitTermination()
    return queries


def test_late_rows_are_counted_and_add_up_to_the_input(spark):
    base = _dir(spark, "late-rows")
    batches = [[("1.1.1.1", f"2024-01-01T10:00:{k:02d}+00:00") for k in range(10)],
               [("1.1.1.1", "2024-01-01T12:00:00+00:00")],
               [("2.2.2.2", "2024-01-01T09:00:00+00:00"), ("2.2.2.2", "2024-01-01T11:59:30+00:00"), ("3.3.3.3", "2024-01-01T12:00:01+00:00")],
               [("9.9.9.9", "2025-01-01T00:00:00+00:00")], [("9.9.9.9", "2026-01-01T00:00:00+00:00"), ("1.1.1.1", "2024-06-01T00:00:00+00:00")]]
    for k, rows in enumerate(batches):
        records(spark, rows).coalesce(1).write.text(os.path.join(base, "rec", str(k)))
        run_metrics(spark, base, window="5 minutes", slide="1 minute", watermark="1 minute")
    counts = {r.batch_id: (r.on_time, r.late) for r in SM.late_counts(spark, os.path.join(base, "out")).collect()}
    assert counts == {0: (10, 0), 1: (1, 0), 2: (2, 1), 3: (1, 0), 4: (1, 1)}
    assert sum(a + b for a, b in counts.values()) == sum(map(len, batches))
    late = spark.read.parquet(os.path.join(base, "out", "late")).collect()
    assert sorted((r.ip, r.ts.year, r.ts.month) for r in late) == [("1.1.1.1", 2024, 6), ("2.2.2.2", 2024, 1)]
    closed = spark.read.parquet(os.path.join(base, "out", "metrics")).where("scope = 'ip' AND key < '9'")
    per_window = closed.groupBy("key").agg(F.sum("access_count").alias("n")).collect()
    assert {r.key: r.n for r in per_window} == {"1.1.1.1": 55, "2.2.2.2": 5, "3.3.3.3": 5}    # 5 windows a row: none dropped


def test_handed_over_rows_leave_the_listing_and_none_is_lost(spark, monkeypatch):
    base = _dir(spark, "hand-over")
    monkeypatch.setattr(storage, "GROUP", 1)
    times = [f"2024-01-01T{h:02d}:00:00+00:00" for h in range(5)]
    seen = []
    for k, t in enumerate(times + ["2025-01-01T00:00:00+00:00", "2026-01-01T00:00:00+00:00"]):
        records(spark, [("1.1.1.1", t), ("2.2.2.2", t)]).coalesce(1).write.text(os.path.join(base, "rec", str(k)))
        run_metrics(spark, base, window="5 minutes", slide="5 minutes", watermark="1 minute")      # each time a restart
        seen.append(len(storage.folders(spark, os.path.join(base, "out", "rows"))))
    assert seen[-1] <= 4, seen                                      # without cleaning there would be a folder per batch: 7
    closed = spark.read.parquet(os.path.join(base, "out", "metrics")).where("scope = 'ip' AND window_start < '2025-01-01'")
    assert closed.agg(F.sum("access_count")).first()[0] == 10
    assert len(storage.folders(spark, os.path.join(base, "out", "panes"))) <= 4
    assert len(storage.folders(spark, os.path.join(base, "out", "frontier"))) <= 2


def test_a_blacklisted_ip_is_flagged_from_the_next_trigger_on(spark):
    """Closed loop: pre-process -> records -> metrics -> blacklist -> pre-process."""
    base = _dir(spark, "loop")
    lines = raw_lines(tagged_requests(spark, SF_SMALL).filter("flight_type = 'National'"))
    hot = lines.groupBy(F.split("value", "#CS#")[6].alias("ip")).count().orderBy(F.desc("count")).first()["ip"]
    blacklist = os.path.join(base, "out", "blacklist")
    now = [1_704_100_000_000]

    def preprocess(k):
        lines.select("value").coalesce(1).write.text(os.path.join(base, "in", str(k)))
        src = spark.readStream.format("text").load(os.path.join(base, "in", "*"))
        start_preprocess(src, os.path.join(base, "pre"), os.path.join(base, "ck-pre"), trigger={"availableNow": True},
                         blacklist=blacklist, clock_ms=lambda: now[0]).awaitTermination()
    preprocess(0)                                                   # there is no blacklist yet
    rec = spark.read.parquet(os.path.join(base, "pre", "records"))
    ip = rec.groupBy("remote_addr").count().orderBy(F.desc("count"), "remote_addr").first()["remote_addr"]
    records(spark, [(ip, f"2024-01-01T10:00:{k:02d}+00:00") for k in range(20)]).coalesce(1).write.text(os.path.join(base, "rec", "0"))
    for k, year in ((1, 2025), (2, 2026)):
        records(spark, [("9.9.9.9", f"{year}-01-01T00:00:00+00:00")]).coalesce(1).write.text(os.path.join(base, "rec", str(k)))
    run_metrics(spark, base, window="5 minutes", slide="5 minutes", watermark="1 minute")
    black = spark.read.parquet(blacklist).where(F.col("key") == ip).collect()
    assert black and hot
    now[0] = black[0].key_exp_time - 1_800_000
    preprocess(1)
    rec = spark.read.parquet(os.path.join(base, "pre", "records")).where(F.col("remote_addr") == ip)
    flags = {(r.batch_id, r.high_freq_ip) for r in rec.select("batch_id", "high_freq_ip").distinct().collect()}
    assert flags == {(0, False), (1, True)}


def test_keyed_table_inserts_absent_keys_and_forgets_expired_ones(spark):
    t = KeyedTable(spark, _dir(spark, "keyed"))
    rows = lambda *r: spark.createDataFrame(list(r), "key string, value string, expires_at long")
    live = lambda now: sorted(map(tuple, t.live(now).collect()))
    assert live(0) == []
    t.insert_absent(rows(("a", "1", 100), ("b", "1", 500), ("b", "2", 400), ("x", "gone", 5), (None, "n", 900)), "r1", now_ms=10)
    t.insert_absent(rows(("a", "2", 300), ("b", "9", 900), ("c", "1", 50)), "r2", now_ms=20)      # a and b are live
    assert live(20) == [("a", "1", 100), ("b", "1", 500), ("c", "1", 50)]
    t.insert_absent(rows(("a", "2", 300), ("b", "9", 900), ("c", "1", 50)), "r2", now_ms=20)      # repeated: the same
    assert live(20) == [("a", "1", 100), ("b", "1", 500), ("c", "1", 50)]
    t.compact(60)
    assert live(60) == [("a", "1", 100), ("b", "1", 500)] and t.read().count() == 2 and len(t.read().inputFiles()) == 1
    t.insert_absent(rows(("c", "new", 800), ("a", "late", 700)), "r3", now_ms=150)                # both have expired by now
    assert live(150) == [("a", "late", 700), ("b", "1", 500), ("c", "new", 800)]
    t.compact(150)
    t.insert_absent(rows(("z", "again", 999)), "r3", now_ms=150)                                  # r3 is done
    assert live(150) == [("a", "late", 700), ("b", "1", 500), ("c", "new", 800)]


def test_an_interrupted_compaction_changes_nothing(spark):
    t = AppendedTable(spark, _dir(spark, "interrupted"), "key string")
    one = lambda k: spark.createDataFrame([(k,)], "key string")
    t.append(one("a"), "r1")
    t.append(one("b"), "r2")
    one("half").write.parquet(f"{t.path}/base/v=7/rows")                                         # no list of runs: not finished
    assert sorted(r.key for r in t.read().collect()) == ["a", "b"]
    t.rewrite(t.read())
    t.append(one("c"), "r3")
    assert sorted(r.key for r in t.read().collect()) == ["a", "b", "c"]
    assert storage.folders(spark, f"{t.path}/base") == ["v=8"] and storage.folders(spark, f"{t.path}/runs") == ["r3"]


def test_restore_inserts_into_the_live_store(spark):
    from tollgate.operators.blacklist import write_hourly
    from tollgate.plans.jobs import restore_into
    base = _dir(spark, "restore-into")
    now = 1_704_103_800_000                                                                       # 2024-01-01 10:10
    written = spark.createDataFrame([("a", now + 50_000, "new"), ("a", now + 40_000, "old"), ("b", now + 60_000, "x"), ("c", now - 5, "gone")],
                                    "key string, key_exp_time long, value string")
    write_hourly(written.withColumn("at", F.timestamp_millis(F.lit(now))), os.path.join(base, "bl"), F.col("at"), "run")
    store = KeyedTable(spark, os.path.join(base, "live"))
    store.put(spark.createDataFrame([("b", "live already", now + 9_000)], "key string, value string, expires_at long"), "first")
    for run in ("restore-1", "restore-2"):
        restore_into(spark, store, os.path.join(base, "bl"), now, run)
        assert sorted(map(tuple, store.live(now).collect())) == [("a", "new", now + 50_000), ("b", "live already", now + 9_000)]
    assert store.read().count() == 2


def test_kafka_options(spark):
    """No connector here: the options that reach the reader (start, resume by checkpoint, rate cap)."""
    from tollgate.streaming.sources import MAX_RECORDS_PER_PARTITION_PER_S, kafka_lines
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def option(self, key, value):
            seen[key] = value
            return self

        def load(self):
            return self

        def select(self, column):
            return column

    class Session:
        readStream = Reader()
    kafka_lines(Session(), "host:1", "logs", partitions=4, trigger="3 seconds")
    assert seen == {"format": "kafka", "kafka.bootstrap.servers": "host:1", "subscribe": "logs", "startingOffsets": "latest",
                    "maxOffsetsPerTrigger": str(MAX_RECORDS_PER_PARTITION_PER_S * 4 * 3)}
    seen.clear()
    kafka_lines(Session(), "host:1", "logs", starting_offsets="earliest")
    assert "maxOffsetsPerTrigger" not in seen and seen["startingOffsets"] == "earliest"
