"""Hand-made edge rows for the metrics (FIXTURES §5) and property checks."""

import os
import uuid

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tollgate.operators import metrics as M
from tollgate.operators.filters import field_count
from tollgate.operators.tags import flag_critical
from tollgate.session import scratch_path
from tollgate.sources import dimensions as dim

Q = "/shop/query/jaxb/direct/query.ao?c1=A"     # matches two critical rules
V = "/shop/modules/main/flightSelect.html"       # not critical


def edge_rows(spark):
    rows = [
        # ip, ts, url, ua, session, dep, arr
        ("1.1.1.1", "2024-01-01 00:00:00", Q, "u1", "s1", "A", "B"),
        ("1.1.1.1", "2024-01-01 00:00:00", Q, "u2", "s1", "A", "B"),   # same second -> gap 0
        ("1.1.1.1", "2024-01-01 00:00:05", Q, "u1", "s2", "A", "C"),   # gap exactly 5000 (not close)
        ("1.1.1.1", "2024-01-01 00:00:09", Q, None, "s2", "A", "C"),   # gap 4000 (close), UA NULL -> ''
        ("2.2.2.2", "2024-01-01 00:00:00", Q, "u1", "s3", "A", "B"),   # single hit -> -1
        ("2.2.2.2", "2024-01-01 00:10:00", V, "u1", "s3", "A", "B"),
        ("3.3.3.3", "2024-01-01 00:00:00", V, "u1", "s4", "A", "B"),   # no critical hit
        ("1.2.3", "2024-01-01 00:00:00", V, "u1", "s5", "A", "B"),     # 3-part IP
        ("fe80::1", "2024-01-01 00:00:00", V, "u1", "s6", "A", "B"),   # IPv6
    ]
    df = spark.createDataFrame(rows, "remote_addr string, ts string, url string, user_agent string, "
                                     "session_id string, dep string, arr string")
    df = df.withColumn("ts", F.to_timestamp("ts"))
    return flag_critical(df, dim.critical_page_rules(spark))


def test_metric_edge_rows(spark):
    m = {r.ip: r for r in M.ip_metrics(edge_rows(spark), gap_ms=5000).collect()}
    a = m["1.1.1.1"]
    assert (a.access_count, a.critical_count) == (4, 4)        # two matching rules count once
    assert a.min_interval_ms == 0 and a.close_interval_count == 2
    assert a.user_agent_count == 3 and a.cookie_count == 2 and a.route_count == 2
    b = m["2.2.2.2"]
    assert (b.critical_count, b.min_interval_ms, b.close_interval_count) == (1, -1, 0)
    c = m["3.3.3.3"]
    assert c.critical_count == 0 and c.min_interval_ms is None and c.close_interval_count is None
    blocks = {r.ip_block: r.access_count for r in M.ip_block_counts(edge_rows(spark)).collect()}
    assert blocks == {"1.1": 4, "2.2": 2, "3.3": 1}


def test_metrics_invariant_under_reorder(spark):
    from table_dirs import SF_SMALL
    from tollgate.plans.registry import tagged_requests
    r = tagged_requests(spark, SF_SMALL)
    shuffled = r.repartition(7, F.rand(3)).sortWithinPartitions(F.rand(5))
    a = M.ip_metrics(r, window="1 day", gap_ms=3_600_000)
    b = M.ip_metrics(shuffled, window="1 day", gap_ms=3_600_000)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    la = M.link_counts(r, window="1 day")
    lb = M.link_counts(shuffled, window="1 day")
    assert sorted(map(tuple, la.collect())) == sorted(map(tuple, lb.collect()))


def test_gap_metrics_share_the_counts_aggregation(spark):
    """No join or second grouping over a task's sorted hits: their memory adds up in one task."""
    from test_plans import plan_of
    rows = [(ip, f"2024-01-01 {t}", True, "u", "s", "A", "B") for ip, t in [
        ("1.1.1.1", "00:00:00"), ("1.1.1.1", "00:00:00"), ("1.1.1.1", "00:00:07"), ("1.1.1.1", "01:00:00"),
        (None, "00:00:01"), (None, "00:00:02")]] + [("2.2.2.2", "2024-01-01 00:00:05", False, "u", "s", "A", "B"),
                                                    ("3.3.3.3", None, True, "u", "s", "A", "B")]
    df = spark.createDataFrame(rows, "remote_addr string, ts string, is_critical boolean, user_agent string, "
                                     "session_id string, dep string, arr string").withColumn("ts", F.to_timestamp("ts"))
    m = M.ip_metrics(df, window="1 hour", gap_ms=[5_000, 600_000])
    got = {(r.ip, r.hour): tuple(r)[3:-1] for r in m.withColumn("hour", F.hour("window_start")).collect()}
    assert got == {("1.1.1.1", 0): (3, 3, 1, 1, 1, 0, 1, 2), ("1.1.1.1", 1): (1, 1, 1, 1, 1, -1, 0, 0),
                   (None, 0): (2, 2, 1, 1, 1, None, None, None), ("2.2.2.2", 0): (1, 0, 1, 1, 1, None, None, None)}
    whole = {r.ip: tuple(r)[3:] for r in M.ip_metrics(df, gap_ms=5_000).collect()}
    assert whole == {"1.1.1.1": (4, 4, 1, 1, 1, 0, 1), None: (2, 2, 1, 1, 1, None, None), "2.2.2.2": (1, 0, 1, 1, 1, None, None),
                     "3.3.3.3": (1, 1, 1, 1, 1, -1, 0)}
    for window in ("1 hour", None):
        p = plan_of(M.ip_metrics(df, window=window, gap_ms=5_000))
        assert "Join" not in p
    ordered = plan_of(M.interval_metrics(df, F.col("remote_addr"), window="1 hour"), "simple")
    assert "Aggregate" not in ordered[:ordered.rindex("Window")]


def test_booking_metrics_group_only_the_events_they_count(spark):
    from tollgate.operators.catalogue import booking_metrics
    ev = spark.createDataFrame([(1, "b1", "book"), (1, "b1", "pay"), (2, "b2", "cancel"), (3, None, "book")],
                               "order_key long, buyer_id string, step string").selectExpr(
        "*", "timestamp'2024-01-01 00:00:00' AS ts", "'10.1' AS ip_block", "'n' AS contact_name", "'p' AS contact_phone", "'P1' AS passenger")
    full = booking_metrics(ev, "1 hour", {"buyer"})
    some = booking_metrics(ev, "1 hour", {"buyer"}, ("bookings", "unpaid"))
    assert some.columns == full.columns[:-2]
    assert {(r.key, r.bookings) for r in some.collect()} == {(r.key, r.bookings) for r in full.where("bookings > 0").collect()} == {
        ("b1", 1), (None, 1)}


def java_split_count(s: str, sep: str = "#CS#") -> int:
    t = s
    while t and ord(t[0]) <= 32:
        t = t[1:]
    while t and ord(t[-1]) <= 32:
        t = t[:-1]
    if t == "":
        return 1
    parts = t.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return len(parts)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["a", "", " ", "\n", "#CS#", "x y", "\t"]), max_size=12))
def test_field_count_matches_java_split(spark, pieces):
    s = "".join(pieces)
    got = spark.createDataFrame([(s,)], "v string").select(field_count(F.col("v"))).first()[0]
    assert got == java_split_count(s)


def test_late_event_dropped_by_watermark(spark):
    from tollgate.streaming import metrics_job as SM
    base = scratch_path(spark, f"late-{uuid.uuid4().hex[:8]}")
    p = SM.prepare(edge_rows(spark))
    schema = p.schema

    def write(rows, name):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(base, "in", name))
    on_time = p.filter(F.col("ip") == "2.2.2.2").collect()
    late = [r.asDict() for r in on_time][:1]
    write(on_time, "a")
    write([{**late[0], "ts": late[0]["ts"].replace(hour=12)}], "b")     # moves the watermark on
    sink = os.path.join(base, "out")

    def run():
        src = spark.readStream.format("parquet").schema(schema).load(os.path.join(base, "in", "*"))
        out = SM.stream_panes(src, window="1 hour", slide="1 hour", watermark="10 minutes")
        q = (out.writeStream.format("parquet").option("path", sink).outputMode("append")
             .option("checkpointLocation", os.path.join(base, "ck")).trigger(availableNow=True).start())
        q.awaitTermination()
        return {r.key for r in spark.read.parquet(sink).where("scope = 'ip'").collect()}
    run()
    write([{**late[0], "ip": "9.9.9.9"}], "c")                          # arrives 12 h late
    ips = run()
    assert "2.2.2.2" in ips and "9.9.9.9" not in ips


def test_paging_matches_full_order(spark):
    from tollgate.operators.ranking import page, top_n
    df = spark.range(95).select((F.col("id") * 37 % 95).alias("v"), (F.col("id") % 7).alias("g"))
    order = [F.desc("g"), F.asc("v")]
    full = [tuple(r) for r in df.orderBy(*order).collect()]
    assert [tuple(r) for r in page(df, order, 2, 20).collect()] == full[20:40]
    assert [tuple(r) for r in page(df, order, 5, 20).collect()] == full[80:95]
    assert [tuple(r) for r in top_n(df, order, 10).collect()] == full[:10]
