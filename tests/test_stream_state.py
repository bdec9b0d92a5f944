"""Where the streaming jobs keep their state: on disk, so that open panes are not bounded by the heap."""

import os
import uuid
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tollgate.session import COUNT_STATE, STATE_CONF, configure, scratch_path
from tollgate.sources import dimensions as dim
from tollgate.streaming import metrics_job as SM

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
START = datetime(2024, 1, 1, tzinfo=UTC)


@pytest.fixture
def plain(spark):
    """The session as a driver hands it over: no setting of streaming state."""
    for k in STATE_CONF:
        spark.conf.unset(k)
    yield spark
    configure(spark)


def events(spark, path):
    """Two users, a request each every 7 minutes for 5 hours, the later hours first; two without time or user."""
    rows = [(2 * k + u, START + timedelta(minutes=7 * k), u, "view" if k % 3 else "purchase", 1.0, f'{{"k": {k % 5}}}')
            for k in reversed(range(43)) for u in (0, 1)]
    rows += [(900, None, 0, "view", 1.0, '{"k": 1}'), (901, START, None, "view", 1.0, '{"k": 1}')]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string") \
        .repartition(3).write.parquet(f"{path}/events.parquet")


def test_state_of_a_plain_session_lies_on_disk_within_bounds(plain):
    from tollgate.operators.scoring import RuleBook
    base = scratch_path(plain, f"state-{uuid.uuid4().hex[:8]}")
    schema = "ts timestamp, ip string, crit boolean, ua string, sid string, rt string"
    for k, hour in enumerate((0, 3, 6)):
        plain.createDataFrame([(START + timedelta(hours=hour, seconds=i), f"10.0.0.{i % 4}", True, "a", f"s{i}", "x") for i in range(40)],
                              schema).coalesce(1).write.parquet(os.path.join(base, "in", str(k)))
    configure(plain)
    source = plain.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "in", "*"))
    q = SM.start_scores(source, os.path.join(base, "out"), os.path.join(base, "ck"),
                        lambda s: SM.Rules(dim.critical_page_rules(s), RuleBook.defaults(s)), window="1 hour", slide="10 minutes",
                        watermark="0 seconds", rule_type=1, trigger={"availableNow": True})
    q.awaitTermination()
    states = [s for p in q.recentProgress for s in p.stateOperators]
    assert states and all(any(m.startswith("rocksdb") for m in s.customMetrics) for s in states)
    assert max(s.numRowsUpdated for s in states) > 80 and max(s.numRowsTotal for s in states) <= 0      # no lookups to count all rows
    assert plain.conf.get(COUNT_STATE, None) is None
    assert plain.conf.get("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage") == "true"
    hits = plain.read.parquet(os.path.join(base, "out", "metrics")).where("scope = 'ip'").groupBy("key").agg(F.sum("access_count").alias("n"))
    # two closed panes of 10 hits per IP; all but the windows after the last closed pane are complete
    assert {r.key: r.n for r in hits.collect()} == {f"10.0.0.{i}": 10 * 6 + 10 for i in range(4)}


def test_the_registered_stream_keeps_all_rows_in_disk_state(plain):
    base = scratch_path(plain, f"state-query-{uuid.uuid4().hex[:8]}").removeprefix("file:")
    events(plain, base)
    got = E.queries()["stream_ip_metrics_1h_10m"](plain, base)
    assert plain.conf.get(PROVIDER) == STATE_CONF[PROVIDER]
    counts = {r.ip: r.n for r in got.groupBy("ip").agg(F.sum("access_count").alias("n")).collect()}
    # each user alone: 43 requests, a window of 1 hour ends at each 10 minutes up to the last closed pane
    at = [7 * k for k in range(43)]
    last = max((t // 10 + 1) * 10 for t in at if (t // 10 + 1) * 10 <= max(at))
    want = sum(1 for t in at for s in range(t // 10 * 10 - 50, t // 10 * 10 + 1, 10) if s + 60 <= last)
    assert counts == {"10.0.0.0": want, "10.1.1.1": want}


def test_a_state_store_of_ones_own_is_kept(plain):
    mine = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    plain.conf.set(PROVIDER, mine)
    plain.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "2000")
    try:
        configure(plain)
        assert plain.conf.get(PROVIDER) == mine
        assert plain.conf.get("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB") == "2000"
        assert plain.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        for k in STATE_CONF:
            plain.conf.unset(k)
