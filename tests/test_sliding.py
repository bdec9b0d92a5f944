"""Sliding-window and long-range metrics against brute force over all windows."""

import random
from collections import defaultdict
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tollgate.operators import metrics as M
from tollgate.operators.sliding import duration_ms

T0 = 1_704_067_200_000                        # 2024-01-01 00:00 UTC
SCHEMA = "t long, remote_addr string, is_critical boolean, user_agent string, session_id string, dep string, arr string"


def rows_of(seed, n=140, days=3):
    rng = random.Random(seed)
    made = []
    for _ in range(n):
        burst = rng.random() < 0.6
        t = T0 + (rng.randrange(6) * 7_200_000 + rng.randrange(0, 400_000, 250) if burst else rng.randrange(days * 86_400_000))
        made.append((t, rng.choice(["a", "a", "b", "c"]), rng.choice([True, False, None]), rng.choice([None, "x", "y", "z"]),
                     rng.choice([None, "s1", "s2", "s3", "s4"]), rng.choice([None, "D"]), rng.choice(["E", "F"])))
    return made + made[:5]                    # equal rows: a gap of 0


def frame(spark, rows):
    d = spark.createDataFrame(rows, SCHEMA)
    return d.withColumn("ts", F.timestamp_millis("t")).drop("t")


def metrics_by_hand(hits, gap):
    times = sorted(h[0] for h in hits if h[2])
    gaps = [b - a for a, b in zip(times, times[1:])]
    return (len(hits), len(times), len({h[3] or "" for h in hits}), len({h[4] for h in hits} - {None}),
            len({f"{h[5] or ''}->{h[6] or ''}" for h in hits}),
            None if not times else min(gaps) if gaps else -1, None if not times else sum(g < gap for g in gaps))


def by_hand(rows, window, slide, gap):
    W, S = duration_ms(window), duration_ms(slide)
    per = defaultdict(list)
    for r in rows:
        s = r[0] // S * S
        while s > r[0] - W:
            per[r[1], s].append(r)
            s -= S
    return {k: metrics_by_hand(v, gap) for k, v in per.items()}


@pytest.mark.parametrize("window, slide, gap", [("5 minutes", "5 seconds", 5000), ("5 minutes", "2 minutes", 60_000),
                                                ("1 hour", "25 minutes", 600_000), ("10 seconds", "3 seconds", 1000),
                                                ("7 seconds", "9 seconds", 0)])
def test_sliding_equals_all_windows(spark, window, slide, gap):
    rows = rows_of(len(window) + gap)
    got = M.ip_metrics(frame(spark, rows), window=window, slide=slide, gap_ms=gap).collect()
    ms = lambda t: int(t.replace(tzinfo=UTC).timestamp() * 1000)
    have = {(r.ip, ms(r.window_start)): tuple(r[c] for c in M.WIDE_METRICS) for r in got}
    want = by_hand(rows, window, slide, gap)
    assert len(got) == len(have) == len(want)
    assert {k: have[k] for k in want} == want
    assert all(r.window_end - r.window_start == datetime.fromtimestamp(duration_ms(window) / 1000, UTC) - datetime.fromtimestamp(0, UTC)
               for r in got)


def test_sliding_with_several_gaps_and_no_rows(spark):
    rows = rows_of(9, n=40)
    d = frame(spark, rows)
    got = M.ip_metrics(d, window="1 hour", slide="10 minutes", gap_ms=[1000, 600_000])
    for gap in (1000, 600_000):
        one = M.ip_metrics(d, window="1 hour", slide="10 minutes", gap_ms=gap)
        cols = ["window_start", "ip", "min_interval_ms"]
        assert sorted(map(tuple, got.select(*cols, f"close_interval_count_{gap}").collect()), key=repr) == \
            sorted(map(tuple, one.select(*cols, "close_interval_count").collect()), key=repr)
    assert M.ip_metrics(d.limit(0), window="1 hour", slide="10 minutes").count() == 0


@pytest.mark.parametrize("window", [None, "1 day", "3 days", "1 hour"])
def test_chunks_of_days_merge_in_order(spark, window):
    """One IP over many days: gaps across midnight count, also over days without hits."""
    rows = rows_of(4, n=200, days=12) + [(T0 + 86_400_000 * k - 1, "a", True, "x", "s", "D", "E") for k in (1, 2, 7)] \
        + [(T0 + 86_400_000 * k, "a", True, "x", "s", "D", "E") for k in (1, 7, 9)] + [(T0, "single", True, None, None, None, None)]
    got = M.ip_metrics(frame(spark, rows), window=window, gap_ms=3_600_000).collect()
    if window is None:
        groups = defaultdict(list)
        for r in rows:
            groups[r[1]].append(r)
        assert {r.ip: tuple(r[c] for c in M.WIDE_METRICS) for r in got} == {k: metrics_by_hand(v, 3_600_000) for k, v in groups.items()}
        return
    want = by_hand(rows, window, window, 3_600_000)
    have = {(r.ip, int(r.window_start.replace(tzinfo=UTC).timestamp() * 1000)): tuple(r[c] for c in M.WIDE_METRICS) for r in got}
    assert have == want


def plan_of(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_no_copies_of_hits_and_no_timeline_in_one_task(spark):
    d = frame(spark, rows_of(1))
    text = plan_of(M.ip_metrics(d, window="5 minutes", slide="5 seconds"))
    windows = [line for line in text.splitlines() if "windowspecdefinition" in line]
    assert windows and all("block" in line for line in windows)
    assert text.count("explode(sequence") == 1                      # windows are written out once, at the end
    assert all("_chunk" in line for line in plan_of(M.ip_metrics(d)).splitlines() if "windowspecdefinition" in line)
