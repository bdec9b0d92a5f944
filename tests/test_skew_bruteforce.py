"""A third of all rows on one IP: the metrics still equal a brute-force computation."""

import pandas as pd
from pyspark.sql import functions as F

from table_dirs import SF_SMALL
from tollgate.operators import metrics as M
from tollgate.plans.registry import tagged_requests

GAP = 3_600_000


def brute(pdf: pd.DataFrame) -> dict:
    out = {}
    for ip, g in pdf.groupby("remote_addr"):
        crit = sorted(int(t.value // 1_000_000) for t in g.loc[g.is_critical, "ts"])
        gaps = [b - a for a, b in zip(crit, crit[1:])]
        out[ip] = (len(g), len(crit), g.user_agent.fillna("").nunique(), g.session_id.nunique(),
                   (g.dep.fillna("") + "->" + g.arr.fillna("")).nunique(),
                   None if not crit else (-1 if len(crit) == 1 else min(gaps)),
                   None if not crit else sum(1 for x in gaps if x < GAP))
    return out


def test_hot_ip_matches_brute_force(spark):
    r = tagged_requests(spark, SF_SMALL)
    hot = r.withColumn("remote_addr", F.when(F.col("event_id") % 3 == 0, F.lit("6.6.6.6"))
                       .otherwise(F.col("remote_addr")))
    cols = ["remote_addr", "ts", "is_critical", "user_agent", "session_id", "dep", "arr"]
    pdf = hot.select(*cols).toPandas()
    assert (pdf.remote_addr == "6.6.6.6").mean() > 0.3
    exp = brute(pdf)
    got = {x.ip: tuple(x[c] for c in M.WIDE_METRICS) for x in M.ip_metrics(hot, gap_ms=GAP).collect()}
    assert got == exp
    # daily windows: per-day brute force for the hot IP only
    pdf["day"] = pdf.ts.dt.floor("D")
    daily = M.ip_metrics(hot, window="1 day", gap_ms=GAP).filter(F.col("ip") == "6.6.6.6").collect()
    for row in daily:
        day = pd.Timestamp(row.window_start)
        e = brute(pdf[(pdf.day == day) & (pdf.remote_addr == "6.6.6.6")])["6.6.6.6"]
        assert tuple(row[c] for c in M.WIDE_METRICS) == e
