"""Per-key behaviour metrics (A1-A13) over tumbling, sliding or no windows.

Skew: any key (one IP) may hold a large share of all rows. Every metric is
built so that no task ever holds one key's raw rows:

* counts are partial-aggregated map-side (HashAggregate partial/final);
* distinct counts use Spark's two-phase distinct plan (dedup on
  ``(key, value)`` first, spread by value, then per-key partial counts);
* gap metrics first collapse hits to ``(key, timestamp, hits)`` map-side; gaps are
  taken in chunks of a day (86 400 rows at the log's 1 s resolution however hot
  the key is), and longer windows merge the chunks' partials in order.

Sliding windows are in ``sliding.py``: running partials of window-long blocks, no
copies of rows per window. Counts by other keys (``keyed_count``) are aggregated into
panes as wide as the greatest common divisor of window and slide, so that each pane lies
whole in every window it touches, then each pane is assigned to the windows containing it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.functions.text import ip_block, is_ipv4_shape, route
from tollgate.operators.sliding import duration_ms, pane_ms, sliding_metrics

WIN = ["window_start", "window_end"]

WIDE_METRICS = ["access_count", "critical_count", "user_agent_count", "cookie_count",
                "route_count", "min_interval_ms", "close_interval_count"]


def _with_window(df: DataFrame, ts: Column, window: str | None, slide: str | None) -> DataFrame:
    """Add ``window_start``/``window_end`` (epoch-aligned, like ``window()``).

    Tumbling windows use ``window()``. Sliding windows are assigned with plain
    arithmetic: the window starts containing ``t`` are the slide multiples in
    ``(t - length, t]``, produced by one ``explode(sequence(...))`` of longs,
    cheaper than the generic expansion (one projection and filter per window).
    """
    if window is None:
        return df.select("*", F.lit(None).cast("timestamp").alias("window_start"),
                         F.lit(None).cast("timestamp").alias("window_end"))
    if not slide or slide == window:
        w = F.window(ts, window)
        return (df.select("*", w.alias("_win"))
                  .select("*", F.col("_win.start").alias("window_start"),
                          F.col("_win.end").alias("window_end")).drop("_win"))
    W, P = duration_ms(window), duration_ms(slide)
    n = -(-W // P)
    t = F.unix_millis(ts)
    last = t - F.pmod(t, F.lit(P))
    starts = F.filter(F.sequence(last - F.lit((n - 1) * P), last, F.lit(P)), lambda s: s + F.lit(W) > t)
    return (df.select("*", F.explode(starts).alias("_ws"))
              .withColumn("window_start", F.timestamp_millis("_ws"))
              .withColumn("window_end", F.timestamp_millis(F.col("_ws") + F.lit(W))).drop("_ws"))


def _panes(df: DataFrame, ts_col: str, window: str | None, slide: str | None) -> tuple[DataFrame, bool]:
    """Assign each row its pane: the window itself when tumbling, a tumbling pane of
    ``pane_ms`` when sliding (returned flag says panes need expanding)."""
    sliding = bool(window and slide and slide != window)
    if sliding:
        t = F.unix_millis(F.col(ts_col))
        return df.withColumn("_pane", F.timestamp_millis(t - F.pmod(t, F.lit(pane_ms(window, slide))))), True
    return _with_window(df, F.col(ts_col), window, slide), False


def _expand(df: DataFrame, window: str, slide: str) -> DataFrame:
    """Pane start -> every sliding window that contains the whole pane."""
    return _with_window(df, F.col("_pane"), window, slide).drop("_pane")


def keyed_count(df: DataFrame, key: Column, *, ts_col: str = "ts", window: str | None = None,
                slide: str | None = None, name: str = "value",
                weight: Column | None = None) -> DataFrame:
    """Generic windowed count per key: ``(window_start, window_end, key, <name>)``.

    ``weight`` (a 0/1 or boolean column) turns it into a conditional count.
    """
    wt = F.lit(1) if weight is None else F.coalesce(weight.cast("bigint"), F.lit(0))
    base = df.select(F.col(ts_col), key.alias("key"), wt.alias("_w"))
    p, sliding = _panes(base, ts_col, window, slide)
    if sliding:
        agg = p.groupBy("_pane", "key").agg(F.sum("_w").alias("_n"))
        agg = _expand(agg, window, slide)
        return agg.groupBy(*WIN, "key").agg(F.sum("_n").cast("bigint").alias(name))
    return p.groupBy(*WIN, "key").agg(F.sum("_w").cast("bigint").alias(name))


def ip_block_counts(req: DataFrame, *, ip_col: str = "remote_addr", ts_col: str = "ts",
                    window: str | None = None, slide: str | None = None) -> DataFrame:
    """A1: accesses per /16 block, four-part IPs only."""
    r = req.filter(is_ipv4_shape(F.col(ip_col)))
    return keyed_count(r, ip_block(F.col(ip_col)), ts_col=ts_col, window=window, slide=slide,
                       name="access_count").withColumnRenamed("key", "ip_block")


CHUNK_MS = 86_400_000          # gaps are ordered within chunks of a day


def interval_metrics(hits: DataFrame, key: Column, *, ts_col: str = "ts", window: str | None = None,
                     gap_ms: int | list[int] = 5000) -> DataFrame:
    """A6/A7 over the given hit rows (already filtered to critical pages), tumbling or whole input.

    A list of gaps gives one column ``close_interval_count_<gap>`` each.

    ``min_interval_ms``: smallest gap between consecutive hits, -1 for a single hit.
    ``close_interval_count``: number of consecutive gaps ``< gap_ms``.
    Keys without hits do not appear.

    Gaps are taken within chunks of a day, so a task orders one key's times of one day at most. Over longer
    windows the chunks' partials are merged in order: their first and last times alone give the gaps between them.
    """
    t = F.unix_millis(F.col(ts_col))
    wanted = {f"close_interval_count_{g}": g for g in gap_ms} if isinstance(gap_ms, list) else {"close_interval_count": gap_ms}
    one_chunk = window is not None and CHUNK_MS % duration_ms(window) == 0
    by = [*WIN, "key"] if one_chunk else [*WIN, "key", "_chunk"]
    # 1) collapse equal timestamps map-side: (key, t, hits)
    rows = _with_window(hits.select(F.col(ts_col).alias("_ts"), key.alias("key"), t.alias("_t")), F.col("_ts"), window, None)
    per_t = rows.withColumn("_chunk", F.floor(F.col("_t") / CHUNK_MS)).groupBy(*by, "_t").agg(F.count(F.lit(1)).alias("_n"))
    # 2) one partial per chunk, taken over the rows as they are sorted and kept on the first: a grouping of its own
    #    would hold every key of the task in maps beside the sort
    chunk = Window.partitionBy(*by)
    w = chunk.orderBy("_t")
    gaps = per_t.withColumns({"_gap": F.col("_t") - F.lag("_t").over(w), "_row": F.row_number().over(w)})
    parts = gaps.select(
        *by, "_row", F.sum("_n").over(chunk).alias("_hits"), F.min("_t").over(chunk).alias("_first"), F.max("_t").over(chunk).alias("_last"),
        F.min(F.least(F.when(F.col("_n") > 1, F.lit(0)), F.col("_gap"))).over(chunk).alias("_least"),
        *[(F.sum((F.col("_n") - 1) * F.lit(1 if 0 < g else 0)).over(chunk)
           + F.count_if(F.col("_gap") < g).over(chunk)).cast("bigint").alias(c) for c, g in wanted.items()]).where("_row = 1")
    single = F.when(F.col("_hits") == 1, F.lit(-1))
    if one_chunk:
        return parts.select(*WIN, "key", single.otherwise(F.col("_least")).cast("bigint").alias("min_interval_ms"), *wanted)
    # 3) merged in the order of chunks; a key has one entry per chunk of the window
    agg = parts.groupBy(*WIN, "key").agg(
        F.sum("_hits").alias("_hits"), F.min("_least").alias("_least"), *[F.sum(c).alias(c) for c in wanted],
        F.sort_array(F.collect_list(F.struct("_chunk", "_first", "_last"))).alias("_ends"))
    agg = agg.withColumn("_between", F.transform(F.slice("_ends", F.lit(2), F.size("_ends")),
                                                 lambda x, i: x["_first"] - F.element_at("_ends", i + 1)["_last"]))

    def closer_than(g: int) -> Column:
        return F.size(F.filter("_between", lambda x: x < g))
    return agg.select(*WIN, "key", single.otherwise(F.least("_least", F.array_min("_between"))).cast("bigint").alias("min_interval_ms"),
                      *[(F.col(c) + closer_than(g)).cast("bigint").alias(c) for c, g in wanted.items()])


def ip_metrics(req: DataFrame, *, ip_col: str = "remote_addr", ts_col: str = "ts",
               critical_col: str = "is_critical", ua_col: str = "user_agent",
               session_col: str = "session_id", dep_col: str = "dep", arr_col: str = "arr",
               window: str | None = None, slide: str | None = None,
               gap_ms: int | list[int] = 5000) -> DataFrame:
    """A2-A8 per (window, IP), wide: one row per IP seen in the window.

    access_count (A2), critical_count (A3, 0 when none), user_agent_count (A4,
    NULL counted as ''), cookie_count (A5, all pages), route_count (A8),
    min_interval_ms (A6) and close_interval_count (A7), NULL for IPs without a
    critical hit.
    """
    ip = F.col(ip_col)
    base = req.select(F.col(ts_col).alias("ts"), ip.alias("ip"),
                      F.coalesce(F.col(critical_col), F.lit(False)).alias("crit"),
                      F.coalesce(F.col(ua_col), F.lit("")).alias("ua"),
                      F.col(session_col).alias("sid"),
                      route(F.coalesce(F.col(dep_col), F.lit("")),
                            F.coalesce(F.col(arr_col), F.lit(""))).alias("rt"))
    if window and slide and slide != window:
        gaps = {f"close_interval_count_{g}": g for g in gap_ms} if isinstance(gap_ms, list) else {"close_interval_count": gap_ms}
        return sliding_metrics(base, window, slide, gaps)
    # tumbling / whole input: counts and the three exact distinct counts in ONE
    # aggregation (Spark's distinct rewrite: Expand, dedup keyed by value,
    # then per-IP partial counts -- no task ever holds one IP's raw rows).
    # The gap metrics, one row per IP, pass through the same aggregation: a join
    # would sort both sides in the task that also holds their maps.
    gaps = interval_metrics(base.filter("crit"), F.col("ip"), ts_col="ts", window=window,
                            gap_ms=gap_ms).withColumnRenamed("key", "ip")
    of_gaps = [c for c in gaps.columns if c not in (*WIN, "ip")]
    hits = _with_window(base, F.col("ts"), window, None).select(*WIN, "ip", "crit", "ua", "sid", "rt", F.lit(1).alias("_hit"))
    rows = hits.unionByName(gaps.where(F.col("ip").isNotNull()), allowMissingColumns=True)
    out = rows.groupBy(*WIN, "ip").agg(
        F.count("_hit").alias("access_count"),
        F.count_if("crit").cast("bigint").alias("critical_count"),
        F.count_distinct("ua").alias("user_agent_count"),
        F.count_distinct("sid").alias("cookie_count"),
        F.count_distinct("rt").alias("route_count"),
        *[F.max(c).alias(c) for c in of_gaps])
    return out.select(*WIN, "ip", *[c for c in WIDE_METRICS if c != "close_interval_count"],
                      *[c for c in of_gaps if c.startswith("close_interval_count")])


# Metric names in the long form, matched by score rules (B1).
METRIC_NAMES = {
    "access_count": "ip_access",
    "critical_count": "critical_access",
    "user_agent_count": "user_agent_distinct",
    "cookie_count": "cookie_distinct",
    "route_count": "route_distinct",
    "min_interval_ms": "critical_min_interval",
    "close_interval_count": "critical_close_intervals",
}


def to_long(wide: DataFrame, key_col: str = "ip", only: set[str] | None = None) -> DataFrame:
    """Wide metrics -> ``(window_start, window_end, metric, key, value, arg1)``;
    absent metrics (NULL) produce no row. ``only`` keeps the named long metrics (unused
    aggregates are then pruned). ``arg1`` is the gap of a close-interval count made for a
    list of gaps, else NULL."""
    names = {}
    for c in wide.columns:
        plain, _, gap = (c, "", "") if c in METRIC_NAMES else c.rpartition("_")
        if plain in METRIC_NAMES and (only is None or METRIC_NAMES[plain] in only):
            names[c] = f"{METRIC_NAMES[plain]}@{gap}"
    renamed = wide.select(*WIN, F.col(key_col).alias("key"), *[F.col(c).cast("bigint").alias(n) for c, n in names.items()])
    long = renamed.unpivot([*WIN, "key"], list(names.values()), "_name", "value").where(F.col("value").isNotNull())
    return long.select(*WIN, F.substring_index("_name", "@", 1).alias("metric"), "key", "value",
                       F.substring_index("_name", "@", -1).try_cast("double").alias("arg1"))


def link_counts(df: DataFrame, *, server_col: str = "server_addr", ts_col: str = "ts",
                window: str | None = None) -> DataFrame:
    """Requests per server link; A10: last active-connection count per server
    (latest by time, ties broken by the larger count, so input order is irrelevant)."""
    p = _with_window(df.select(F.col(ts_col).alias("ts"), F.col(server_col).alias("server_addr"),
                               F.col("active_user_num").cast("bigint").alias("active_user_num")),
                     F.col("ts"), window, None)
    return p.groupBy(*WIN, "server_addr").agg(
        F.count(F.lit(1)).alias("request_count"),
        F.max_by("active_user_num", F.struct("ts", "active_user_num")).alias("active_user_num"))

