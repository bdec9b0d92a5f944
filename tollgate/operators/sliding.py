"""Per-IP metrics (A2-A8) over sliding windows, from mergeable partials of window-long blocks.

Time is cut into panes of gcd(window, slide), each of which lies whole in every window it touches, and
into blocks as long as the window. A window that starts within a block is the *suffix* of that
block from the start on, followed by the *prefix* of the next block up to the window's end. So all that
is needed are running partials, forwards and backwards, of the panes of a block:

* ``Partial``: hits, critical hits, first and last critical time, least gap, gaps below the limits.
  Partials of neighbouring stretches merge: counts add up, and the one new gap runs from the
  last time of the earlier to the first time of the later one. No hit is copied into its windows.
* distinct values (A4, A5, A8): per value and block only its first and its last pane matter. It is in
  the windows that start up to its last pane in their block, and in those that reach its first pane in the next
  block; the counts are running sums of +1 and -1 where these ranges begin and end.

Partials and counts change at some starts only; between two changes all windows look alike and are
written out at the very end. Every ordered partition is one IP in one block or two: a hot IP's timeline
is never in one task, and its rows there are bounded by the panes (and distinct times) of a window. Values are
aggregated map-side, keyed by IP, value and block.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("ua", "sid", "rt")

_UNIT_MS = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000,
            "day": 86_400_000, "week": 7 * 86_400_000}


def duration_ms(text: str) -> int:
    """``'5 minutes'`` -> 300000 (the interval forms used for windows)."""
    n, unit = text.split()
    return int(float(n) * _UNIT_MS[unit.lower().rstrip("s")])


def pane_ms(window: str, slide: str) -> int:
    return gcd(duration_ms(window), duration_ms(slide))


def floor_to(t: Column, step: int) -> Column:
    return t - F.pmod(t, F.lit(step))


def next_start(t: Column, slide: int) -> Column:
    """First window start later than ``t``."""
    return floor_to(t, slide) + F.lit(slide)


def pane_partials(hits: DataFrame, width: int, pane: int, gaps: list[int]) -> DataFrame:
    """One partial per (ip, block, pane) of ``hits`` (ip, t, n, c: hits and critical hits), and its gap to an earlier pane of the block.

    Hits of equal time are one row before they are ordered: a gap of 0 between any two of them.
    """
    times = hits.groupBy("ip", floor_to(F.col("t"), width).alias("block"), "t").agg(
        F.sum("n").alias("n"), F.sum("c").alias("c"))
    critical = F.when(F.col("c") > 0, F.col("t"))
    earlier = Window.partitionBy("ip", "block").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    times = times.select("*", floor_to(F.col("t"), pane).alias("pane"), critical.alias("ct"),
                         F.last(critical, ignorenulls=True).over(earlier).alias("before"))
    gap, inside = F.col("ct") - F.col("before"), F.col("before") >= F.col("pane")
    return times.groupBy("ip", "block", "pane").agg(
        F.sum("n").alias("n"), F.sum("c").alias("c"), F.min("ct").alias("first"), F.max("ct").alias("last"),
        F.min(F.least(F.when(F.col("c") > 1, F.lit(0)), F.when(inside, gap))).alias("least"),
        F.min(F.when(~inside, gap)).alias("lead"),
        *[F.sum(F.when(F.col("c") > 1, (F.col("c") - 1) * int(g > 0)).otherwise(F.lit(0))
                + F.coalesce((inside & (gap < g)).cast("long"), F.lit(0))).alias(f"near{k}") for k, g in enumerate(gaps)])


def running(panes: DataFrame, gaps: list[int]) -> DataFrame:
    """``prefix`` (the block up to a pane), ``suffix`` (from it on) and ``rest`` (after it), all partials."""
    of_block = Window.partitionBy("ip", "block")
    upwards, downwards = of_block.orderBy("pane"), of_block.orderBy(F.desc("pane"))
    whole = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)     # noqa: E731
    without = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    near_lead = [F.coalesce((F.col("lead") < g).cast("long"), F.lit(0)) for g in gaps]

    def partial(w, led) -> list[Column]:
        """Over the frame ``w``; gaps that lead into its panes count over ``led``."""
        return [F.sum("n").over(w).alias("n"), F.sum("c").over(w).alias("c"),
                F.min("first").over(w).alias("first"), F.max("last").over(w).alias("last"),
                F.least(F.min("least").over(w), F.min("lead").over(led)).alias("least"),
                *[(F.sum(f"near{k}").over(w) + F.coalesce(F.sum(x).over(led), F.lit(0))).alias(f"near{k}")
                  for k, x in enumerate(near_lead)]]
    prefix, suffix = (F.struct(*partial(whole(upwards), whole(upwards))), F.struct(*partial(whole(downwards), without(downwards))))
    rows = panes.select("ip", "block", "pane", prefix.alias("prefix"), suffix.alias("suffix"),
                        (F.row_number().over(upwards) == 1).alias("opens"))
    return rows.select("*", F.lag("suffix").over(downwards).alias("rest"))


def nothing(gaps: list[int]) -> Column:
    """The partial of no hits."""
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    return F.struct(zero.alias("n"), zero.alias("c"), none.alias("first"), none.alias("last"), none.alias("least"),
                    *[zero.alias(f"near{k}") for k in range(len(gaps))])


def partial_changes(rows: DataFrame, width: int, slide: int, pane: int, gaps: list[int]) -> DataFrame:
    """(ip, block, start, at, prefix, suffix): what the windows of a block consist of from ``start`` on.

    A pane of the block leaves the windows after it, a pane of the next block enters those that reach its end.
    """
    none, block = F.lit(None), F.col("block")
    kind = rows.schema["suffix"].dataType

    def change(of: Column, start: Column, at: Column, prefix: Column, suffix: Column) -> Column:
        return F.struct(of.alias("block"), start.alias("start"), at.alias("at"),
                        prefix.cast(kind).alias("prefix"), suffix.cast(kind).alias("suffix"))
    changes = F.array(
        F.when(F.col("opens"), change(block, next_start(block - 1, slide), block - 1, none, F.col("suffix"))),
        change(block, next_start(F.col("pane"), slide), F.col("pane"), none, F.coalesce("rest", nothing(gaps).cast(kind))),
        change(block - width, next_start(F.col("pane") + (pane - width - 1), slide), F.col("pane"), F.col("prefix"), none))
    return rows.select("ip", F.inline(F.filter(changes, lambda x: x.isNotNull() & (x["start"] < x["block"] + width))))


def distinct_changes(values: DataFrame, width: int, slide: int, pane: int) -> DataFrame:
    """(ip, block, start, <kinds>): by how much the distinct ``values`` (ip, t, kind, v) of the windows change at ``start``."""
    at, block = floor_to(F.col("t"), pane), floor_to(F.col("t"), width)
    none = F.lit(None).cast("long")
    sides = F.array(F.struct(block.alias("block"), at.alias("last"), none.alias("first")),
                    F.struct((block - width).alias("block"), none.alias("last"), at.alias("first")))
    seen = values.select("ip", "kind", "v", F.inline(sides)).groupBy("ip", "kind", "v", "block").agg(
        F.max("last").alias("last"), F.min("first").alias("first"))
    leaves, enters = next_start(F.col("last"), slide), next_start(F.col("first") + (pane - width - 1), slide)
    here = F.col("last").isNotNull()
    gone = here & (F.col("first").isNull() | (enters > leaves))
    turn = lambda start, by: F.struct(start.alias("start"), F.lit(by).alias("by"))
    turns = F.array(F.when(here, turn(next_start(F.col("block") - 1, slide), 1)), F.when(gone, turn(leaves, -1)),
                    F.when(F.col("first").isNotNull() & (gone | ~here), turn(enters, 1)))
    turns = F.filter(turns, lambda x: x.isNotNull() & (x["start"] < F.col("block") + width))
    return seen.select("ip", "kind", "block", F.inline(turns)).groupBy("ip", "block", "start").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("by")).otherwise(F.lit(0))).alias(k) for k in KINDS])


def sliding_metrics(base: DataFrame, window: str, slide: str, gaps: dict[str, int]) -> DataFrame:
    """All seven metrics per (window, IP) of ``base`` (ts, ip, crit, ua, sid, rt); ``gaps`` names the close-interval counts."""
    rows = base.where("ts IS NOT NULL").withColumn("t", F.unix_millis("ts"))
    stack = f"stack({len(KINDS)}, {', '.join(f'{k!r}, {k}' for k in KINDS)}) AS (kind, v)"
    return windows_of(rows.select("ip", "t", F.lit(1).alias("n"), F.col("crit").cast("int").alias("c")),
                      rows.select("ip", "t", F.expr(stack)).where("v IS NOT NULL"), window, slide, gaps)


def windows_of(hits: DataFrame, values: DataFrame, window: str, slide: str, gaps: dict[str, int]) -> DataFrame:
    """The metrics from ``hits`` (ip, t, n, c: hits and critical hits at a time) and ``values`` (ip, t, kind, v)."""
    width, step, pane = duration_ms(window), duration_ms(slide), pane_ms(window, slide)
    limits = list(gaps.values())
    partials = partial_changes(running(pane_partials(hits, width, pane, limits), limits), width, step, pane, limits)
    counts = distinct_changes(values, width, step, pane)
    changes = partials.unionByName(counts.withColumn("at", F.lit(-1).cast("long")), allowMissingColumns=True)
    order = Window.partitionBy("ip", "block").orderBy("start", "at")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    state = changes.select("ip", "start", F.lead("start").over(order).alias("next"), (F.col("block") + width).alias("end"),
                           F.coalesce(F.last("suffix", ignorenulls=True).over(so_far), nothing(limits)).alias("a"),
                           F.coalesce(F.last("prefix", ignorenulls=True).over(so_far), nothing(limits)).alias("b"),
                           *[F.sum(k).over(so_far).alias(k) for k in KINDS])
    # the last change of a start has seen all of them
    state = state.where((F.col("next").isNull() | (F.col("next") > F.col("start"))) & (F.col("a.n") + F.col("b.n") > 0))
    between = F.col("b.first") - F.col("a.last")
    critical = F.col("a.c") + F.col("b.c")
    least = (F.when(critical == 1, F.lit(-1)).when(critical > 1, F.least("a.least", "b.least", between)))
    near = [F.when(critical > 0, F.col(f"a.near{k}") + F.col(f"b.near{k}") + F.coalesce((between < g).cast("long"), F.lit(0)))
            for k, g in enumerate(limits)]
    starts = F.sequence("start", F.coalesce("next", "end") - 1, F.lit(step))
    out = state.select("ip", (F.col("a.n") + F.col("b.n")).alias("access_count"), critical.alias("critical_count"),
                       *[F.col(k).cast("long").alias(c) for k, c in zip(KINDS, ("user_agent_count", "cookie_count", "route_count"))],
                       least.cast("long").alias("min_interval_ms"), *[x.alias(c) for x, c in zip(near, gaps)],
                       F.explode(starts).alias("s"))
    return out.select(F.timestamp_millis("s").alias("window_start"), F.timestamp_millis(F.col("s") + width).alias("window_end"),
                      *[c for c in out.columns if c != "s"])
