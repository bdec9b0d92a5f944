"""Dashboard aggregates (V1-V16) over classified requests.

User classes: a request from a scraper-blacklisted IP is ``query``; a buyer
blacklisted by a seat-hoarding flow is ``hoarding``; a buyer whose contact
phone is shared by at least ``agent_min_buyers`` buyers is ``agent``; else
``normal``. Class sets are derived from the data and joined plainly; adaptive execution
turns a join into a broadcast only when the measured side is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


CLASSES = ["normal", "query", "hoarding", "agent"]


def agent_buyers(bookings: DataFrame, min_buyers: int = 2) -> DataFrame:
    """Buyers whose contact phone is shared by >= ``min_buyers`` distinct buyers."""
    shared = (bookings.groupBy("contact_phone").agg(F.count_distinct("buyer_id").alias("_n"))
                      .filter(F.col("_n") >= min_buyers).select("contact_phone"))
    return bookings.join(shared, "contact_phone", "left_semi").select("buyer_id").distinct()


def _member(df: DataFrame, col: Column, keys: DataFrame, out: str) -> DataFrame:
    # derived key set: no probe; AQE broadcasts it at runtime if it is measured small
    k = keys.select(F.col(keys.columns[0]).alias(f"_{out}_k")).distinct() \
            .withColumn(f"_{out}_hit", F.lit(True))
    return (df.join(k, col == F.col(f"_{out}_k"), "left")
              .withColumn(out, F.coalesce(F.col(f"_{out}_hit"), F.lit(False)))
              .drop(f"_{out}_k", f"_{out}_hit"))


def classify_users(req: DataFrame, blacklisted: DataFrame | None = None, crawler_types: set[int] = frozenset(),
                   agents: DataFrame | None = None) -> DataFrame:
    """Adds ``day`` and the flags ``is_scraper`` (IPs blacklisted with crawler type 0), ``is_hoarding`` (buyers, type 1)
    and ``is_agent`` as far as asked for; with all three also ``user_class``.

    A dashboard names the sets it reads, so that the others are never computed. Both kinds of blacklisted
    keys are one table, a bit per crawler type, so that the scoring plan below both joins is the same and runs once.
    """
    buyer, d = F.col("user_id").cast("string"), req
    if crawler_types:
        black = blacklisted.groupBy("key").agg(F.bit_or(F.when(F.col("crawler_type") == 0, F.lit(1)).otherwise(F.lit(2))).alias("kinds"))
        for kind, col, out in ((0, F.col("remote_addr"), "is_scraper"), (1, buyer, "is_hoarding")):
            if kind in crawler_types:
                k = black.select(F.col("key").alias("_key"), F.col("kinds").alias("_kinds"))
                has = F.coalesce(F.col("_kinds").bitwiseAND(kind + 1) > 0, F.lit(False))
                d = d.join(k, col == F.col("_key"), "left").withColumn(out, has).drop("_key", "_kinds")
    if agents is not None:
        d = _member(d, buyer, agents, "is_agent")
    if {"is_scraper", "is_hoarding", "is_agent"} <= set(d.columns):
        d = d.withColumn("user_class", F.when(F.col("is_scraper"), F.lit("query")).when(F.col("is_hoarding"), F.lit("hoarding"))
                         .when(F.col("is_agent"), F.lit("agent")).otherwise(F.lit("normal")))
    return d.withColumn("day", F.to_date("ts"))


def _funnel_aggs() -> list[Column]:
    def sess(step):
        return F.count_distinct(F.when(F.col("step") == step, F.col("session_id")))
    q, b, p = sess("query"), sess("book"), sess("pay")
    return [q.alias("query_sessions"), b.alias("book_sessions"), p.alias("pay_sessions")]


def _rates(df: DataFrame) -> DataFrame:
    return (df.withColumn("book_rate", F.round(F.try_divide(F.col("book_sessions"), F.col("query_sessions")), 6))
              .withColumn("pay_rate", F.round(F.try_divide(F.col("pay_sessions"), F.col("query_sessions")), 6)))


def funnel(req: DataFrame) -> DataFrame:
    """V1: query -> book -> pay distinct sessions by day and flight type."""
    return _rates(req.groupBy("day", "flight_type").agg(*_funnel_aggs()))


STEPS = ("query", "book", "pay")


def _seen(user_class: str, step: str | None = None) -> int:
    """The bit of a class among a key's requests of a day, or of a class at a step."""
    return 1 << (CLASSES.index(user_class) * (len(STEPS) + 1) + (0 if step is None else 1 + STEPS.index(step)))


def _per_key(req: DataFrame, key: str) -> DataFrame:
    """(day, key, seen): the classes and steps of each key and day, a bit each, by one map-side aggregate."""
    bits = F.lit(0)
    for c in CLASSES:
        own = [F.when(F.col("step") == s, F.lit(_seen(c, s))).otherwise(F.lit(0)) for s in STEPS]
        bits = F.when(F.col("user_class") == c, F.lit(_seen(c)).bitwiseOR(own[0]).bitwiseOR(own[1]).bitwiseOR(own[2])).otherwise(bits)
    return req.where("day IS NOT NULL").groupBy("day", F.col(key).alias("key")).agg(F.bit_or(bits).alias("seen"))


def _has(bits: int) -> Column:
    return F.col("seen").bitwiseAND(bits) > 0


def funnel_by_class(req: DataFrame) -> DataFrame:
    """V2: the funnel per user class plus an ``all`` row per day.

    Requests are reduced to one row per session and day, then every count is a plain one: rows are
    multiplied neither by classes nor by distinct counts."""
    scopes = {c: [c] for c in CLASSES} | {"all": CLASSES}
    session = F.col("key").isNotNull()
    counts = [F.count_if(_has(sum(_seen(c) for c in own))).alias(f"{name}_here") for name, own in scopes.items()]
    counts += [F.count_if(session & _has(sum(_seen(c, s) for c in own))).alias(f"{name}_{s}")
               for name, own in scopes.items() for s in STEPS]
    rows = F.array(*[F.struct(F.lit(name).alias("user_class"), F.col(f"{name}_here").alias("_here"),
                              *[F.col(f"{name}_{s}").alias(f"{s}_sessions") for s in STEPS]) for name in scopes])
    per_day = _per_key(req, "session_id").groupBy("day").agg(*counts)
    return _rates(per_day.select("day", F.inline(rows)).where("_here > 0").drop("_here"))


def funnel_scope(req: DataFrame) -> DataFrame:
    """V3: the funnel with and without scraper traffic, in one aggregate."""
    steps = ("query", "book", "pay")

    def sessions(step, cond=None):
        c = F.col("step") == step
        return F.count_distinct(F.when(c if cond is None else c & cond, F.col("session_id")))
    clean = ~F.col("is_scraper")
    d = req.groupBy("day").agg(*[sessions(x).alias(f"all_{x}") for x in steps], F.count_if(clean).alias("_clean"),
                               *[sessions(x, clean).alias(f"clean_{x}") for x in steps])
    rows = F.array(*[F.struct(F.lit(scope).alias("scope"), *[F.col(f"{p}_{x}").alias(f"{x}_sessions") for x in steps])
                     for scope, p in (("all", "all"), ("no_scrapers", "clean"))])
    return _rates(d.select("day", "_clean", F.explode(rows).alias("r")).filter("r.scope = 'all' or _clean > 0")
                  .select("day", "r.*"))


def scraper_travel_frequency(req: DataFrame) -> DataFrame:
    """V4/V5: scraper query counts per day, travel type, national vs international."""
    s = req.filter(F.col("is_scraper") & (F.col("step") == "query")
                   & F.col("travel_type").isin("OneWay", "RoundTrip"))
    return (s.groupBy("day", "travel_type")
             .agg(F.count_if(F.col("flight_type") == "National").cast("bigint").alias("national"),
                  F.count_if(F.col("flight_type") == "International").cast("bigint").alias("international")))


def between(req: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Days from ``start`` to ``end``, both included; open where None."""
    d = req if start is None else req.filter(F.col("day") >= F.lit(start).cast("date"))
    return d if end is None else d.filter(F.col("day") <= F.lit(end).cast("date"))


def scraper_route_ranking(req: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """V6: all routes queried by scrapers in a range of days, with their counts; the caller orders
    and pages (``ranking.page``)."""
    return (between(req, start, end).filter(F.col("is_scraper") & (F.col("step") == "query"))
            .groupBy("dep", "arr").agg(F.count(F.lit(1)).alias("queries")))


def hoarding_flight_ranking(req: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """V7: unpaid booking requests by (dep, arr, flight, cabin, date) in a range of days.
    A booking is unpaid when its user has no payment request the same day."""
    d = between(req, start, end)
    keys = ["dep", "arr", "flight_no", "cabin", "flight_date"]
    books = d.filter(F.col("step") == "book").select("user_id", "day", *keys)
    pays = d.filter(F.col("step") == "pay").select("user_id", "day").distinct()
    return books.join(pays, ["user_id", "day"], "left_anti").groupBy(*keys).agg(F.count(F.lit(1)).alias("unpaid_bookings"))


def look_to_book(req: DataFrame) -> DataFrame:
    """V8: queries / bookings per day and user class, plus ``all``."""
    r = req.rollup("day", "user_class").agg(
        F.count_if(F.col("step") == "query").cast("bigint").alias("queries"),
        F.count_if(F.col("step") == "book").cast("bigint").alias("bookings"),
        F.grouping("user_class").alias("_g"))
    r = r.filter(F.col("day").isNotNull()).withColumn(
        "user_class", F.when(F.col("_g") == 1, F.lit("all")).otherwise(F.col("user_class"))).drop("_g")
    return r.withColumn("look_to_book", F.round(F.try_divide(F.col("queries"), F.col("bookings")), 6))


def user_class_counts(req: DataFrame) -> DataFrame:
    """Distinct users per day in each class, from one row per user and day."""
    return _per_key(req, "user_id").groupBy("day").agg(
        *[F.count_if(F.col("key").isNotNull() & _has(_seen(c))).cast("bigint").alias(c) for c in CLASSES])


def customer_type_daily(req: DataFrame) -> DataFrame:
    """Distinct users per day and customer type (0 all, 1 normal, 2 agents); each type has a
    row for every day between the first and the last, NULL where nobody came."""
    agent = F.col("is_agent")
    n = req.groupBy("day").agg(F.count_distinct("user_id").alias("0"),
                               F.count_distinct(F.when(~agent, F.col("user_id"))).alias("1"),
                               F.count_distinct(F.when(agent, F.col("user_id"))).alias("2"))
    rows = date_spine(n).unpivot(["day"], ["0", "1", "2"], "customer_type", "users")
    return rows.select("day", F.col("customer_type").cast("int").alias("customer_type"), F.nullif("users", F.lit(0)).alias("users"))


def traffic_share(req: DataFrame) -> DataFrame:
    """Total and scraper requests per day and the scraper share."""
    t = req.groupBy("day").agg(F.count(F.lit(1)).alias("total_requests"),
                               F.count_if("is_scraper").cast("bigint").alias("scraper_requests"))
    return t.withColumn("scraper_share",
                        F.round(F.try_divide(F.col("scraper_requests"), F.col("total_requests")), 6))


def date_spine(series: DataFrame, day_col: str = "day") -> DataFrame:
    """One row per calendar day between the first and last day; NULL where
    the series has no value. The range is one aggregated row, the spine is
    bounded by the number of days."""
    rng = series.agg(F.min(day_col).alias("_lo"), F.max(day_col).alias("_hi"))
    spine = rng.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias(day_col))
    return spine.join(series, day_col, "left")


def scraper_daily_cumulative(req: DataFrame) -> DataFrame:
    """Distinct IPs today, distinct scraper IPs today, cumulative scrapers.

    One pass: requests are reduced to one row per IP and day, an IP's first day as a scraper is a
    window over its days, and all three counts come from that table."""
    ips = req.groupBy("remote_addr", "day").agg(F.max("is_scraper").alias("scr"))
    first = F.min(F.when(F.col("scr"), F.col("day"))).over(Window.partitionBy("remote_addr"))
    daily = ips.withColumn("first", first).groupBy("day").agg(
        F.count(F.lit(1)).alias("ips"), F.count_if("scr").cast("bigint").alias("scraper_ips"),
        F.count_if(F.col("day") == F.col("first")).alias("_new"))
    # one row per day: the ordered window runs on the small per-day table only
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("cumulative_scrapers", F.sum("_new").over(w).cast("bigint")).drop("_new")


def link_traffic(req: DataFrame, window: str = "1 hour") -> DataFrame:
    """Requests per server link per window and the total per window."""
    w = F.window("ts", window)
    per = req.groupBy(w.alias("w"), "server_addr").agg(F.count(F.lit(1)).alias("requests"))
    return per.withColumn("total_requests", F.sum("requests").over(Window.partitionBy("w"))) \
              .select(F.col("w.start").alias("window_start"), "server_addr", "requests", "total_requests")


def collection_stats(req: DataFrame, ref_day: str) -> DataFrame:
    """Per server, the latest active-connection count and the rows collected
    one, two and three days before ``ref_day``."""
    d = F.to_date(F.lit(ref_day))
    return req.groupBy("server_addr").agg(
        F.max_by("active_user_num", F.struct("ts", "active_user_num")).cast("bigint").alias("active_connections"),
        F.count_if(F.col("day") == F.date_sub(d, 1)).cast("bigint").alias("rows_day_minus_1"),
        F.count_if(F.col("day") == F.date_sub(d, 2)).cast("bigint").alias("rows_day_minus_2"),
        F.count_if(F.col("day") == F.date_sub(d, 3)).cast("bigint").alias("rows_day_minus_3"))
