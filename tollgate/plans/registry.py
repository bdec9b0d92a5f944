"""Registered queries: each reads the driver tables under ``base_dir`` (whole
tables, no sampling) and has, where SQL can express it, a DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.text import format_batch_time
from tollgate.plans import oracle as O
from tollgate.sources import dimensions as dim
from tollgate.sources.requests import load_requests
from tollgate.operators import metrics as M
from tollgate.operators.scoring import RuleBook, blacklist_decisions, evaluate_rules, flow_scores
from tollgate.operators.tags import flag_critical

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _fmt(c: str) -> F.Column:
    return format_batch_time(F.col(c)).alias(c)


def tagged_requests(spark: SparkSession, base_dir: str) -> DataFrame:
    return flag_critical(load_requests(spark, base_dir), dim.critical_page_rules(spark))


class Tables:
    """The derived tables of one query: each is opened once while the query is built."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark, self.base_dir = spark, base_dir

    @cached_property
    def requests(self) -> DataFrame:
        return load_requests(self.spark, self.base_dir)

    @cached_property
    def tagged(self) -> DataFrame:
        return flag_critical(self.requests, dim.critical_page_rules(self.spark))

    @cached_property
    def bookings(self) -> DataFrame:
        from tollgate.sources.bookings import bookings
        return bookings(self.spark, self.base_dir)


# ---- step 1: requests -> critical flag -> top IPs (P14, F3, A2, A3, N4) -------

TOP_N = 20


@register("top_ip_access", O.with_requests(f"""
SELECT remote_addr AS ip, count(*) AS access_count,
       count(*) FILTER (WHERE {O.CRITICAL}) AS critical_count,
       split_part(remote_addr, '.', 1) || '.' || split_part(remote_addr, '.', 2) AS ip_block
FROM requests GROUP BY remote_addr
ORDER BY access_count DESC, ip LIMIT {TOP_N}"""))
def top_ip_access(spark: SparkSession, base_dir: str) -> DataFrame:
    from tollgate.operators.ranking import top_n
    from tollgate.functions.text import ip_block
    r = tagged_requests(spark, base_dir)
    m = r.groupBy(F.col("remote_addr").alias("ip")).agg(
        F.count(F.lit(1)).alias("access_count"),
        F.count_if("is_critical").cast("bigint").alias("critical_count"))
    return top_n(m.withColumn("ip_block", ip_block(F.col("ip"))),
                 [F.desc("access_count"), F.asc("ip")], TOP_N)


@register("requests_table", O.with_requests("SELECT * FROM requests"))
def requests_table(spark: SparkSession, base_dir: str) -> DataFrame:
    return load_requests(spark, base_dir)


# ---- step 2: all per-IP metrics in one grouped pass (A1-A8, N1) --------------

HOUR_MS = 3_600_000
DAY_MS = 86_400_000


def _metrics_query(window, slide, gap_ms):
    def run(spark: SparkSession, base_dir: str) -> DataFrame:
        m = M.ip_metrics(tagged_requests(spark, base_dir), window=window, slide=slide, gap_ms=gap_ms)
        return m.select(_fmt("window_start"), _fmt("window_end"), "ip", *M.WIDE_METRICS)
    return run


def _block_query(window, slide):
    def run(spark: SparkSession, base_dir: str) -> DataFrame:
        m = M.ip_block_counts(load_requests(spark, base_dir), window=window, slide=slide)
        return m.select(_fmt("window_start"), _fmt("window_end"), "ip_block", "access_count")
    return run


for _name, _w, _s, _wms, _sms, _gap in [
        ("ip_metrics_total", None, None, None, None, HOUR_MS),
        ("ip_metrics_daily", "1 day", None, DAY_MS, DAY_MS, HOUR_MS),
        ("ip_metrics_hourly", "1 hour", None, HOUR_MS, HOUR_MS, 600_000),
        ("ip_metrics_sliding_5m_5s", "5 minutes", "5 seconds", 300_000, 5_000, 5_000),
        ("ip_metrics_sliding_5m_2m", "5 minutes", "2 minutes", 300_000, 120_000, 60_000)]:
    register(_name, O.metrics_sql(_wms, _sms, _gap))(_metrics_query(_w, _s, _gap))

for _name, _w, _s, _wms, _sms in [
        ("ip_block_total", None, None, None, None),
        ("ip_block_daily", "1 day", None, DAY_MS, DAY_MS),
        ("ip_block_sliding_1h_10m", "1 hour", "10 minutes", HOUR_MS, 600_000)]:
    register(_name, O.ip_block_sql(_wms, _sms))(_block_query(_w, _s))


@register("ip_metrics_long_daily", O.metrics_long_sql(DAY_MS, DAY_MS, HOUR_MS))
def ip_metrics_long_daily(spark: SparkSession, base_dir: str) -> DataFrame:
    m = M.ip_metrics(tagged_requests(spark, base_dir), window="1 day", gap_ms=HOUR_MS)
    long = M.to_long(m)
    return long.select(_fmt("window_start"), _fmt("window_end"), "metric", "key", "value")


# ---- step 3: ingest, redact, tag and parse (P1-P13, F1-F6, G1-G3, X1-X4, X7) ----

@register("raw_line_ingest", O.RAW_LINE_INGEST)
def raw_line_ingest(spark: SparkSession, base_dir: str) -> DataFrame:
    from tollgate.plans.preprocess import parse_complete_lines
    from tollgate.sources.requests import raw_lines
    parsed = parse_complete_lines(raw_lines(load_requests(spark, base_dir)))
    return parsed.select("event_id", "remote_addr", "request", "time_iso8601", "active_user_num",
                         F.col("is_valid_number").alias("accepted"))


def _preprocessed(spark, base_dir):
    from tollgate.plans.preprocess import Dimensions, process_messages, requests_as_messages
    msgs = requests_as_messages(load_requests(spark, base_dir))
    return process_messages(msgs, Dimensions.defaults(spark))


@register("preprocessed_requests", O.PREPROCESSED)
def preprocessed_requests(spark: SparkSession, base_dir: str) -> DataFrame:
    p = _preprocessed(spark, base_dir)
    q, b = F.col("query_data"), F.col("book_data")
    return p.select(
        "event_id", "url", "flight_type", "behavior_type", "travel_type", "high_freq_ip",
        "session_id", "user_id", F.col("http_cookie").alias("redacted_cookie"),
        q["dep_city"].alias("q_dep_city"), q["arr_city"].alias("q_arr_city"),
        q["flight_date"].alias("q_flight_date"), q["adult_num"].alias("q_adult_num"),
        q["travel_type"].alias("q_travel_type"), q["flight_type"].alias("q_flight_type"),
        F.array_join(b["dep_city"], ",").alias("b_dep_city"),
        F.array_join(b["arr_city"], ",").alias("b_arr_city"),
        F.array_join(b["flight_date"], ",").alias("b_flight_date"),
        b["contact_phone"].alias("b_contact_phone"), b["flight_type"].alias("b_flight_type"),
        F.col("core_params.dep_city").alias("core_dep_city"),
        F.col("core_params.arr_city").alias("core_arr_city"),
        F.col("core_params.flight_date").alias("core_flight_date"))


@register("preprocessed_formats", O.PREPROCESSED_FORMATS)
def preprocessed_formats(spark: SparkSession, base_dir: str) -> DataFrame:
    """Every query and booking format, with rows that do not parse among good ones."""
    from tollgate.functions.text import iso_to_millis
    from tollgate.plans.preprocess import Dimensions, process_messages
    from tollgate.sources.requests import request_formats
    p = process_messages(request_formats(load_requests(spark, base_dir)), Dimensions.defaults(spark))
    q, b = F.col("query_data"), F.col("book_data")
    return p.select(
        "event_id", "behavior_type", "parse_failed", "session_id", iso_to_millis(F.col("time_iso8601")).alias("time_ms"),
        *[q[c].alias(f"q_{c}") for c in ("is_empty", "dep_city", "arr_city", "flight_date", "adult_num", "child_num", "travel_type")],
        *[b[c].alias(f"b_{c}") for c in ("user_id", "contact_name", "contact_phone")],
        *[F.array_join(b[c], ",").alias(f"b_{c}") for c in ("psg_name", "psg_type", "id_type", "id_card", "dep_city", "arr_city",
                                                            "flight_date", "flight_no", "cabin")],
        F.col("core_params.dep_city").alias("core_dep_city"))


MANY_RULES = 5_000


@register("rule_match_many", O.rule_match_many_sql(MANY_RULES))
def rule_match_many(spark: SparkSession, base_dir: str) -> DataFrame:
    """Thousands of overlapping rules against every request's session (G1 beyond the inline size)."""
    from tollgate.operators.tags import tag_request_type
    i = F.col("id")
    rules = spark.range(MANY_RULES).select(
        i.alias("priority"), F.concat(F.lit("S"), i.cast("string"), F.lit("[0-9]?-([0-4])")).alias("expression"),
        F.concat(F.lit("F"), (i % 7).cast("string")).alias("flight_type"),
        F.concat(F.lit("B"), i.cast("string")).alias("behavior_type"))
    r = load_requests(spark, base_dir).select("event_id", "session_id")
    return tag_request_type(r, rules, "session_id")


@register("redact_documents", O.REDACT_DOCUMENTS)
def redact_documents(spark: SparkSession, base_dir: str) -> DataFrame:
    from tollgate.functions.redact import PHONE_PATTERN, redact_phone
    from tollgate.sources.tables import read_table
    d = read_table(spark, base_dir, "documents").select("doc_id", "text")
    n = F.size(F.regexp_extract_all(F.col("text"), F.lit(PHONE_PATTERN), 0)).cast("bigint")
    return d.select("doc_id", n.alias("phone_matches"),
                    redact_phone(F.col("text")).alias("redacted_text"))


@register("redact_identity_cards", O.REDACT_IDENTITY)
def redact_identity_cards(spark: SparkSession, base_dir: str) -> DataFrame:
    """P7 over a text with identity numbers of every form for each customer."""
    from tollgate.functions.redact import redact_id_card
    from tollgate.sources.tables import read_table
    c = read_table(spark, base_dir, "customer").select("c_custkey")
    key = F.col("c_custkey").cast("string")

    def number(digits, fill):
        return F.lpad(key, digits, fill)
    k = F.col("c_custkey") % 5
    text = (F.when(k == 0, F.concat(F.lit("id="), number(18, "3"), F.lit(";")))
            .when(k == 1, F.concat(F.lit("card "), number(17, "4"), F.lit("X, "), number(17, "5"), F.lit("x")))
            .when(k == 2, F.concat(number(15, "6"), F.lit(" "), number(15, "7")))
            .when(k == 3, F.concat(F.lit("short "), number(14, "8"))).otherwise(F.lit("none")))
    return c.select("c_custkey", redact_id_card(text).alias("redacted_text"))


@register("record_round_trip", O.RECORD_ROUND_TRIP)
def record_round_trip(spark: SparkSession, base_dir: str) -> DataFrame:
    """Query and booking records written as nineteen-field lines and read back."""
    from tollgate.functions.codec import from_record_line, to_record_line
    from tollgate.operators.filters import by_behavior
    from tollgate.plans.preprocess import structured
    rec = by_behavior(structured(_preprocessed(spark, base_dir)), "Query", "Book")
    rec = rec.withColumn("source_data", F.col("event_id").cast("string"))
    back = from_record_line(rec.select(to_record_line(rec).alias("value")))
    q, b = F.col("query_data"), F.col("book_data")
    return back.select(F.col("source_data").cast("bigint").alias("event_id"), F.col("request").alias("url"), "flight_type", "behavior_type",
                       "travel_type", "high_freq_ip", "session_id", "user_id",
                       *[F.col(c).alias(f"core_{c}") for c in ("dep_city", "arr_city", "flight_date")],
                       q["dep_city"].alias("q_dep_city"), q["adult_num"].alias("q_adult_num"), q["travel_type"].alias("q_travel_type"),
                       F.array_join(b["dep_city"], ",").alias("b_dep_city"), b["flight_type"].alias("b_flight_type"))


@register("xml_travel_types", O.XML_TRAVEL_TYPES)
def xml_travel_types(spark: SparkSession, base_dir: str) -> DataFrame:
    """G6 over an XML booking for each order; one in four is malformed, one names no known type."""
    from tollgate.operators.tags import xml_travel_type
    from tollgate.sources.tables import read_table
    o = read_table(spark, base_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey") % 4
    seg = F.when(k == 0, F.lit("S")).when(k == 1, F.lit("R")).otherwise(F.lit("Q"))
    xml = F.concat(F.lit("<page><SEGMENT><SEGTYPE>"), seg, F.lit("</SEGTYPE></SEGMENT>"), F.when(k == 3, F.lit("<open>")).otherwise(F.lit("")),
                   F.lit("</page>"))
    return o.select("o_orderkey", xml_travel_type(xml).alias("travel_type"))


# ---- step 6: booking-side catalogue (bookings, payments, cancellations, unpaid) ----

def _booking_metrics(window):
    def run(spark: SparkSession, base_dir: str) -> DataFrame:
        from tollgate.operators.catalogue import booking_metrics
        from tollgate.sources.bookings import booking_events, bookings
        m = booking_metrics(booking_events(bookings(spark, base_dir)), window)
        return m.select(_fmt("window_start"), _fmt("window_end"), "key_kind", "key",
                        "bookings", "payments", "cancellations")
    return run


def _unpaid(window):
    def run(spark: SparkSession, base_dir: str) -> DataFrame:
        from tollgate.operators.catalogue import unpaid_bookings
        from tollgate.sources.bookings import booking_events, bookings
        u = unpaid_bookings(booking_events(bookings(spark, base_dir)), window)
        return u.select(_fmt("window_start"), _fmt("window_end"), "key_kind", "key", "unpaid")
    return run


register("booking_metrics_daily", O.booking_metrics_sql(DAY_MS))(_booking_metrics("1 day"))
register("booking_metrics_total", O.booking_metrics_sql(None))(_booking_metrics(None))
register("booking_metrics_hourly", O.booking_metrics_sql(HOUR_MS))(_booking_metrics("1 hour"))
register("unpaid_bookings_hourly", O.unpaid_sql(HOUR_MS))(_unpaid("1 hour"))
register("unpaid_bookings_daily", O.unpaid_sql(DAY_MS))(_unpaid("1 day"))
register("unpaid_bookings_total", O.unpaid_sql(None))(_unpaid(None))


# ---- step 5: scoring and blacklist (B1-B7, J5-J7) -----------------------------

# Fixed value: the reference instant for expiry in the restore query.
RESTORE_NOW = "2024-01-20 00:00:00"


def metrics_long(tables: Tables, gaps: list[int], metrics: set[str] | None = None, window: str = "1 day") -> DataFrame:
    """Metrics of one tier in long form: per-IP (A2-A8), per block (A1) and the
    booking-side catalogue; close intervals are counted by ``gaps`` (the arg1 of the tier's rules).
    ``metrics`` limits the output to the named metrics, and only what they need
    is computed (Catalyst prunes the unused aggregates and branches)."""
    from tollgate.operators.catalogue import (CATALOGUE_MEASURES, booking_metrics, catalogue_long,
                                              unpaid_bookings)
    from tollgate.sources.bookings import booking_events

    def want(m):
        return metrics is None or m in metrics
    parts = []
    ip_names = {v for v in M.METRIC_NAMES.values() if want(v)}
    if ip_names:
        wide = M.ip_metrics(tables.tagged, window=window, gap_ms=gaps)
        parts.append(M.to_long(wide, only=ip_names))
    if want("ip_block_access"):
        parts.append(M.ip_block_counts(tables.requests, window=window).select(
            *M.WIN, F.lit("ip_block_access").alias("metric"), F.col("ip_block").alias("key"),
            F.col("access_count").alias("value")))
    cat = {(m, k) for m in CATALOGUE_MEASURES for k in ("ip_block", "buyer", "contact_name",
                                                         "contact_phone", "passenger", "contact")
           if want(f"{m}_by_{k}")}
    if cat:
        ev = booking_events(tables.bookings)
        measures = tuple(sorted({m for m, _ in cat}))
        kinds = {k for _, k in cat}
        bm = booking_metrics(ev, window, kinds, measures) if set(measures) - {"unpaid"} else None
        up = unpaid_bookings(ev, window, kinds) if "unpaid" in measures else None
        long = catalogue_long(bm, up, measures)
        if metrics is not None:
            long = long.where(F.col("metric").isin(sorted(metrics)))
        parts.append(long)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def _flow_scores(tables: Tables, window="1 day", rule_type=2, crawler_type=None):
    """Scores of one tier. With a crawler type only its rules, and only the metrics they name, run."""
    book = RuleBook.defaults(tables.spark)
    long = metrics_long(tables, book.gaps(rule_type), book.metrics(rule_type, crawler_type), window)
    return flow_scores(evaluate_rules(long, book, rule_type, crawler_type))


def _scores_query(window, rule_type):
    def run(spark: SparkSession, base_dir: str) -> DataFrame:
        s = _flow_scores(Tables(spark, base_dir), window, rule_type)
        return s.select(_fmt("window_start"), _fmt("window_end"), "flow_id", "flow_name",
                        "crawler_type", "key", "score", "hit_rules")
    return run


register("flow_scores_daily", O.FLOW_SCORES)(_scores_query("1 day", 2))
register("flow_scores_hourly", O.FLOW_SCORES_TIER[1])(_scores_query("1 hour", 1))
register("flow_scores_5m", O.FLOW_SCORES_TIER[0])(_scores_query("5 minutes", 0))


def _blacklist(spark, base_dir, keep=()):
    from tollgate.operators.blacklist import to_blacklist_records
    return to_blacklist_records(blacklist_decisions(_flow_scores(Tables(spark, base_dir))), keep=keep)


@register("blacklist_daily", O.BLACKLIST)
def blacklist_daily(spark: SparkSession, base_dir: str) -> DataFrame:
    return _blacklist(spark, base_dir)


@register("blacklist_restore", O.RESTORE)
def blacklist_restore(spark: SparkSession, base_dir: str) -> DataFrame:
    from tollgate.operators.blacklist import restore
    now = F.unix_millis(F.to_timestamp(F.lit(RESTORE_NOW)))
    return restore(_blacklist(spark, base_dir), now).select("key", "key_exp_time", "value", "ttl_ms")


@register("blacklist_restore_hours", O.RESTORE_HOURS)
def blacklist_restore_hours(spark: SparkSession, base_dir: str) -> DataFrame:
    """IO14-IO17 through storage: records written by the hour of writing, current and previous hour
    read back, live keys left out."""
    import uuid

    from tollgate.operators.blacklist import hours_to_restore, read_hours, restore, write_hourly
    from tollgate.session import scratch_path
    path = scratch_path(spark, f"blacklist-{uuid.uuid4().hex}")
    records = _blacklist(spark, base_dir, keep=["window_end"])
    write_hourly(records.withColumnRenamed("window_end", "_at"), path, F.col("_at"), "daily")
    now_ms = 1_706_055_000_000                            # 2024-01-24 00:10:00 UTC
    live = load_requests(spark, base_dir).select("remote_addr").filter(F.col("remote_addr").startswith(O.LIVE_PREFIX)).distinct()
    written = read_hours(spark, path, hours_to_restore(now_ms))
    return restore(written, F.lit(now_ms), live).select("key", "key_exp_time", "value", "ttl_ms")


@register("metric_histogram_daily", O.HISTOGRAM)
def metric_histogram_daily(spark: SparkSession, base_dir: str) -> DataFrame:
    from tollgate.operators.scoring import metric_histogram
    h = metric_histogram(metrics_long(Tables(spark, base_dir), RuleBook.defaults(spark).gaps(2)))
    return h.select(_fmt("window_start"), _fmt("window_end"), "metric", "value", "key_count")


# ---- step 7: dashboards (V1-V16) -----------------------------------------------

AGENT_MIN_BUYERS = 2
REF_DAY = "2024-01-20"


def classified_requests(spark: SparkSession, base_dir: str, sets: str = "scraper hoarding agent") -> DataFrame:
    """Requests with travel type, day and the flags of the named key sets (and the user class, if all).

    Classes come from this data's own blacklist decisions and bookings. Scrapers alone are found without
    any booking, hoarders without the log; both together are scored in one plan.
    """
    from tollgate.operators.dashboards import agent_buyers, classify_users
    from tollgate.operators.tags import tag_travel_type
    tables = Tables(spark, base_dir)
    wanted = [k for k, name in enumerate(("scraper", "hoarding")) if name in sets]
    black = None
    if wanted:
        scores = _flow_scores(tables, crawler_type=wanted[0] if len(wanted) == 1 else None)
        black = blacklist_decisions(scores)
    return classify_users(tag_travel_type(tables.requests), black, {0, 1} & set(wanted),
                          agent_buyers(tables.bookings, AGENT_MIN_BUYERS) if "agent" in sets else None)


def _dash(name, fn_name, *args, sets="", select=None):
    def run(spark: SparkSession, base_dir: str) -> DataFrame:
        from tollgate.operators import dashboards as D
        out = getattr(D, fn_name)(classified_requests(spark, base_dir, sets), *args)
        return out.select(*select()) if select else out
    register(name, getattr(O, "DASH_" + name.upper()))(run)


_ALL = "scraper hoarding agent"
_dash("funnel_daily", "funnel")
_dash("funnel_by_class", "funnel_by_class", sets=_ALL)
_dash("funnel_scope", "funnel_scope", sets="scraper")
_dash("scraper_travel_frequency", "scraper_travel_frequency", sets="scraper")
_dash("scraper_route_ranking", "scraper_route_ranking", sets="scraper")
_dash("hoarding_flight_ranking", "hoarding_flight_ranking")
_dash("look_to_book", "look_to_book", sets=_ALL)
_dash("user_class_counts", "user_class_counts", sets=_ALL)
_dash("customer_type_daily", "customer_type_daily", sets="agent")
_dash("traffic_share", "traffic_share", sets="scraper")
_dash("scraper_daily_cumulative", "scraper_daily_cumulative", sets="scraper")
_dash("link_traffic_hourly", "link_traffic", "1 hour",
      select=lambda: [_fmt("window_start"), "server_addr", "requests", "total_requests"])
_dash("collection_stats", "collection_stats", REF_DAY)


@register("scraper_traffic_spine", O.DASH_SCRAPER_TRAFFIC_SPINE)
def scraper_traffic_spine(spark: SparkSession, base_dir: str) -> DataFrame:
    from tollgate.operators.dashboards import date_spine
    c = classified_requests(spark, base_dir, "scraper")
    series = c.filter("is_scraper").groupBy("day").agg(F.count(F.lit(1)).alias("scraper_requests"))
    return date_spine(series)


# ---- step 9: detectors (V18-V21) ---------------------------------------------------
# Trained models have no SQL twin; the accuracy tables do, over a threshold rule as the predictor.

def _features(spark: SparkSession, base_dir: str) -> DataFrame:
    """Daily metric vectors with the rule verdict, written once: both models read them many times."""
    from tollgate.operators.detectors import feature_frame
    from tollgate.plans.jobs import materialise
    tables, gaps = Tables(spark, base_dir), RuleBook.defaults(spark).gaps(2)
    wide = M.ip_metrics(tables.tagged, window="1 day", gap_ms=gaps)
    wide = wide.withColumnRenamed(f"close_interval_count_{gaps[0]}", "close_interval_count")
    dec = blacklist_decisions(_flow_scores(tables, crawler_type=0))
    return materialise(spark, feature_frame(wide, dec), "detector-features")


def _predictions(spark: SparkSession, base_dir: str) -> DataFrame:
    from tollgate.operators.detectors import decision_tree, kmeans
    feats = _features(spark, base_dir)
    cols = ["model", "window_start", "ip", "label", "prediction"]
    return decision_tree(feats).select(*cols).unionByName(kmeans(feats).select(*cols))


@register("detector_accuracy_daily")
def detector_accuracy_daily(spark: SparkSession, base_dir: str) -> DataFrame:
    """Accuracy of the trained models on all rows, each predicted without its IP in training."""
    from tollgate.operators.detectors import accuracy_by_date
    return accuracy_by_date(_predictions(spark, base_dir))


@register("detector_fit_rate")
def detector_fit_rate(spark: SparkSession, base_dir: str) -> DataFrame:
    from tollgate.operators.detectors import fit_rate
    return fit_rate(_predictions(spark, base_dir))


def _threshold_predictions(spark: SparkSession, base_dir: str) -> DataFrame:
    from tollgate.operators.detectors import threshold_rule
    return threshold_rule(_features(spark, base_dir), "critical_count", THRESHOLD)


THRESHOLD = 2


@register("threshold_accuracy_daily", O.threshold_accuracy_sql(THRESHOLD))
def threshold_accuracy_daily(spark: SparkSession, base_dir: str) -> DataFrame:
    from tollgate.operators.detectors import accuracy_by_date
    return accuracy_by_date(_threshold_predictions(spark, base_dir))


@register("threshold_fit_rate", O.threshold_fit_sql(THRESHOLD))
def threshold_fit_rate(spark: SparkSession, base_dir: str) -> DataFrame:
    from tollgate.operators.detectors import fit_rate
    return fit_rate(_threshold_predictions(spark, base_dir))


# ---- link statistics (A9, A10) ---------------------------------------------------

@register("link_stats_hourly", O.LINK_STATS)
def link_stats_hourly(spark: SparkSession, base_dir: str) -> DataFrame:
    """Requests per server link and its latest active-connection count per hour."""
    s = M.link_counts(load_requests(spark, base_dir), window="1 hour")
    return s.select(_fmt("window_start"), _fmt("window_end"), "server_addr", "request_count",
                    "active_user_num")


# ---- streaming jobs over the same tables: stream == batch (W1-W6, IO1, IO11, IO13) ---------------

def _streamed_requests(spark: SparkSession, base_dir: str) -> DataFrame:
    """The derived access log as a stream of the events table's files."""
    from tollgate.sources.requests import requests_from_events
    base = base_dir.rstrip("/")
    schema = spark.read.parquet(f"{base}/events.parquet").schema
    return requests_from_events(spark.readStream.schema(schema).parquet(f"{base}/{{events}}.parquet"))   # a pattern: one file or a folder


@register("stream_preprocess_records", O.STREAM_RECORDS)
def stream_preprocess_records(spark: SparkSession, base_dir: str) -> DataFrame:
    """Raw lines through the streaming pre-process job; the records it has written, equal ones counted."""
    import uuid

    from tollgate.session import scratch_path
    from tollgate.sources.requests import raw_lines
    from tollgate.streaming.preprocess_job import start_preprocess
    base = scratch_path(spark, f"stream-records-{uuid.uuid4().hex}")
    lines = raw_lines(_streamed_requests(spark, base_dir)).select("value")
    start_preprocess(lines, f"{base}/out", f"{base}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    keys = ["request", "flight_type", "behavior_type", "travel_type", "high_freq_ip", "session_id", "user_id", "dep_city", "arr_city",
            "flight_date"]
    return spark.read.parquet(f"{base}/out/records").groupBy(*keys).agg(F.count(F.lit(1)).alias("records"))


STREAM_WINDOW, STREAM_SLIDE, STREAM_TIER, STREAM_GAP = "1 hour", "10 minutes", 1, 300_000


@register("stream_ip_metrics_1h_10m", O.stream_metrics_sql(HOUR_MS, 600_000, 600_000, STREAM_GAP))
def stream_ip_metrics_1h_10m(spark: SparkSession, base_dir: str) -> DataFrame:
    """Requests through the streaming metrics job; the closed windows of IPs that it has written."""
    import uuid

    from tollgate.session import scratch_path
    from tollgate.streaming import metrics_job as job
    base = scratch_path(spark, f"stream-metrics-{uuid.uuid4().hex}")
    rows = job.prepare(flag_critical(_streamed_requests(spark, base_dir), dim.critical_page_rules(spark)))

    def loader(s: SparkSession) -> job.Rules:
        return job.Rules(dim.critical_page_rules(s), RuleBook.defaults(s))
    job.start_scores(rows, f"{base}/out", f"{base}/checkpoint", loader, window=STREAM_WINDOW, slide=STREAM_SLIDE, watermark="0 seconds",
                     rule_type=STREAM_TIER, trigger={"availableNow": True}).awaitTermination()
    m = spark.read.parquet(f"{base}/out/metrics").filter("scope = 'ip'")
    return m.select(_fmt("window_start"), _fmt("window_end"), F.col("key").alias("ip"),
                    *[F.col(f"{c}_{STREAM_GAP}" if c == "close_interval_count" else c).alias(c) for c in M.WIDE_METRICS])
