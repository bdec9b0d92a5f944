"""Pre-process job as one plan: raw line -> filter -> redact -> tag -> parse ->
structured record. Everything is a native expression pipelined in one stage;
the only join is the black-IP existence join (broadcast behind a size check).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.codec import parse_raw
from tollgate.functions.redact import redact_id_card, redact_phone
from tollgate.functions.text import (SESSION_COOKIE_KEY, USER_COOKIE_KEY, cookie_map,
                                     cookie_value, url_path)
from tollgate.operators.filters import drop_filtered_urls, keep_complete_lines
from tollgate.operators.parse import ParseRules, core_params, parse_book, parse_query
from tollgate.operators.tags import tag_black_ip, tag_request_type, tag_travel_type
from tollgate.sources import dimensions as dim
from tollgate.sources import rule_tables


@dataclass
class Dimensions:
    url_filter: DataFrame
    classify: DataFrame
    parse_rules: DataFrame
    black_ips: DataFrame
    critical_pages: DataFrame

    @classmethod
    def defaults(cls, spark: SparkSession) -> "Dimensions":
        return cls(dim.url_filter_rules(spark), dim.classify_rules(spark), dim.parse_rules(spark),
                   dim.black_ips(spark), dim.critical_page_rules(spark))

    @classmethod
    def from_tables(cls, spark: SparkSession, source: str | dict) -> "Dimensions":
        """The rule tables of a deployment: a folder of parquet tables, or JDBC options."""
        opened = rule_tables.open_tables(spark, source)
        return cls(rule_tables.url_filter_rules(opened), rule_tables.classify_rules(opened), rule_tables.parse_rules(opened),
                   rule_tables.black_ips(opened), rule_tables.critical_page_rules(opened))


def parse_complete_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """F1 + P1 in one pass: complete lines parsed to columns, flagged by
    ``is_valid_number`` (False rows belong to the reject output)."""
    return parse_raw(keep_complete_lines(lines, value_col), value_col)


def ingest_lines(lines: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """F1 + P1: (accepted, rejected-number) rows."""
    parsed = parse_complete_lines(lines, value_col)
    return parsed.filter("is_valid_number"), parsed.filter(~F.col("is_valid_number"))


def process_messages(msgs: DataFrame, dims: Dimensions, bounded_phone: bool = False) -> DataFrame:
    """F2, P6/P7, P2-P5, G1-G3, X1-X10, P9 on twelve-column messages."""
    rules = ParseRules(dims.parse_rules)
    d = drop_filtered_urls(msgs, dims.url_filter, "request")
    d = d.withColumn("http_cookie", redact_phone(F.col("http_cookie"), bounded_phone))
    d = d.withColumn("http_cookie", redact_id_card(F.col("http_cookie")))
    d = d.withColumn("url", url_path(F.col("request")))
    cm = cookie_map(F.col("http_cookie"))
    d = d.withColumn("_cookies", cm) \
         .withColumn("session_id", cookie_value(F.col("_cookies"), SESSION_COOKIE_KEY)) \
         .withColumn("user_id", cookie_value(F.col("_cookies"), USER_COOKIE_KEY)).drop("_cookies")
    d = tag_request_type(d, dims.classify, "url")
    d = tag_travel_type(d, "http_referer")
    d = parse_query(d, rules)
    d = parse_book(d, rules)
    d = tag_black_ip(d, dims.black_ips, "remote_addr", "high_freq_ip")
    return core_params(d)


def structured(processed: DataFrame) -> DataFrame:
    """The nineteen-field record as typed columns (flattened core params)."""
    return processed.select(
        F.lit(None).cast("string").alias("source_data"), "request_method",
        F.col("url").alias("request"), "remote_addr", "http_user_agent", "time_iso8601",
        "server_addr", "high_freq_ip", "flight_type", "behavior_type", "travel_type",
        F.col("core_params.flight_date").alias("flight_date"),
        F.col("core_params.dep_city").alias("dep_city"),
        F.col("core_params.arr_city").alias("arr_city"),
        "session_id", "user_id", "query_data", "book_data", "http_referer",
        *[c for c in ("event_id",) if c in processed.columns])


def requests_as_messages(requests: DataFrame) -> DataFrame:
    """The derived access log viewed as twelve-column messages (plus event_id)."""
    return requests.select("event_id", "time_local", "request", "request_method", "content_type",
                           "request_body", "http_referer", "remote_addr",
                           F.col("user_agent").alias("http_user_agent"), "time_iso8601",
                           "server_addr", "http_cookie", "active_user_num")
