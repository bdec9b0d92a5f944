"""Tagging (G1-G3, G6): request class, travel type, black-IP and critical flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions.text import xml_doc
from tollgate.functions.match import first_match_value, flag_any_match, inline_rules, match_by_index

OTHER = "Other"
# Fixed value: an ISO calendar date inside a referer.
DATE_IN_TEXT = r"(\d{4})-(0\d{1}|1[0-2])-(0\d{1}|[12]\d{1}|3[01])"


def flag_critical(df: DataFrame, rules: DataFrame, url_col: str = "url",
                  out: str = "is_critical") -> DataFrame:
    return flag_any_match(df, url_col, rules, rules.columns[0], out)


def request_type(url: Column, rules: list[tuple[str, str, str]]) -> Column:
    """G1: first rule (in priority order) whose pattern fully matches wins."""
    cases = [(p, F.struct(F.lit(f).alias("flight_type"), F.lit(b).alias("behavior_type")))
             for p, f, b in rules]
    default = F.struct(F.lit(OTHER).alias("flight_type"), F.lit(OTHER).alias("behavior_type"))
    return first_match_value(F.coalesce(url, F.lit("")), cases, default)


def tag_request_type(df: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    rows = inline_rules(rules, "expression", "flight_type", "behavior_type", order_by="priority")
    if rows is not None:
        d = df.withColumn("_rt", request_type(F.col(url_col), rows))
    else:
        d = df.withColumn("_url", F.coalesce(F.col(url_col), F.lit("")))
        best = F.min_by(F.struct("flight_type", "behavior_type"), "priority")
        d = match_by_index(d, "_url", rules, "expression", best, "_rt").drop("_url")
    return (d.withColumn("flight_type", F.coalesce(F.col("_rt.flight_type"), F.lit(OTHER)))
             .withColumn("behavior_type", F.coalesce(F.col("_rt.behavior_type"), F.lit(OTHER)))
             .drop("_rt"))


def travel_type(referer: Column) -> Column:
    """One date in the referer -> OneWay, two -> RoundTrip, else Unknown."""
    n = F.regexp_count(F.coalesce(referer, F.lit("")), F.lit(DATE_IN_TEXT))
    return (F.when(n == 1, F.lit("OneWay")).when(n == 2, F.lit("RoundTrip"))
             .otherwise(F.lit("Unknown")))


def tag_travel_type(df: DataFrame, referer_col: str = "http_referer") -> DataFrame:
    return df.withColumn("travel_type", travel_type(F.col(referer_col)))


def tag_black_ip(df: DataFrame, black: DataFrame, ip_col: str = "remote_addr",
                 out: str = "high_freq_ip", black_col: str | None = None) -> DataFrame:
    """Exact membership of the IP in the black list (existence join)."""
    bcol = black_col or black.columns[0]
    bl = (black.select(F.col(bcol).alias("_black_ip")).where(F.col("_black_ip").isNotNull())
               .distinct().withColumn("_hit", F.lit(True)))
    return (df.join(bl, df[ip_col] == bl["_black_ip"], "left")
              .withColumn(out, F.coalesce(F.col("_hit"), F.lit(False)))
              .drop("_black_ip", "_hit"))


def xml_travel_type(xml: Column) -> Column:
    """``//SEGTYPE`` S -> OneWay, R -> RoundTrip, anything else (also XML that does not parse) -> Unknown."""
    seg = F.xpath_string(xml_doc(xml), F.lit("//SEGTYPE"))
    return F.when(seg == "S", F.lit("OneWay")).when(seg == "R", F.lit("RoundTrip")).otherwise(F.lit("Unknown"))
