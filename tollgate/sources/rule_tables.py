"""Loaders of a deployment's rule tables (IO7-IO10): column mapping, casts and filters (J6, J7 read the last four).

A table is opened by its name, from a folder of parquet tables or through JDBC, and only the columns
of the record layout are selected; equality filters are part of the plan, so the scan (or the database) applies them.
Rule tables are configuration and small, but nothing here depends on that.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.sources.dimensions import PARSE_RULE_SCHEMA

Open = Callable[[str], DataFrame]

# Names of the stored tables and columns, and the ids stored for flight and behaviour types.
URL_FILTERS = ("nh_filter_rule", "value")
CLASSIFICATION = "nh_classify_rule"
BLACK_IPS = ("nh_ip_blacklist", "ip_name")
CRITICAL_PAGES = ("nh_query_critical_pages", "criticalPageMatchExpression")
PARSE_RULES = "analyzerule"
FLOWS = "nh_process_info"
STRATEGIES = "nh_strategy"
SCORE_RULES = "nh_rule"
MAINTENANCE = "nh_rules_maintenance_table"
FLIGHT_TYPES = {0: "National", 1: "International"}
BEHAVIOR_TYPES = {0: "Query", 1: "Book"}
PARSE_RULE_COLUMNS = {
    "rule_id": "id",
    "request_match": "requestMatchExpression",
    "request_method": "requestMethod",
    "is_normal_get": "isNormalGet",
    "is_normal_form": "isNormalForm",
    "is_application_json": "isApplicationJson",
    "is_text_xml": "isTextXml",
    "is_json": "isJson",
    "is_xml": "isXML",
    "form_data_field": "formDataField",
    "q_dep_city": "query_depCity",
    "q_arr_city": "query_arrCity",
    "q_flight_date": "query_flightDate",
    "q_adult_num": "query_adultNum",
    "q_child_num": "query_childNum",
    "q_infant_num": "query_infantNum",
    "q_country": "query_country",
    "q_travel_type": "query_travelType",
    "b_user_id": "book_bookUserId",
    "b_agent": "book_bookUnUserId",
    "b_psg_first_name": "book_psgFirName",
    "b_psg_name": "book_psgName",
    "b_psg_type": "book_psgType",
    "b_id_type": "book_idType",
    "b_id_card": "book_idCard",
    "b_contact_name": "book_contractName",
    "b_contact_phone": "book_contractPhone",
    "b_dep_city": "book_depCity",
    "b_arr_city": "book_arrCity",
    "b_flight_date": "book_flightDate",
    "b_flight_no": "book_flightNo",
    "b_cabin": "book_cabin",
}


def open_tables(spark: SparkSession, source: str | dict) -> Open:
    """How to open a table by its name: a folder of parquet tables, or JDBC options (url, user, ...)."""
    if isinstance(source, dict):
        return lambda name: spark.read.format("jdbc").options(**source).option("dbtable", name).load()
    return lambda name: spark.read.parquet(f"{source.rstrip('/')}/{name}")


def single_column(opened: Open, table: str, column: str) -> DataFrame:
    """IO7: one column of a table, without nulls."""
    return opened(table).select(column).where(F.col(column).isNotNull())


def url_filter_rules(opened: Open) -> DataFrame:
    return single_column(opened, *URL_FILTERS)


def black_ips(opened: Open) -> DataFrame:
    return single_column(opened, *BLACK_IPS)


def critical_page_rules(opened: Open) -> DataFrame:
    table, column = CRITICAL_PAGES
    return single_column(opened, table, column).withColumnRenamed(column, "expression")


def _named(stored: Column, names: dict[int, str]) -> Column:
    """The name of a stored id; ids are stored as numbers or as text."""
    return reduce(lambda c, k: F.when(stored.cast("int") == k, F.lit(names[k])).otherwise(c), names, F.lit(None).cast("string"))


def classify_rules(opened: Open) -> DataFrame:
    """IO9: one scan for all flight and operation types; national before international, queries before bookings."""
    t = opened(CLASSIFICATION).select("flight_type", "operation_type", "expression").where(
        F.col("flight_type").isin(*FLIGHT_TYPES) & F.col("operation_type").isin(*BEHAVIOR_TYPES) & F.col("expression").isNotNull())
    return t.select((F.col("flight_type").cast("int") * len(BEHAVIOR_TYPES) + F.col("operation_type").cast("int")).alias("priority"),
                    "expression", _named(F.col("flight_type"), FLIGHT_TYPES).alias("flight_type"),
                    _named(F.col("operation_type"), BEHAVIOR_TYPES).alias("behavior_type"))


def parse_rules(opened: Open, behavior_type: int | None = None) -> DataFrame:
    """IO8: the parse rules, of one behaviour (0 query, 1 booking) or both, in the order of their ids.

    Ids and flags are stored as text in some deployments, so they are cast; a flag that is no boolean is false.
    """
    t = opened(PARSE_RULES)
    if behavior_type is not None:
        t = t.where(F.col("behavior_type") == behavior_type)
    kinds = dict(f.split(" ") for f in PARSE_RULE_SCHEMA.split(", "))
    derived = {"rule_order": F.col("id").cast("int"), "flight_type": F.coalesce(_named(F.col("flight_type"), FLIGHT_TYPES), F.lit("Other")),
               "behavior_type": _named(F.col("behavior_type"), BEHAVIOR_TYPES)}

    def column(name: str) -> Column:
        if name in derived:
            return derived[name]
        stored = F.col(PARSE_RULE_COLUMNS[name])
        return F.coalesce(stored.try_cast("boolean"), F.lit(False)) if kinds[name] == "boolean" else stored.cast(kinds[name])
    return t.select(*[column(c).alias(c) for c in kinds])


def flows(opened: Open) -> DataFrame:
    return opened(FLOWS).select(F.col("id").cast("int").alias("flow_id"), F.col("process_name").alias("flow_name"),
                                F.col("status").cast("int").alias("status"))


def strategies(opened: Open) -> DataFrame:
    return opened(STRATEGIES).select(F.col("id").cast("int").alias("flow_id"),
                                     F.col("crawler_blacklist_thresholds").cast("double").alias("crawler_threshold"),
                                     F.col("occ_blacklist_thresholds").cast("double").alias("occ_threshold"))


def score_rules(opened: Open) -> DataFrame:
    return opened(SCORE_RULES).select(
        F.col("id").cast("int").alias("rule_id"), F.col("process_id").cast("int").alias("flow_id"), "rule_name",
        *[F.col(c).cast("int").alias(c) for c in ("rule_type", "crawler_type", "status")],
        F.col("arg0").cast("double").alias("arg0"), F.col("arg1").cast("double").alias("arg1"), F.col("score").cast("int").alias("score"))


def maintenance(opened: Open) -> DataFrame:
    """The metric that a rule name reads. How it compares is not stored: least intervals hit below, all else from their value on."""
    metric = F.col("rule_real_name")
    return opened(MAINTENANCE).select("rule_name", metric.alias("metric"),
                                      F.when(metric == "critical_min_interval", F.lit("<")).otherwise(F.lit(">=")).alias("cmp"))
