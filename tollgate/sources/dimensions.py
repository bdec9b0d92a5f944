"""Rule dimensions: URL filter, request classes, critical pages, black IPs,
parse rules, score rules and detection flows.

Deployments read these from their own tables (``rule_tables.py``). The defaults below are our own
fixture rows, shaped like the reference's rule tables (their URL paths are those of its sample log),
so every registered query can run out of the box.
They are configuration, not data: a few rows that never grow with the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- Fixed default rule rows -------------------------------------------------
# URL filter: the whole request line (``METHOD url HTTP/x``) must match.
URL_FILTER_RULES = [
    r".*\.(png|jpg|jpeg|gif|ico)(\?[^ ]*)? .*",
    r".*\.(js|css)(\?[^ ]*)? .*",
]
# Request classes, in priority order: national query, national book,
# international query, international book (first hit wins, else Other).
CLASSIFY_RULES = [
    (r".*/query/jaxb/direct/query\.ao.*", "National", "Query"),
    (r".*/book/direct/order\.ao.*", "National", "Book"),
    (r".*/query/jaxb/inter/query\.ao.*", "International", "Query"),
    (r".*/book/inter/order\.ao.*", "International", "Book"),
    (r".*/query/(form|json|xml|body)\.ao.*", "National", "Query"),
    (r".*/book/(json|xml)\.ao.*", "National", "Book"),
]
# Critical pages (a URL matching two rules counts once).
CRITICAL_PAGE_RULES = [
    r".*/query/jaxb/.*\.ao.*",
    r".*query\.ao.*",
    r".*/book/.*/order\.ao.*",
]
# Blocked IPs (duplicates allowed in the source table).
BLACK_IPS = ["10.1.17.17", "10.2.10.42", "10.4.4.4", "10.2.10.42"]


def _literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def values(spark: SparkSession, rows, schema: str) -> DataFrame:
    """Rows as a table of values: the planner knows how small it is, and reads it without a job."""
    kinds = [f.split(" ", 1) for f in schema.split(", ")]
    body = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows)
    cast = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in kinds)
    names = ", ".join(name for name, _ in kinds)
    return spark.sql(f"SELECT {cast} FROM VALUES {body} AS t({names})")


def url_filter_rules(spark: SparkSession) -> DataFrame:
    return values(spark, [(r,) for r in URL_FILTER_RULES], "value string")


def classify_rules(spark: SparkSession) -> DataFrame:
    return values(spark, [(i, p, f, b) for i, (p, f, b) in enumerate(CLASSIFY_RULES)],
               "priority int, expression string, flight_type string, behavior_type string")


def critical_page_rules(spark: SparkSession) -> DataFrame:
    return values(spark, [(r,) for r in CRITICAL_PAGE_RULES], "expression string")


def black_ips(spark: SparkSession) -> DataFrame:
    return values(spark, [(ip,) for ip in BLACK_IPS], "ip_name string")


# ---- Parse rules (G4 / X1-X10) -------------------------------------------------
# Columns: rule_id, rule_order, flight_type, behavior_type, request_match,
# request_method, is_normal_get, is_normal_form, is_application_json, is_text_xml,
# is_json, is_xml, form_data_field, then the query paths (parameter names for
# GET/form, JSONPath for JSON, XPath for XML) and the book paths.
QUERY_PATH_FIELDS = ["q_dep_city", "q_arr_city", "q_flight_date", "q_adult_num",
                     "q_child_num", "q_infant_num", "q_country", "q_travel_type"]
BOOK_PATH_FIELDS = ["b_user_id", "b_psg_first_name", "b_psg_name", "b_psg_type", "b_id_type",
                    "b_id_card", "b_contact_name", "b_contact_phone", "b_agent", "b_dep_city",
                    "b_arr_city", "b_flight_date", "b_flight_no", "b_cabin"]
PARSE_RULE_SCHEMA = (
    "rule_id int, rule_order int, flight_type string, behavior_type string, request_match string, "
    "request_method string, is_normal_get boolean, is_normal_form boolean, "
    "is_application_json boolean, is_text_xml boolean, is_json boolean, is_xml boolean, "
    "form_data_field string, "
    + ", ".join(f"{c} string" for c in QUERY_PATH_FIELDS + BOOK_PATH_FIELDS))


def _rule(rule_id, order, flight, behavior, match, method, *, get=False, form=False,
          app_json=False, text_xml=False, is_json=False, is_xml=False, field=None,
          q=None, b=None):
    q = q or {}
    b = b or {}
    return (rule_id, order, flight, behavior, match, method, get, form, app_json, text_xml,
            is_json, is_xml, field, *[q.get(c) for c in QUERY_PATH_FIELDS],
            *[b.get(c) for c in BOOK_PATH_FIELDS])


_GET_QUERY = {"q_dep_city": "c1", "q_arr_city": "c2", "q_flight_date": "d1",
              "q_adult_num": "at", "q_child_num": "ct", "q_infant_num": "it"}
_JSON_BOOK = {"b_user_id": "$.userId", "b_psg_first_name": "$.passengers[*].firstName",
              "b_psg_name": "$.passengers[*].lastName", "b_psg_type": "$.passengers[*].type",
              "b_id_type": "$.passengers[*].idType", "b_id_card": "$.passengers[*].idNo",
              "b_contact_name": "$.contact.name", "b_contact_phone": "$.contact.phone",
              "b_dep_city": "$.depcity", "b_arr_city": "$.arrcity", "b_flight_date": "$.flightdate",
              "b_flight_no": "$.flightno", "b_cabin": "$.cabin"}
_XML_BOOK = {"b_user_id": "//USERID", "b_psg_name": "//PASSENGER/NAME", "b_psg_type": "//PASSENGER/TYPE",
             "b_id_type": "//PASSENGER/IDTYPE", "b_id_card": "//PASSENGER/IDNO",
             "b_contact_name": "//CONTACT/NAME", "b_contact_phone": "//CONTACT/PHONE",
             "b_dep_city": "//SEGMENT/DEPCITY", "b_arr_city": "//SEGMENT/ARRCITY",
             "b_flight_date": "//SEGMENT/DATE", "b_flight_no": "//SEGMENT/FLIGHTNO",
             "b_cabin": "//SEGMENT/CABIN"}
_XML_QUERY = {"q_dep_city": "//DEPCITY", "q_arr_city": "//ARRCITY", "q_flight_date": "//DATE",
              "q_adult_num": "//ADULT", "q_travel_type": "//TRAVELTYPE"}

# Fixed default parse rules (ours). Rule 1 maps the cities the wrong way round
# on purpose: rule 5 also matches national queries and, being later, wins.
PARSE_RULES = [
    _rule(1, 1, "National", "Query", r".*/query/jaxb/direct/query\.ao.*", "GET", get=True,
          q={**_GET_QUERY, "q_dep_city": "c2", "q_arr_city": "c1"}),
    _rule(2, 2, "International", "Query", r".*/query/jaxb/inter/query\.ao.*", "GET", get=True,
          q=_GET_QUERY),
    _rule(3, 3, "National", "Book", r".*/book/direct/order\.ao.*", "POST", is_json=True,
          field="json", b=_JSON_BOOK),
    _rule(4, 4, "International", "Book", r".*/book/inter/order\.ao.*", "POST", is_json=True,
          field="json", b=_JSON_BOOK),
    _rule(5, 5, "National", "Query", r".*/query/.*\.ao.*", "get", get=True, q=_GET_QUERY),
    _rule(6, 6, "National", "Query", r".*/query/form\.ao.*", "POST", form=True, q=_GET_QUERY),
    _rule(7, 7, "National", "Query", r".*/query/json\.ao.*", "POST", is_json=True, field="json",
          q={"q_dep_city": "$.depcity", "q_arr_city": "$.arrcity", "q_flight_date": "$.flightdate",
             "q_adult_num": "$.adultnum", "q_child_num": "$.childnum", "q_infant_num": "$.infantnum"}),
    _rule(8, 8, "National", "Query", r".*/query/xml\.ao.*", "POST", text_xml=True, is_xml=True,
          q=_XML_QUERY),
    _rule(9, 9, "National", "Book", r".*/book/xml\.ao.*", "POST", text_xml=True, is_xml=True,
          b=_XML_BOOK),
    _rule(10, 10, "National", "Book", r".*/book/json\.ao.*", "POST", app_json=True, is_json=True,
          b=_JSON_BOOK),
    _rule(11, 11, "National", "Query", r".*/query/body\.ao.*", "POST", app_json=True, is_json=True,
          q={"q_dep_city": "$.depcity", "q_arr_city": "$.arrcity", "q_flight_date": "$.flightdate",
             "q_adult_num": "$.adultnum"}),
]


def parse_rules(spark: SparkSession) -> DataFrame:
    return values(spark, PARSE_RULES, PARSE_RULE_SCHEMA)


# ---- Score rules and detection flows (B1-B3, J6, J7) -----------------------------
# Four tables: flows, their strategies (thresholds), their rules, and the maintenance table that says
# which metric a rule of a name reads and how it compares ('>=' for volumes, '<' for least intervals).
# Rule types: 0 real-time, 1 near-real-time (1 h), 2 offline (1 day);
# crawler type: 0 scraper, 1 seat-hoarding; status 0 = enabled.
FLOW_SCHEMA = "flow_id int, flow_name string, status int"
FLOWS = [(1, "default", 0), (2, "strict", 0), (3, "retired", 1), (4, "without strategy", 0)]

STRATEGY_SCHEMA = "flow_id int, crawler_threshold double, occ_threshold double"
STRATEGIES = [(1, 20.0, 5.0), (2, 4.0, 100.0), (3, 1.0, 1.0), (9, 1.0, 1.0)]

SCORE_RULE_SCHEMA = ("rule_id int, flow_id int, rule_name string, rule_type int, "
                     "crawler_type int, status int, arg0 double, arg1 double, score int")
SCORE_RULES = [
    (1, 1, "ip_access", 2, 0, 0, 4.0, None, 3),
    (2, 1, "critical_access", 2, 0, 0, 2.0, None, 4),
    (3, 1, "user_agent", 2, 0, 0, 3.0, None, 2),
    (4, 1, "critical_min_interval", 2, 0, 0, 3_600_000.0, None, 5),
    (5, 1, "critical_close_intervals", 2, 0, 0, 1.0, 3_600_000.0, 4),
    (6, 1, "cookie", 2, 0, 0, 3.0, None, 2),
    (7, 1, "route", 2, 0, 0, 3.0, None, 2),
    (8, 1, "ip_block_access", 2, 0, 1, 100.0, None, 3),
    (9, 1, "bookings_by_buyer", 2, 1, 0, 2.0, None, 6),
    (10, 1, "unpaid_by_buyer", 2, 1, 0, 2.0, None, 6),
    (11, 2, "ip_access", 0, 0, 0, 2.0, None, 5),
    (12, 1, "critical_access", 0, 0, 0, 1.0, None, 2),
    (13, 1, "critical_close_intervals", 0, 0, 0, 1.0, 5_000.0, 6),
    (14, 1, "critical_close_intervals", 0, 0, 0, 1.0, 120_000.0, 3),
    (15, 1, "ip_block_access", 0, 0, 0, 3.0, None, 2),
    (16, 1, "ip_access", 1, 0, 0, 2.0, None, 3),
    (17, 1, "critical_close_intervals", 1, 0, 0, 1.0, 300_000.0, 5),
    (18, 1, "critical_close_intervals", 1, 0, 0, 1.0, 1_800_000.0, 2),
    (19, 1, "critical_min_interval", 1, 0, 0, 600_000.0, None, 4),
    (20, 1, "bookings_by_buyer", 1, 1, 0, 1.0, None, 3),
    (21, 1, "unpaid_by_contact_phone", 1, 1, 0, 1.0, None, 4),
    (22, 1, "unknown to maintenance", 2, 0, 0, 0.0, None, 50),
    (23, 4, "ip_access", 2, 0, 0, 1.0, None, 50),
]

MAINTENANCE_SCHEMA = "rule_name string, metric string, cmp string"
MAINTENANCE = [
    ("ip_access", "ip_access", ">="), ("critical_access", "critical_access", ">="),
    ("user_agent", "user_agent_distinct", ">="), ("critical_min_interval", "critical_min_interval", "<"),
    ("critical_close_intervals", "critical_close_intervals", ">="), ("cookie", "cookie_distinct", ">="),
    ("route", "route_distinct", ">="), ("ip_block_access", "ip_block_access", ">="),
    ("bookings_by_buyer", "bookings_by_buyer", ">="), ("unpaid_by_buyer", "unpaid_by_buyer", ">="),
    ("unpaid_by_contact_phone", "unpaid_by_contact_phone", ">="), ("never used", "ip_access", ">"),
]


def close_gaps(rule_type: int) -> list[int]:
    """The gaps that the default rules of a tier count close intervals by."""
    return sorted({int(r[7]) for r in SCORE_RULES if r[2] == "critical_close_intervals" and r[3] == rule_type})


def flows(spark: SparkSession) -> DataFrame:
    return values(spark, FLOWS, FLOW_SCHEMA)


def strategies(spark: SparkSession) -> DataFrame:
    return values(spark, STRATEGIES, STRATEGY_SCHEMA)


def score_rules(spark: SparkSession) -> DataFrame:
    return values(spark, SCORE_RULES, SCORE_RULE_SCHEMA)


def maintenance(spark: SparkSession) -> DataFrame:
    return values(spark, MAINTENANCE, MAINTENANCE_SCHEMA)
