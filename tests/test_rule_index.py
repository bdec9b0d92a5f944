"""Rule index: required literals, and matches equal to every pattern against every text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tollgate.functions import match as MT
from tollgate.operators.parse import RULE_COLS, ParseRules, parse_book, parse_query
from tollgate.operators.tags import tag_request_type
from tollgate.plans.preprocess import Dimensions, process_messages, requests_as_messages
from tollgate.sources import dimensions as dim
from table_dirs import SF_SMALL


@pytest.mark.parametrize("pattern, literal", [
    (r".*/query/jaxb/direct/query\.ao.*", "/query/jaxb/direct/query.ao"), (r"S12[0-9]?-([0-4])", "S12"), ("abc", "abc"),
    (r".*\.(png|jpg)(\?[^ ]*)? .*", "."), ("a|b", None), ("(a|b)", None), ("ab*cd", "cd"), ("ab?", "a"), ("ab+c", "ab"),
    ("ab{0,2}cde", "cde"), ("ab{2}", "ab"), (r"\d+x", "x"), (r"\x41bc", None), ("(?i)abc", None), ("(?:abc)?de", "de"),
    ("[a[b]]cd", None), ("[^/]+/x", "/x"), (r"a\\b", r"a\b"), (r"\Qa.b\E", None), ("", None), (".*", None), ("x{", None),
    ("好+ab", "ab"), ("(((a)))bc", "bc"), ("a)b", None), ("^abc$", "abc"), (r"\bword\b", "word"), (r"a\/b", "a/b")])
def test_required_literal(spark, pattern, literal):
    got = spark.createDataFrame([(pattern,)], "p string").select(MT.required_literal(F.col("p"))).first()[0]
    assert got == literal


def test_literals_are_in_every_match(spark):
    """Random patterns: wherever Java and Python agree on a match, the literal is in the text."""
    rng = random.Random(8)
    parts = ["a", "b", "ab", "c", ".", ".*", "[ab]", "[^c]", "(a|b)", "(?:ab)?", "a?", "b+", "c*", r"\.", r"\d", "{2}", "a{0,1}", "|", "/x"]
    patterns = sorted({"".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) for _ in range(600)})
    patterns = [p for p in patterns if not p.startswith("{") and "|{" not in p and not re.search(r"[*+?}]\{|[*+?}][*?+]\??\{|[*+]\+|\}\?", p)]
    ok = []
    for p in patterns:
        try:
            re.compile(p)
            ok.append(p)
        except re.error:
            pass
    texts = ["".join(rng.choice("abc.1/x") for _ in range(rng.randint(0, 6))) for _ in range(400)]
    got = spark.createDataFrame([(p,) for p in ok], "p string").select("p", MT.required_literal(F.col("p")).alias("lit")).collect()
    assert sum(r.lit is not None for r in got) > 100
    for r in got:
        assert all(r.lit in t for t in texts if r.lit and re.fullmatch(r.p, t, re.S)), r


RULES = [(i, f"/p{i}(/.*)?", f"F{i}", "Query") for i in range(60)] + [
    (60, ".*", "Any", "Book"), (61, None, "Null", "Query"), (62, "a|b", "Alt", "Query"), (5, "/p1/x", "Early", "Query"),
    (63, "(?i)/UPPER", "Flag", "Query"), (64, "z", "One", "Query"), (2, "a.?", "Short", "Query")]
TEXTS = ["/p1/x", "/p59", "/p5", "/p590", "a", "b", "/upper", "z", "None", "", None, "/p1/x", "ab"]


def test_results_are_the_same_on_both_sides_of_the_size(spark, monkeypatch):
    rules = spark.createDataFrame(RULES, "priority int, expression string, flight_type string, behavior_type string")
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, url string")
    inline = tag_request_type(df, rules).orderBy("id").collect()
    some = rules.where("expression IS NULL OR expression <> '.*'")
    flags = MT.flag_any_match(df, "url", some.select("expression"), "expression", "hit").orderBy("id").collect()
    monkeypatch.setattr(MT, "INLINE_RULES", 3)
    monkeypatch.setattr(MT, "BLOCK", 2)
    assert tag_request_type(df, rules).orderBy("id").collect() == inline
    assert MT.flag_any_match(df, "url", some.select("expression"), "expression", "hit").orderBy("id").collect() == flags
    assert {r.url: r.flight_type for r in inline}["None"] == "Any"           # a null pattern is no pattern "None"


def test_large_tables_meet_texts_in_equi_joins(spark, monkeypatch):
    monkeypatch.setattr(MT, "INLINE_RULES", 1)
    rules = spark.range(500).selectExpr("CAST(id AS int) AS priority", "concat('/path', id, '/.*') AS expression",
                                        "'N' AS flight_type", "'Q' AS behavior_type")
    df = tag_request_type(spark.range(9).selectExpr("concat('/path', id, '/') AS url"), rules)
    text = df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "NestedLoop" not in text and "CartesianProduct" not in text and "/path499" not in text


def test_parse_rules_by_index_equal_inline(spark, monkeypatch):
    """The last fitting rule and its fields, chosen by expression and by join."""
    from tollgate.sources.requests import load_requests, request_formats
    msgs = request_formats(load_requests(spark, SF_SMALL))
    dims = Dimensions.defaults(spark)
    cols = ["event_id", "query_data", "book_data", "parse_failed"]
    inline = sorted(map(tuple, process_messages(msgs, dims).select(*cols).collect()))
    monkeypatch.setattr(MT, "INLINE_RULES", 4)
    joined = sorted(map(tuple, process_messages(msgs, dims).select(*cols).collect()))
    assert inline == joined and any(r[1] for r in inline) and any(r[2] for r in inline)


def test_later_rules_win_and_equal_orders_go_by_id(spark):
    base = {c: None for c in [*RULE_COLS, "rule_order"]}
    rows = [{**base, "rule_id": i, "rule_order": o, "behavior_type": "Query", "flight_type": "National", "request_match": "/a.*",
             "request_method": "GET", "is_normal_get": True, "q_dep_city": f"p{i}"} for i, o in ((1, 5), (7, 3), (3, 5), (2, 5))]
    table = spark.createDataFrame([tuple(r[f.split(" ")[0]] for f in dim.PARSE_RULE_SCHEMA.split(", ")) for r in rows], dim.PARSE_RULE_SCHEMA)
    d = spark.createDataFrame([("get", "/ab?p3=x&p7=y&p1=z", None, None, "Query", "National", None)],
                              "request_method string, url string, request_body string, content_type string, behavior_type string, "
                              "flight_type string, travel_type string")
    for limit in (None, 1):
        got = parse_query(d, ParseRules(table, limit)).first()
        assert got.query_data.dep_city == "x"
        assert parse_book(d, ParseRules(table, limit)).first().book_data is None


def test_no_rules_at_all(spark):
    dims = Dimensions.defaults(spark)
    for name in ("url_filter", "classify", "parse_rules", "black_ips", "critical_pages"):
        setattr(dims, name, getattr(dims, name).limit(0))
    from tollgate.sources.requests import load_requests
    out = process_messages(requests_as_messages(load_requests(spark, SF_SMALL).limit(5)), dims).collect()
    assert len(out) == 5 and all(r.query_data is None and r.book_data is None and r.behavior_type == "Other" for r in out)
