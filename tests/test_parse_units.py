"""Golden and edge-case checks for the row-level builders (FIXTURES.md §4-5)."""

from pyspark.sql import functions as F

from tollgate.functions import redact as R
from tollgate.functions import text as T
from tollgate.operators import tags
from tollgate.operators.filters import field_count
from tollgate.operators.parse import ParseRules, parse_book, parse_query
from tollgate.sources import dimensions as dim


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} string" for k in cols))
    return df.select(expr.alias("out")).first()["out"]


def test_phone_redaction_golden(spark):
    c = F.col("c")
    assert one(spark, R.redact_phone(c), c="userId4logCookie=13818791413") == \
        "userId4logCookie=D1279C812D20ABDB6612BA7AF1C5D13C"
    # unanchored pattern also rewrites 11 digits inside a timestamp
    assert one(spark, R.redact_phone(c), c="lv=1516170718655") == "lv=44FB8D64B45D1F06DF48D421892806D555"
    assert one(spark, R.redact_phone(c, bounded=True), c="lv=1516170718655") == "lv=1516170718655"
    assert one(spark, R.md5_upper(c), c="") == "D41D8CD98F00B204E9800998ECF8427E"
    assert one(spark, R.md5_nonempty(c), c="") is None


def test_id_card_redaction(spark):
    out = one(spark, R.redact_id_card(F.col("c")), c="id=11010519491231002X;")
    assert out.startswith("id=") and "11010519491231002X" not in out and len(out) == 3 + 32 + 1


def test_travel_type(spark):
    r = F.col("r")
    assert one(spark, tags.travel_type(r), r="http://x/a?t=S&c1=CAN&d1=2019-09-26&at=1") == "OneWay"
    assert one(spark, tags.travel_type(r), r="http://x/a?d1=2019-09-26&d2=2019-10-01") == "RoundTrip"
    assert one(spark, tags.travel_type(r), r="http://x/a") == "Unknown"


def test_cookie_map_edges(spark):
    c = F.col("c")
    m = one(spark, T.cookie_map(c), c="a=1; b; c=; a=2; d=%u4E2D%u56FD; e=%zz; f=x=y; g=%E4%B8%AD")
    assert m["a"] == "2"                      # last wins, keys trimmed
    assert "b" not in m and "c" not in m      # no value -> skipped
    assert m["d"] == "中国"                   # %uXXXX unescape
    assert "e" not in m                       # malformed -> pair dropped
    assert m["f"] == "x"                      # value cut at a second '='
    assert m["g"] == "中"                     # URL decoding
    assert one(spark, T.cookie_value(T.cookie_map(c), "JSESSIONID"), c="") == "NULL"


def test_field_count_java_split(spark):
    v = F.col("v")
    assert one(spark, field_count(v), v="a#CS#b#CS##CS#") == 2
    assert one(spark, field_count(v), v="\na#CS##CS#b \n") == 3
    assert one(spark, field_count(v), v="") == 1


def test_ip_helpers(spark):
    ip = F.col("ip")
    assert one(spark, T.ip_block(ip), ip="192.168.72.1") == "192.168"
    assert one(spark, T.is_ipv4_shape(ip), ip="1.2.3") is False
    assert one(spark, T.is_ipv4_shape(ip), ip="1.2.3.4..") is True
    assert one(spark, T.is_ipv4_shape(ip), ip="fe80::1") is False


SAMPLE_BODY = ("json=%7B%22depcity%22%3A%22CAN%22%2C+%22arrcity%22%3A%22WUH%22%2C+%22flightdate%22%3A"
               "%2220180220%22%2C+%22adultnum%22%3A%221%22%2C+%22childnum%22%3A%220%22%7D")


def _msg(spark, method, url, ctype, body, behavior="Query", flight="National", travel="OneWay"):
    return spark.createDataFrame(
        [(method, url, ctype, body, behavior, flight, travel)],
        "request_method string, url string, content_type string, request_body string, "
        "behavior_type string, flight_type string, travel_type string")


def test_form_json_query_and_last_rule_wins(spark):
    rules = ParseRules(dim.parse_rules(spark))
    df = parse_query(_msg(spark, "POST", "/shop/query/json.ao", "application/x-www-form-urlencoded",
                          SAMPLE_BODY), rules)
    q = df.first()["query_data"]
    assert (q["dep_city"], q["arr_city"], q["flight_date"], q["adult_num"]) == ("CAN", "WUH", "20180220", "1")
    assert q["travel_type"] == 0 and q["flight_type"] == 0 and q["is_empty"] is False
    # rules 1 and 5 both match a national GET query; rule 5 (later) maps c1 -> dep
    g = parse_query(_msg(spark, "GET", "/shop/query/jaxb/direct/query.ao?c1=CAN&c2=WUH&d1=2019-01-01",
                         "", ""), rules).first()["query_data"]
    assert (g["dep_city"], g["arr_city"], g["adult_num"]) == ("CAN", "WUH", "")
    none = parse_query(_msg(spark, "GET", "/nothing", "", ""), rules).first()["query_data"]
    assert none is None


def test_book_xml_with_junk_prefix(spark):
    rules = ParseRules(dim.parse_rules(spark))
    xml = ("garbage<page><USERID>u1</USERID><PASSENGER><NAME>ZHANG|X</NAME><TYPE>ADT</TYPE>"
           "<IDNO>110105194912310021</IDNO></PASSENGER><PASSENGER><NAME>LI</NAME><TYPE>CHD</TYPE>"
           "<IDNO>110105194912310022</IDNO></PASSENGER><CONTACT><NAME>Wang|y</NAME>"
           "<PHONE>13800000000/1</PHONE></CONTACT><SEGMENT><DEPCITY>CAN</DEPCITY><ARRCITY>PEK</ARRCITY>"
           "<DATE>2019-01-01</DATE><FLIGHTNO>CZ1</FLIGHTNO><CABIN>Y</CABIN></SEGMENT></page>")
    b = parse_book(_msg(spark, "POST", "/shop/book/xml.ao", "text/xml", xml, behavior="Book"),
                   rules).first()["book_data"]
    assert b["psg_name"] == ["ZHANG", "LI"] and b["psg_type"] == ["ADT", "CHD"]
    assert b["contact_name"] == "Wang" and b["user_id"] == "u1"
    assert b["contact_phone"] == one(spark, R.md5_upper(F.col("c")), c="13800000000")
    assert len(b["id_card"]) == 2 and all(len(x) == 32 for x in b["id_card"])
    assert b["dep_city"] == ["CAN"] and b["cabin"] == ["Y"]


def test_book_json_single_passenger(spark):
    rules = ParseRules(dim.parse_rules(spark))
    body = ('{"userId":"u9","passengers":[{"firstName":"San","lastName":"Zhang","type":"ADT",'
            '"idType":"NI","idNo":"110105194912310021"}],"contact":{"name":"Z","phone":""},'
            '"depcity":"CAN","arrcity":"PEK","flightdate":"20190101","flightno":"CZ1","cabin":"Y"}')
    b = parse_book(_msg(spark, "POST", "/shop/book/json.ao", "application/json", body, behavior="Book"),
                   rules).first()["book_data"]
    assert b["psg_name"] == ["SanZhang"] and b["id_type"] == ["NI"]
    assert b["contact_phone"] is None          # empty phone is not hashed
    assert b["flight_no"] == ["CZ1"] and b["flight_type"] == 0
    # form-JSON with one pair of brackets stripped
    form = "json=" + "%5B" + body.replace('"', "%22").replace("{", "%7B").replace("}", "%7D") + "%5D"
    b2 = parse_book(_msg(spark, "POST", "/shop/book/direct/order.ao",
                         "application/x-www-form-urlencoded", form, behavior="Book"), rules).first()["book_data"]
    assert b2["user_id"] == "u9" and b2["dep_city"] == ["CAN"]


def java_kv_model(text, sep, decode):
    """Python model of the reference's splitting (String.split drops trailing empties)."""
    from urllib.parse import unquote_plus

    def jsplit(s, d):
        parts = s.split(d)
        while parts and parts[-1] == "":
            parts.pop()
        return parts or ([""] if s == "" else [])
    out = {}
    for piece in jsplit(text, sep):
        kv = jsplit(piece, "=")
        if len(kv) > 1:
            v = unquote_plus(kv[1], errors="strict") if decode else kv[1]
            out[kv[0].strip()] = v
    return out


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", " a", "JSESSIONID", ""]),
                          st.sampled_from(["", "=", "=1", "==2", "=x=y", "=%41", "=a+b"])), max_size=6))
def test_kv_map_matches_java_split_model(spark, pairs):
    text = ";".join(k + v for k, v in pairs)
    got = spark.createDataFrame([(text,)], "c string").select(T.cookie_map(F.col("c"))).first()[0]
    assert dict(got or {}) == java_kv_model(text, ";", True)
