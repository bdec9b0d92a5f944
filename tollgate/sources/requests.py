"""The access log as a table.

The driver's tables hold no access log, so a request record is derived from
every ``events`` row by fixed, engine-neutral rules (one request per event).
The same rules are written as SQL in ``tollgate.plans.oracle.REQUESTS_SQL`` so
an independent engine can reproduce the table. Work grows with ``events``.

Columns follow the reference's record: the twelve raw-log fields plus the
derived keys used by the metrics (ts truncated to the log's 1 s resolution).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.sources.tables import read_table

# Fixed values of the derivation (shared with the SQL twin in plans/oracle.py).
STEP_OF_EVENT = {"view": "view", "click": "query", "purchase": "book", "signup": "pay"}
ASSET_URLS = ["/shop/dist/images/logo.png", "/shop/dist/main.js",
              "/shop/dist/main.css", "/shop/dist/images/banner.jpg"]
FORM_CONTENT_TYPE = "application/x-www-form-urlencoded; charset=UTF-8"
HOST = "http://www.example.com"


def _s(c: Column) -> Column:
    return c.cast("string")


def requests_from_events(events: DataFrame) -> DataFrame:
    e = events.select("event_id", "ts", "user_id", "event_type", "props")
    ev, uid = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    step = F.lit("asset")
    for et, st in reversed(list(STEP_OF_EVENT.items())):
        step = F.when(F.col("event_type") == et, F.lit(st)).otherwise(step)
    ts = F.date_trunc("second", F.col("ts").cast("timestamp"))
    base = e.select(ev.alias("event_id"), ts.alias("ts"), uid.alias("user_id"),
                    step.alias("step"), k.alias("k"))
    k, step, ts = F.col("k"), F.col("step"), F.col("ts")
    dep = F.concat(F.lit("C"), _s(k % 6))
    arr = F.concat(F.lit("C"), _s((k + uid) % 6))
    intl = (k % 3) == 0
    d1 = F.date_format(F.date_add(F.to_date(ts), (k % 20).cast("int")), "yyyy-MM-dd")
    d2 = F.date_format(F.date_add(F.to_date(ts), (k % 20 + 3).cast("int")), "yyyy-MM-dd")
    round_trip = (k % 2) == 1
    qs = F.concat(F.lit("c1="), dep, F.lit("&c2="), arr, F.lit("&d1="), d1)
    url = (F.when(step == "view", F.concat(F.lit("/shop/modules/main/flightSelect.html?k="), _s(k)))
           .when(step == "query", F.concat(
               F.when(intl, F.lit("/shop/query/jaxb/inter/query.ao?"))
                .otherwise(F.lit("/shop/query/jaxb/direct/query.ao?")), qs))
           .when(step == "book", F.when(intl, F.lit("/shop/book/inter/order.ao"))
                 .otherwise(F.lit("/shop/book/direct/order.ao")))
           .when(step == "pay", F.lit("/shop/pay/submit.ao"))
           .otherwise(F.get(F.array(*map(F.lit, ASSET_URLS)), (k % 4).cast("int"))))
    post = step.isin("book", "pay")
    method = F.when(post, F.lit("POST")).otherwise(F.lit("GET"))
    fdate = F.date_format(F.date_add(F.to_date(ts), (k % 20).cast("int")), "yyyyMMdd")
    body = (F.when(step == "book", F.concat(
                F.lit("json=%7B%22depcity%22%3A%22"), dep, F.lit("%22%2C%22arrcity%22%3A%22"), arr,
                F.lit("%22%2C%22flightdate%22%3A%22"), fdate,
                F.lit("%22%2C%22adultnum%22%3A%22"), _s(k % 3 + 1), F.lit("%22%7D")))
            .when(step == "pay", F.concat(F.lit("orderNo="), _s(ev)))
            .otherwise(F.lit("")))
    referer = F.concat(F.lit(HOST + "/shop/flightSelect.html?t=S&"), qs,
                       F.when(round_trip, F.concat(F.lit("&d2="), d2)).otherwise(F.lit("")))
    ip = (F.when(uid % 50 == 49, F.concat(F.lit("10."), _s(uid % 8), F.lit("."), _s(uid)))
          .otherwise(F.concat(F.lit("10."), _s(uid % 8), F.lit("."), _s(uid % 32), F.lit("."), _s(uid))))
    session = F.concat(F.lit("S"), _s(uid), F.lit("-"), _s(ev % 5))
    phone = F.concat(F.lit("138"), F.lpad(_s(uid), 8, "0"))
    cookie = F.concat(F.lit("JSESSIONID="), session, F.lit("; userId4logCookie="), phone,
                      F.lit("; lv="), _s(F.unix_millis(ts)))
    return base.select(
        "event_id", "ts", "user_id", "step", "k",
        dep.alias("dep"), arr.alias("arr"),
        F.when(intl, F.lit("International")).otherwise(F.lit("National")).alias("flight_type"),
        ip.alias("remote_addr"),
        F.concat(F.lit("192.168.72."), _s(ev % 3 + 120)).alias("server_addr"),
        session.alias("session_id"),
        F.concat(F.lit("UA"), _s((uid + ev % 3) % 7)).alias("user_agent"),
        method.alias("request_method"),
        url.alias("url"),
        F.concat(method, F.lit(" "), url, F.lit(" HTTP/1.1")).alias("request"),
        F.when(post, F.lit(FORM_CONTENT_TYPE)).otherwise(F.lit("text/html")).alias("content_type"),
        body.alias("request_body"),
        referer.alias("http_referer"),
        F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("time_iso8601"),
        F.concat(F.date_format(ts, "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000")).alias("time_local"),
        cookie.alias("http_cookie"),
        ((ev * 7) % 50).alias("active_user_num"),
        F.concat(F.lit("CZ"), _s(k % 50)).alias("flight_no"),
        F.when(k % 2 == 0, F.lit("Y")).otherwise(F.lit("C")).alias("cabin"),
        F.date_add(F.to_date(ts), (k % 20).cast("int")).alias("flight_date"),
    )


def load_requests(spark: SparkSession, base_dir: str) -> DataFrame:
    return requests_from_events(read_table(spark, base_dir, "events"))


# Raw-log encoding: twelve fields joined by this separator (fixed value).
SEP = "#CS#"
RAW_FIELDS = ["time_local", "request", "request_method", "content_type", "request_body",
              "http_referer", "remote_addr", "user_agent", "time_iso8601", "server_addr",
              "http_cookie", "active_user_num"]


def raw_lines(requests: DataFrame) -> DataFrame:
    """Encode each request as the raw delimited line, with malformed rows mixed in.

    Rows are damaged by fixed rules so the ingest filters have real work:
    event_id % 97 = 13 loses its last field, % 89 = 7 has an empty last field,
    % 83 = 5 has a non-numeric connection count.
    """
    ev = F.col("event_id")
    fields = [F.col(c).cast("string") for c in RAW_FIELDS]
    last = (F.when(ev % 89 == 7, F.lit(""))
            .when(ev % 83 == 5, F.lit("n/a"))
            .otherwise(fields[-1]))
    full = F.concat_ws(SEP, *fields[:-1], last)
    short = F.concat_ws(SEP, *fields[:-1])
    return requests.select(ev.alias("event_id"),
                           F.when(ev % 97 == 13, short).otherwise(full).alias("value"))


def request_formats(requests: DataFrame) -> DataFrame:
    """Twelve-column messages in all request formats, one per request, by ``event_id % 10``.

    Queries: 0 GET, 1 form, 2 JSON in a form field, 3 XML, 4 JSON body; bookings: 5 JSON in a form
    field (in brackets, over two lines), 6 XML, 7 JSON body; 8 and 9 are a query and a booking in
    XML that does not parse. City names are not ASCII, times come with and without fraction
    and offset, cookies hold an escape sequence that must be decoded once only.
    """
    ev, k = F.col("event_id"), F.col("k")
    v, n = ev % 10, _s(k % 3 + 1)
    city, arr = F.concat(F.col("dep"), F.lit("é广")), F.col("arr")
    date = F.date_format(F.col("ts"), "yyyy-MM-dd")

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    cities = text('"depcity":"', city, '","arrcity":"', arr, '","flightdate":"', date, '"')
    query_json = text("{", cities, ',"adultnum":"', n, '"}')
    phone = F.concat(F.lit("138"), F.lpad(_s(ev % 1000), 8, "0"))
    people = F.sequence(F.lit(1), (k % 3 + 1).cast("int"))
    person_json = F.array_join(F.transform(people, lambda i: text(
        '{"firstName":"F', _s(i), '","lastName":"L', n, '","type":"ADT","idType":"NI","idNo":"ID', _s(i), '"}')), ",")
    book_json = text('{"userId":"U', _s(ev), '","passengers":[', person_json, '],\n"contact":{"name":"N', n,
                     '","phone":"', phone, '"},', cities, ',"flightno":"CZ', n, '","cabin":"Y"}')
    person_xml = F.array_join(F.transform(people, lambda i: text(
        "<PASSENGER><NAME>L", n, "|x</NAME><TYPE>ADT</TYPE><IDTYPE>NI</IDTYPE><IDNO>ID", _s(i), "</IDNO></PASSENGER>")), "")
    query_xml = text("junk<page><DEPCITY>", city, "</DEPCITY><ARRCITY>", arr, "</ARRCITY><DATE>", date,
                     "</DATE><ADULT>", n, "</ADULT><TRAVELTYPE>1</TRAVELTYPE></page><page><ADULT>9</ADULT></page>")
    book_xml = text("<page><USERID>U", _s(ev), "</USERID>", person_xml, "<CONTACT><NAME>N", n, "|y</NAME><PHONE>", phone,
                    "/1</PHONE></CONTACT><SEGMENT><DEPCITY>", city, "</DEPCITY><ARRCITY>", arr, "</ARRCITY><DATE>", date,
                    "</DATE><FLIGHTNO>CZ", n, "</FLIGHTNO><CABIN>Y</CABIN></SEGMENT></page>")
    params = text("c2=", arr, "&d1=", date, "&at=", n)
    kinds = [("GET", text("/shop/query/jaxb/direct/query.ao?c1=", F.col("dep"), "&", params), "text/html", F.lit("")),
             ("POST", F.lit("/shop/query/form.ao"), FORM_CONTENT_TYPE,
              text("c1=", F.url_encode(city), "&", params, "&ct=u00e9+x")),
             ("POST", F.lit("/shop/query/json.ao"), FORM_CONTENT_TYPE, text("json=", F.url_encode(query_json))),
             ("POST", F.lit("/shop/query/xml.ao"), "text/xml", query_xml),
             ("POST", F.lit("/shop/query/body.ao"), "application/json", query_json),
             ("POST", F.lit("/shop/book/direct/order.ao"), FORM_CONTENT_TYPE,
              text("json=", F.url_encode(text("[", book_json, "]")))),
             ("POST", F.lit("/shop/book/xml.ao"), "text/xml", book_xml),
             ("POST", F.lit("/shop/book/json.ao"), "application/json", book_json),
             ("POST", F.lit("/shop/query/xml.ao"), "text/xml", F.lit("<page><DEPCITY>CAN</page>")),
             ("POST", F.lit("/shop/book/xml.ao"), "text/xml", text(book_xml, "&broken;"))]

    def pick(i):
        return F.coalesce(*[F.when(v == j, kind[i] if not isinstance(kind[i], str) else F.lit(kind[i]))
                            for j, kind in enumerate(kinds)])
    at = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss")
    time = F.concat(at, F.get(F.array(*map(F.lit, ["+00:00", ".123+08:00", "", "+0800"])), (ev % 4).cast("int")))
    return requests.select(
        "event_id", "time_local", text(pick(0), " ", pick(1), " HTTP/1.1").alias("request"), pick(0).alias("request_method"),
        pick(2).alias("content_type"), pick(3).alias("request_body"), "http_referer", "remote_addr",
        F.col("user_agent").alias("http_user_agent"), time.alias("time_iso8601"), "server_addr",
        F.lit("JSESSIONID=%u0053%2541 %41; a=1").alias("http_cookie"), "active_user_num")
