"""Request parsing as one nested-column job.

The parse-rule table is configuration. The *last* rule that fits a request is chosen, and its row
is then a column: formats, parameter names and paths are read from it. A small rule table is
one literal array and the choice a flat ``coalesce`` of literal patterns; a large one is joined by the
pattern index. JSONPath and XPath need literal paths, so fields branch over the different paths of the
table, not over its rules.

Which document a rule reads depends on its flags and on the request's content type; a rule
none of whose formats fits gives empty fields. XML that does not parse gives a NULL struct and
sets ``parse_failed``, so such rows can be routed to the rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions.match import full_match, inline_rules, match_by_index
from tollgate.functions.redact import hash_each, md5_nonempty
from tollgate.functions.text import form_map, kv_map, xml_doc, xml_path
from tollgate.sources.dimensions import BOOK_PATH_FIELDS, PARSE_RULE_SCHEMA, QUERY_PATH_FIELDS

# Enum ids of the record (flight, behaviour, travel types).
FLIGHT_IDS = {"National": 0, "International": 1, "Other": -1}
BEHAVIOR_IDS = {"Query": 0, "Book": 1, "Other": -1}
TRAVEL_IDS = {"OneWay": 0, "RoundTrip": 1, "Unknown": -1}

RULE_COLS = ["rule_id", "flight_type", "behavior_type", "request_match", "request_method",
             "is_normal_get", "is_normal_form", "is_application_json", "is_text_xml", "is_json",
             "is_xml", "form_data_field", *QUERY_PATH_FIELDS, *BOOK_PATH_FIELDS]


def enum_id(c: Column, ids: dict[str, int]) -> Column:
    out = F.lit(None).cast("int")
    for name, i in ids.items():
        out = F.when(c == name, F.lit(i)).otherwise(out)
    return out


_KINDS = dict(f.split(" ") for f in PARSE_RULE_SCHEMA.split(", "))


class ParseRules:
    """The parse-rule table as a plan needs it: its rows where it is small, and its different paths."""

    def __init__(self, table: DataFrame, limit: int | None = None):
        rows = inline_rules(table, *RULE_COLS, "rule_order", limit=limit)
        self.table = table
        self.rows = None if rows is None else sorted(
            (dict(zip([*RULE_COLS, "rule_order"], r)) for r in rows),
            key=lambda r: [(x is not None, x or 0) for x in (r["rule_order"], r["rule_id"])])
        self.paths = self._paths()

    def _paths(self) -> dict[tuple[str, str, str], list[str]]:
        """Different paths by (behaviour, field, ``is_json`` or ``is_xml``)."""
        fields = {"Query": QUERY_PATH_FIELDS, "Book": BOOK_PATH_FIELDS}
        if self.rows is not None:
            found = [(b, f, k, r[f]) for b, names in fields.items() for r in self.rows if r["behavior_type"] == b
                     for f in names for k in ("is_json", "is_xml") if r[k] and r[f] is not None]
        else:
            each = F.array(*[F.when((F.col("behavior_type") == b) & F.col(k) & F.col(f).isNotNull(),
                                    F.struct(F.lit(b).alias("b"), F.lit(f).alias("f"), F.lit(k).alias("k"), F.col(f).alias("path")))
                             for b, names in fields.items() for f in names for k in ("is_json", "is_xml")])
            found = [tuple(r) for r in self.table.select(F.inline(F.array_compact(each))).distinct().collect()]
        out: dict = {}
        for b, f, k, path in sorted(set(found)):
            out.setdefault((b, f, k), []).append(path)
        return out

    def choose(self, df: DataFrame, behavior: str, method: str, behavior_col: str, url: str) -> DataFrame:
        """``_r``, the last rule (in rule order) whose method matches case-insensitively, whose
        behaviour equals the request's, and whose pattern fully matches the URL; else NULL."""
        asked = F.when(F.col(behavior_col) == behavior, F.coalesce(F.col(url), F.lit("")))
        if self.rows is None:
            rules = self.table.where(F.col("behavior_type") == behavior).withColumn(
                "_rule_method", F.lower(F.coalesce("request_method", F.lit(""))))
            best = F.max_by(F.struct(*RULE_COLS), F.struct("rule_order", "rule_id"))
            d = df.withColumns({"_asked": asked, "_method": F.lower(F.col(method))})
            return match_by_index(d, "_asked", rules, "request_match", best, "_r", {"_method": "_rule_method"}).drop("_asked", "_method")
        rows = [r for r in self.rows if r["behavior_type"] == behavior and r["request_match"] is not None]
        row = F.array(*[F.struct(*[F.lit(r[c]).cast(_KINDS[c]).alias(c) for c in RULE_COLS]) for r in rows])
        hits = [F.when((F.lower(F.col(method)) == F.lit((r["request_method"] or "").lower())) & full_match(asked, r["request_match"]),
                       F.lit(k)) for k, r in reversed(list(enumerate(rows)))]     # later rules override earlier ones
        kind = "struct<" + ", ".join(f"{c}: {_KINDS[c]}" for c in RULE_COLS) + ">"
        return df.withColumn("_r", F.get(row, F.coalesce(*hits, F.lit(None).cast("int"))) if rows else F.lit(None).cast(kind))

    def branches(self, behavior: str, name: str, kind: str, fn) -> list[Column]:
        """One branch per different path of a field: ``fn(path)`` where the chosen rule has it."""
        return [F.when(F.col("_r")[name] == p, fn(p)) for p in self.paths.get((behavior, name, kind), [])]


def _flag(name: str) -> Column:
    """A flag of the chosen rule; false where it is null or no rule was chosen."""
    return F.coalesce(F.col("_r")[name], F.lit(False))


def _has_form_field() -> Column:
    return F.coalesce(F.length(F.col("_r")["form_data_field"]) > 0, F.lit(False))


def json_list(j: Column, path: str) -> Column:
    """A JSONPath that may give one value or a JSON array -> ARRAY<STRING>
    (``$.a[*].b`` unwraps a single result to a quoted JSON string, so re-wrap it)."""
    x = F.get_json_object(j, path)
    return (F.when(x.startswith("["), F.from_json(x, "array<string>"))
             .when(x.startswith('"'), F.from_json(F.concat(F.lit("["), x, F.lit("]")), "array<string>"))
             .when(x.isNotNull(), F.array(x)))


def _strip_brackets(j: Column) -> Column:
    return F.regexp_replace(j, r"(?s)^\[(.*)\]\z", "$1")


def parse_query(df: DataFrame, rules: ParseRules, *, method="request_method", url="url",
                body="request_body", content_type="content_type", behavior="behavior_type",
                flight="flight_type", travel="travel_type") -> DataFrame:
    """``query_data`` struct for query requests, NULL when no rule matched.

    The chosen rule's document is built once per row (``_map`` for GET/form
    parameters, ``_json`` for JSON, ``_xml`` for XML); every field reads from it.
    ``is_empty`` is true when nothing was extracted.
    """
    d = rules.choose(df, "Query", method, behavior, url)
    r, ct, b = F.col("_r"), F.lower(F.col(content_type)), F.col(body)
    full = F.length(F.coalesce(b, F.lit(""))) > 0
    # Fixed order of the formats; the first whose flags (and content type) fit is read.
    asked = F.lower(F.coalesce(r["request_method"], F.lit("")))
    get, posted = (asked == "get") & _flag("is_normal_get"), asked == "post"
    form = posted & _flag("is_normal_form")
    form_json = posted & ~_flag("is_normal_form") & _flag("is_json") & _has_form_field()
    xml = posted & ~_flag("is_normal_form") & _flag("is_text_xml") & _flag("is_xml") & ~form_json
    body_json = posted & ~_flag("is_normal_form") & _flag("is_application_json") & _flag("is_json") & ~form_json
    d = d.withColumn("_is", F.struct(get.alias("get"), form.alias("form"), form_json.alias("form_json"), xml.alias("xml"),
                                     body_json.alias("body_json")))
    kind = F.col("_is")
    d = (d.withColumn("_map", F.when(kind["get"], kv_map(F.get(F.split(F.col(url), "[?]"), 1), "&"))
                      .when(kind["form"] | kind["form_json"], form_map(b)))
         .withColumn("_is_xml", F.coalesce(kind["xml"] & (ct == "text/xml") & full, F.lit(False)))
         .withColumn("_xml", F.when(F.col("_is_xml"), xml_doc(b)))
         .withColumn("_json", F.when(kind["form_json"], F.element_at(F.col("_map"), r["form_data_field"]))
                     .when(kind["body_json"] & (ct == "application/json") & full, b)))

    def field(name):
        return F.coalesce(
            F.when(kind["get"] | kind["form"], F.element_at(F.col("_map"), r[name])),
            F.when(F.col("_json").isNotNull(), F.coalesce(
                *rules.branches("Query", name, "is_json", lambda p: F.get_json_object(F.col("_json"), p)), F.lit(None).cast("string"))),
            F.when(F.col("_xml").isNotNull(), F.coalesce(
                *rules.branches("Query", name, "is_xml", lambda p: F.nullif(F.xpath_string(F.col("_xml"), F.lit(xml_path(p))), F.lit(""))),
                F.lit(None).cast("string"))),
            F.lit(""))

    d = d.withColumn("_fields", F.struct(*[field(c).alias(c[2:]) for c in QUERY_PATH_FIELDS]))
    names = [c[2:] for c in QUERY_PATH_FIELDS]
    f = {n: F.col("_fields")[n] for n in names}
    q = F.struct(
        F.greatest(*[F.length(v) for v in f.values()]).eqNullSafe(0).alias("is_empty"),
        enum_id(F.col(flight), FLIGHT_IDS).alias("flight_type"),
        *[f[n].alias(n) for n in names if n != "travel_type"],
        F.coalesce(f["travel_type"].try_cast("int"), enum_id(F.col(travel), TRAVEL_IDS)).alias("travel_type"))
    failed = F.col("_is_xml") & F.col("_xml").isNull()
    return (d.withColumn("query_data", F.when(r.isNotNull() & ~failed, q)).withColumn("_failed", failed)
            .transform(_note_failed).drop("_r", "_is", "_map", "_json", "_xml", "_is_xml", "_fields", "_failed"))


def _note_failed(d: DataFrame) -> DataFrame:
    before = F.col("parse_failed") if "parse_failed" in d.columns else F.lit(False)
    return d.withColumn("parse_failed", before | F.col("_failed"))


def parse_book(df: DataFrame, rules: ParseRules, *, method="request_method", url="url",
               body="request_body", content_type="content_type", behavior="behavior_type",
               travel="travel_type") -> DataFrame:
    """``book_data`` struct for booking requests, NULL when no rule matched.
    Contact phone and id cards are MD5-hashed (P8); empty phone stays NULL.

    The formats are tried in a fixed order (XML, JSON body, JSON in a form field); one whose
    flags or content type do not fit falls through to the next.
    """
    d = rules.choose(df, "Book", method, behavior, url)
    r, ct, b = F.col("_r"), F.lower(F.col(content_type)), F.col(body)
    full = F.length(F.coalesce(b, F.lit(""))) > 0
    body_json = _flag("is_application_json") & _flag("is_json") & ~_flag("is_normal_form")
    form_json = _flag("is_json") & ~_flag("is_normal_form") & ~_flag("is_application_json") & _has_form_field()
    inner = _strip_brackets(F.element_at(form_map(b), r["form_data_field"]))
    d = (d.withColumn("_is_xml", F.coalesce(_flag("is_text_xml") & _flag("is_xml") & (ct == "text/xml") & full, F.lit(False)))
         .withColumn("_xml", F.when(F.col("_is_xml"), xml_doc(b)))
         .withColumn("_inner", F.when(form_json, inner))
         .withColumn("_json", F.when(~F.col("_is_xml"), F.coalesce(
             F.when(body_json & (ct == "application/json") & full, b),
             F.when(F.length(F.trim(F.col("_inner"))) > 0, F.col("_inner"))))))

    def branches(name, of_xml, of_json, kind):
        none = F.lit(None).cast(kind)
        return [F.when(F.col("_xml").isNotNull(), F.coalesce(*rules.branches("Book", name, "is_xml", of_xml), none)),
                F.when(F.col("_json").isNotNull(), F.coalesce(*rules.branches("Book", name, "is_json", of_json), none))]

    def lst(name, cut: str | None = None):
        def of_xml(p):
            # Spark's xpath() lists text nodes: address the element's text
            tp = xml_path(p if p.endswith("text()") or "/@" in p else p + "/text()")
            v = F.xpath(F.col("_xml"), F.lit(tp))
            return F.transform(v, lambda x: F.substring_index(x, cut, 1)) if cut else v
        return F.coalesce(*branches(name, of_xml, lambda p: json_list(F.col("_json"), p), "array<string>"),
                          F.array().cast("array<string>"))

    def scalar(name, cut: str | None = None):
        def of_xml(p):
            v = F.xpath_string(F.col("_xml"), F.lit(xml_path(p)))
            return F.substring_index(v, cut, 1) if cut else v
        return F.coalesce(*branches(name, of_xml, lambda p: F.get_json_object(F.col("_json"), p), "string"), F.lit(""))

    first, last = lst("b_psg_first_name"), lst("b_psg_name", "|")
    names = F.when(F.size(first) > 0,
                   F.zip_with(first, last, lambda a, z: F.concat(a, F.coalesce(z, F.lit("")))))\
             .otherwise(last)
    rule_flight = F.when(r.isNotNull(), F.coalesce(enum_id(r["flight_type"], FLIGHT_IDS), F.lit(-1)))
    bk = F.struct(
        rule_flight.alias("flight_type"),
        enum_id(F.col(travel), TRAVEL_IDS).alias("travel_type"),
        scalar("b_user_id").alias("user_id"),
        names.alias("psg_name"),
        lst("b_psg_type").alias("psg_type"),
        lst("b_id_type").alias("id_type"),
        hash_each(lst("b_id_card")).alias("id_card"),
        scalar("b_contact_name", "|").alias("contact_name"),
        md5_nonempty(scalar("b_contact_phone", "/")).alias("contact_phone"),
        scalar("b_agent").alias("agent"),
        lst("b_dep_city").alias("dep_city"),
        lst("b_arr_city").alias("arr_city"),
        lst("b_flight_date").alias("flight_date"),
        lst("b_flight_no").alias("flight_no"),
        lst("b_cabin").alias("cabin"))
    failed = F.col("_is_xml") & F.col("_xml").isNull()
    return (d.withColumn("book_data", F.when(r.isNotNull() & ~failed, bk)).withColumn("_failed", failed)
            .transform(_note_failed).drop("_r", "_xml", "_is_xml", "_inner", "_json", "_failed"))


def core_params(df: DataFrame) -> DataFrame:
    """Flight date / departure / arrival from the query, else the booking's
    lists joined with ','."""
    q, b = F.col("query_data"), F.col("book_data")

    def pick(qf, bf):
        return F.coalesce(F.nullif(q[qf], F.lit("")), F.nullif(F.concat_ws(",", b[bf]), F.lit("")))
    return df.withColumn("core_params", F.struct(
        pick("flight_date", "flight_date").alias("flight_date"),
        pick("dep_city", "dep_city").alias("dep_city"),
        pick("arr_city", "arr_city").alias("arr_city")))
