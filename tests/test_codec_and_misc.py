"""Record codec round trip, XML travel type, rule caps, approx streaming path, detectors."""

from pyspark.sql import functions as F

from table_dirs import SF_SMALL
from tollgate.functions import match as MT
from tollgate.functions.codec import RECORD_FIELDS, from_record_line, to_record_line
from tollgate.operators.tags import xml_travel_type
from tollgate.plans.preprocess import Dimensions, ingest_lines, process_messages, structured
from tollgate.plans.registry import tagged_requests
from tollgate.session import scratch_path
from tollgate.sources.requests import raw_lines


def test_record_line_round_trip(spark):
    ok, _ = ingest_lines(raw_lines(tagged_requests(spark, SF_SMALL)))
    rec = structured(process_messages(ok, Dimensions.defaults(spark))).drop("event_id")
    lines = rec.select(to_record_line(rec).alias("value"))
    assert all(len(r.value.split("#CS#")) == 19 for r in lines.limit(50).collect())
    back = from_record_line(lines)
    assert back.columns == RECORD_FIELDS
    cols = ["request_method", "request", "remote_addr", "flight_type", "behavior_type",
            "travel_type", "session_id", "high_freq_ip"]
    a = sorted(tuple(r) for r in rec.select(*cols).collect())
    b = sorted(tuple(r) for r in back.select(*cols).collect())
    assert a == b
    q = back.filter(F.col("behavior_type") == "Query").first()
    assert q.query_data is not None and q.book_data is None and q.source_data == "NULL"


def test_xml_travel_type(spark):
    df = spark.createDataFrame([("<page><SEGTYPE>S</SEGTYPE></page>",), ("<page><SEGTYPE>R</SEGTYPE></page>",),
                                ("<page/>",)], "x string")
    assert [r[0] for r in df.select(xml_travel_type(F.col("x"))).collect()] == ["OneWay", "RoundTrip", "Unknown"]


def test_many_rules_inline_and_joined(spark, monkeypatch):
    rules = spark.createDataFrame([(f"/p{i}/.*",) for i in range(600)], "v string")
    pats = [f"/p{i}/.*" for i in range(600)]
    df = spark.createDataFrame([("/p599/x",), ("/q/x",)], "u string")
    got = [r[0] for r in df.select(MT.any_full_match(F.col("u"), pats)).collect()]
    assert got == [True, False]
    inline = MT.flag_any_match(df, "u", rules, "v", "hit").orderBy("u").collect()
    monkeypatch.setattr(MT, "INLINE_RULES", 10)
    assert MT.flag_any_match(df, "u", rules, "v", "hit").orderBy("u").collect() == inline


def test_patterns_keep_their_meaning_beside_others(spark):
    """Back references and group names belong to one pattern, whatever rules stand before it."""
    rules = spark.createDataFrame([("/(?<n>a)x/",), (r"/c/(d)\1/",), ("/(?<n>b)y/",)], "v string")
    df = spark.createDataFrame([("/c/dd/",), ("/c/d/",), ("/by/",)], "u string")
    got = {r.u: r.hit for r in MT.flag_any_match(df, "u", rules, "v", "hit").collect()}
    assert got == {"/c/dd/": True, "/c/d/": False, "/by/": True}


def test_a_thousand_request_classes(spark, monkeypatch):
    from tollgate.operators.tags import tag_request_type
    rules = spark.createDataFrame([(i, f"/p{i}(/.*)?", f"F{i}", "Query") for i in range(1500)],
                                  "priority int, expression string, flight_type string, behavior_type string")
    df = spark.createDataFrame([("/p1499/x",), ("/p0",), ("/q",), (None,)], "url string")
    want = {"/p1499/x": "F1499", "/p0": "F0", "/q": "Other", None: "Other"}
    assert {r.url: r.flight_type for r in tag_request_type(df, rules).collect()} == want
    monkeypatch.setattr(MT, "INLINE_RULES", 100)
    assert {r.url: r.flight_type for r in tag_request_type(df, rules).collect()} == want


def test_detectors_learn_rule_verdicts(spark):
    import __spark_entry__ as E
    acc = E.queries()["detector_accuracy_daily"](spark, "/root/testdata/sf0.01")
    rows = acc.filter(F.col("model") == "supervised").collect()
    assert rows and sum(r.accuracy * r.rows for r in rows) / sum(r.rows for r in rows) > 0.9


def test_cluster_conf_sizes_partitions():
    from tollgate.session import cluster_conf
    c = cluster_conf(10 * 2**40)                      # a 10 TB shuffle
    assert int(c["spark.sql.shuffle.partitions"]) == 40960
    assert c["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "40960"
    assert int(cluster_conf(1)["spark.sql.shuffle.partitions"]) == 200


def test_checkpoint_dir_is_read_from_session(spark):
    from tollgate.session import checkpoint_dir
    # Spark qualifies the path and adds a per-application subfolder under the configured one
    got = checkpoint_dir(spark).removeprefix("file:")
    assert got.startswith(spark.conf.get("spark.checkpoint.dir").removeprefix("file:").rstrip("/") + "/")
