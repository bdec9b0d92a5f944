"""Rule tables of a deployment, written as parquet in their stored form and loaded (IO7-IO10, J6, J7)."""

import os
import uuid

from pyspark.sql import functions as F

from table_dirs import SF_SMALL
from tollgate.operators.scoring import RuleBook
from tollgate.plans.preprocess import Dimensions, process_messages, requests_as_messages
from tollgate.session import scratch_path
from tollgate.sources import dimensions as dim
from tollgate.sources import rule_tables as T
from tollgate.sources.requests import load_requests


def stored(spark):
    """The fixture tables under the stored names and types."""
    base = scratch_path(spark, f"rules-{uuid.uuid4().hex}")

    def write(df, name):
        df.write.parquet(os.path.join(base, name))
    one_of = lambda c, names: F.coalesce(*[F.when(F.col(c) == n, F.lit(str(k))) for k, n in names.items()], F.lit("9"))
    write(dim.url_filter_rules(spark).union(spark.sql("SELECT CAST(NULL AS string)")).toDF("value").withColumn("id", F.lit(1)), "nh_filter_rule")
    write(dim.black_ips(spark).withColumn("note", F.lit("x")), "nh_ip_blacklist")
    write(dim.critical_page_rules(spark).toDF("criticalPageMatchExpression"), "nh_query_critical_pages")
    c = dim.classify_rules(spark).select(one_of("flight_type", T.FLIGHT_TYPES).alias("flight_type"),
                                         one_of("behavior_type", T.BEHAVIOR_TYPES).alias("operation_type"), "expression")
    write(c.union(spark.sql("SELECT '5', '0', '.*'")), "nh_classify_rule")
    p = dim.parse_rules(spark)
    own = {v: F.col(k).cast("string").alias(v) for k, v in T.PARSE_RULE_COLUMNS.items()}
    write(p.select(*own.values(), one_of("flight_type", T.FLIGHT_TYPES).cast("int").alias("flight_type"),
                   one_of("behavior_type", T.BEHAVIOR_TYPES).cast("int").alias("behavior_type")), "analyzerule")
    write(dim.flows(spark).select(F.col("flow_id").cast("string").alias("id"), F.col("flow_name").alias("process_name"), "status"), "nh_process_info")
    write(dim.strategies(spark).toDF("id", "crawler_blacklist_thresholds", "occ_blacklist_thresholds"), "nh_strategy")
    write(dim.score_rules(spark).withColumnRenamed("rule_id", "id").withColumnRenamed("flow_id", "process_id"), "nh_rule")
    write(dim.maintenance(spark).select("rule_name", F.col("metric").alias("rule_real_name")), "nh_rules_maintenance_table")
    return base


def test_loaded_tables_equal_the_fixtures(spark):
    base = stored(spark)
    loaded, fixed = Dimensions.from_tables(spark, base), Dimensions.defaults(spark)
    assert sorted(loaded.parse_rules.collect()) == sorted(fixed.parse_rules.collect())
    assert loaded.parse_rules.dtypes == fixed.parse_rules.dtypes
    for name in ("url_filter", "black_ips", "critical_pages"):
        assert sorted(getattr(loaded, name).collect()) == sorted(getattr(fixed, name).collect())
    assert {tuple(r) for r in loaded.classify.drop("priority").collect()} == {tuple(r) for r in fixed.classify.drop("priority").collect()}
    msgs = requests_as_messages(load_requests(spark, SF_SMALL))
    got, want = (sorted(map(tuple, process_messages(msgs, d).drop("http_cookie").collect()), key=repr) for d in (loaded, fixed))
    assert got == want and got


def test_filters_and_columns_reach_the_scan(spark):
    opened = T.open_tables(spark, stored(spark))
    rules = T.parse_rules(opened, 1)
    assert {r.behavior_type for r in rules.collect()} == {"Book"}
    text = rules._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "EqualTo(behavior_type,1)" in text
    text = T.black_ips(opened)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "ReadSchema: struct<ip_name:string>" in text


def test_flows_join_their_strategy_and_rules_their_maintenance(spark):
    loaded, fixed = RuleBook.from_tables(spark, stored(spark)), RuleBook.defaults(spark)
    assert loaded.flows == fixed.flows
    assert [f["flow_id"] for f in fixed.flows] == [1, 2]               # 3 retired, 4 without strategy, 9 no flow
    ids = {r["rule_id"] for r in fixed.rules()}
    assert not ids & {8, 22, 23}                                       # disabled, unknown to maintenance, flow without strategy
    assert {r["threshold"] for r in fixed.rules(2, 0)} == {20.0} and {r["threshold"] for r in fixed.rules(2, 1)} == {5.0}
    assert fixed.gaps(0) == [5000, 120_000] and fixed.metrics(2, 1) == {"bookings_by_buyer", "unpaid_by_buyer"}
    assert sorted(r.rule_id for r in fixed.table(1).collect()) == [16, 17, 18, 19, 20, 21]
    assert fixed.table(7).count() == 0


def test_a_flow_without_rules_stays(spark):
    none = dim.score_rules(spark).limit(0)
    book = RuleBook.load(dim.flows(spark), dim.strategies(spark), none, dim.maintenance(spark))
    assert [f["rules"] for f in book.flows] == [[], []] and book.rules() == [] and book.table().count() == 0
