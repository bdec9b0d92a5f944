"""Plan shape: the properties that matter at scale, read from ``explain``."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from table_dirs import SF_SMALL
from tollgate.plans.registry import QUERIES


def plan_of(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"detector_accuracy_daily", "detector_fit_rate"}))
def test_no_python_in_plan(spark, name):
    p = plan_of(QUERIES[name](spark, SF_SMALL), "extended")
    for op in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert op not in p, f"{name} runs Python ({op})"


def test_scan_prunes_columns(spark):
    p = plan_of(E.queries()["ip_block_daily"](spark, SF_SMALL))
    schemas = [l for l in p.splitlines() if "ReadSchema" in l]
    assert schemas and all("props" not in l and "value" not in l for l in schemas)


def test_preprocess_broadcasts_black_list_and_has_one_scan(spark):
    p = plan_of(E.queries()["preprocessed_requests"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    import re
    assert len(set(re.findall(r"\((\d+)\) Scan parquet", p))) == 1


def test_ranking_is_top_k_not_full_sort(spark):
    p = plan_of(E.queries()["top_ip_access"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


@pytest.mark.parametrize("name", ["traffic_share", "scraper_route_ranking", "scraper_daily_cumulative", "funnel_scope"])
def test_scraper_dashboards_read_no_bookings(spark, name):
    p = plan_of(QUERIES[name](spark, SF_SMALL), "extended")
    assert "o_orderkey" not in p and "c_custkey" not in p


def test_large_rule_tables_are_joined_not_collected(spark, monkeypatch):
    from tollgate.functions import match
    from tollgate.operators.tags import flag_critical
    monkeypatch.setattr(match, "INLINE_RULES", 1)
    rules = spark.range(50).selectExpr("concat('/p', id) AS expression")
    p = plan_of(flag_critical(spark.range(9).selectExpr("concat('/p', id) AS url"), rules), "extended")
    assert "RLIKE" in p.upper() and "/p49" not in p


def test_queries_are_built_with_few_jobs(spark):
    """Three to read and join the rule tables, one per table opened; none per rule or metric."""
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    QUERIES["funnel_by_class"](spark, SF_SMALL)
    assert len(tracker.getJobIdsForGroup(None)) - before <= 6


def test_both_crawler_types_are_scored_once(spark):
    """The scoring plan below the two joins of blacklisted keys is the same, so its shuffle is reused."""
    df = QUERIES["user_class_counts"](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("FileScan") <= 10
