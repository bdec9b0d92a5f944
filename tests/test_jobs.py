"""The batch jobs run end to end and write where they should."""

import os
import uuid

from pyspark.sql import functions as F

from table_dirs import SF_SMALL
from tollgate.operators.scoring import RuleBook
from tollgate.plans import jobs
from tollgate.session import scratch_path
from tollgate.sources import dimensions as dim
from tollgate.sources.bookings import booking_events, bookings
from tollgate.sources.requests import load_requests, raw_lines


def test_preprocess_and_rule_metrics_and_restore(spark):
    out = scratch_path(spark, f"jobs-{uuid.uuid4().hex[:8]}")
    req = load_requests(spark, SF_SMALL)
    jobs.preprocess_job(spark, raw_lines(req), out)
    rec = spark.read.parquet(os.path.join(out, "records"))
    assert {r.behavior_type for r in rec.select("behavior_type").distinct().collect()} == {"Query", "Book"}
    bl = jobs.rule_metrics_job(spark, req, booking_events(bookings(spark, SF_SMALL)), RuleBook.defaults(spark),
                               dim.critical_page_rules(spark), out, run_id="daily")
    assert bl.count() > 0 and {"y", "m", "d", "h"} <= set(bl.columns)
    # ten minutes after the first decision: written this hour, and still to live for fifty minutes
    now = bl.agg(F.min("key_exp_time")).first()[0] - 50 * 60_000
    path, n = os.path.join(out, "blacklist"), bl.count()
    got = jobs.restore_job(spark, path, now)
    assert got.count() > 0 and {r.ttl_ms for r in got.collect()} == {50 * 60_000}
    assert jobs.restore_job(spark, path, now, enabled=False) is None
    restored = sorted(r.key for r in got.collect())
    again = jobs.rule_metrics_job(spark, req, booking_events(bookings(spark, SF_SMALL)), RuleBook.defaults(spark),
                                  dim.critical_page_rules(spark), out, run_id="daily")
    assert again.count() == n                                # the rerun replaced its records
    assert sorted(r.key for r in jobs.restore_job(spark, path, now).collect()) == restored


def test_dashboards_job_matches_registered_queries(spark):
    import __spark_entry__ as E
    from tollgate.plans.registry import classified_requests
    out = scratch_path(spark, f"dash-{uuid.uuid4().hex[:8]}")
    paths = jobs.dashboards_job(spark, classified_requests(spark, SF_SMALL), out,
                                run_id=f"d{uuid.uuid4().hex[:6]}")
    got = spark.read.parquet(paths["traffic_share"])
    exp = E.queries()["traffic_share"](spark, SF_SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.select(*got.columns).collect()))
    assert len(paths) == 13
