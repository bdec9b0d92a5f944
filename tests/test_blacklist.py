"""Blacklist expiry/restore edge rows and hour-partitioned storage (FIXTURES §5)."""

import os

from pyspark.sql import functions as F

from tollgate.operators import blacklist as B
from tollgate.operators.scoring import nested_flows
from tollgate.session import scratch_path
from tollgate.sources import dimensions as dim


def recs(spark):
    return spark.createDataFrame(
        [("5000", "a", "old"), ("9000", "a", "new"),       # latest kept
         ("7000", "b", "t1"), ("7000", "b", "t2"),         # equal expiry: both kept
         ("1500", "c", "expired"),                         # < 1 s left at now=1000
         ("8000", "d", "live")],                           # already live -> not restored
        "key_exp_time string, key string, value string")


def test_latest_and_restore(spark):
    out = B.restore(recs(spark), F.lit(1000), live_keys=spark.createDataFrame([("d",)], "k string"))
    got = sorted((r.key, r.value, r.ttl_ms) for r in out.collect())
    assert got == [("a", "new", 8000), ("b", "t1", 6000), ("b", "t2", 6000)]
    assert sorted(r.value for r in B.rank_latest(recs(spark)).collect()) == \
        sorted(r.value for r in B.latest_per_key(recs(spark)).collect())


def test_hourly_parquet_roundtrip(spark):
    path = scratch_path(spark, f"bl-{os.getpid()}-{id(spark)}")
    df = spark.createDataFrame([("a", "2024-01-01 10:05:00"), ("b", "2024-01-01 11:00:00"),
                                ("c", "2024-01-01 12:00:00")], "key string, t string")
    df = df.withColumn("t", F.to_timestamp("t"))
    B.write_hourly(df, path, F.col("t"), "run1")
    hours = ["2024-01-01 10", "2024-01-01 11", "2024-01-02 00"]
    assert sorted(r.key for r in B.read_hours(spark, path, hours).collect()) == ["a", "b"]
    B.write_hourly(df, path, F.col("t"), "run1")            # a rerun replaces its own records
    assert sorted(r.key for r in B.read_hours(spark, path, hours).collect()) == ["a", "b"]
    B.write_hourly(df, path, F.col("t"), "run2")            # another run adds to them
    assert sorted(r.key for r in B.read_hours(spark, path, hours).collect()) == ["a", "a", "b", "b"]


def test_hours_to_restore_are_those_of_writing():
    now = 1_704_067_800_000                                  # 2024-01-01 00:10 UTC
    assert B.hours_to_restore(now) == ["2024-01-01 00", "2023-12-31 23"]


def test_flows_join_and_nesting(spark):
    nested = {r.flow_id: r for r in nested_flows(dim.flows(spark), dim.strategies(spark), dim.score_rules(spark),
                                                 dim.maintenance(spark)).collect()}
    assert set(nested) == {1, 2}                                 # flow 3 retired, 4 without strategy
    assert [x.rule_id for x in nested[2].rules] == [11]
    assert 8 not in {x.rule_id for x in nested[1].rules}         # disabled rule
