"""Rule evaluation, flow scores and blacklist decisions.

Detection flows are joined from their four tables and nested, one row per flow with its rules; a plan reads
them once (``RuleBook``), since metrics, gaps and tiers shape it. Metrics arrive long-form
``(window_start, window_end, metric, key, value)`` and meet the rules, a table of values whose size
the planner knows, on the metric name. All per-key work is grouped aggregation, so nothing of it is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIN = ["window_start", "window_end"]
CLOSE_INTERVALS = "critical_close_intervals"


def flows_with_strategy(flows: DataFrame, strategies: DataFrame, status: int = 0) -> DataFrame:
    """Flows of a status joined to their strategy (thresholds) on the flow id.
    A flow without a strategy has no thresholds and is left out."""
    return flows.filter(F.col("status") == status).select("flow_id", "flow_name").join(
        strategies.select("flow_id", "crawler_threshold", "occ_threshold").hint("merge"), "flow_id")


def rules_with_maintenance(rules: DataFrame, maintenance: DataFrame) -> DataFrame:
    """Rules joined on the rule name to the maintenance table that says which metric a rule
    reads and how it compares. Rules unknown there are left out."""
    return rules.join(maintenance.select("rule_name", "metric", "cmp").hint("merge"), "rule_name").select(
        "rule_id", "flow_id", "rule_name", "metric", "rule_type", "crawler_type", "status", "arg0", "arg1", "score", "cmp")


def nested_flows(flows: DataFrame, strategies: DataFrame, rules: DataFrame, maintenance: DataFrame, status: int = 0) -> DataFrame:
    """One row per flow with ``rules ARRAY<STRUCT>``, its enabled rules by id (empty without any)."""
    own = rules_with_maintenance(rules.filter(F.col("status") == 0), maintenance).groupBy("flow_id").agg(
        F.sort_array(F.collect_list(F.struct("rule_id", "rule_name", "metric", "rule_type", "crawler_type",
                                             "arg0", "arg1", "score", "cmp"))).alias("rules"))
    out = flows_with_strategy(flows, strategies, status).join(own.hint("merge"), "flow_id", "left")
    return out.withColumn("rules", F.coalesce("rules", F.array().cast(own.schema["rules"].dataType)))


class RuleBook:
    """The detection flows as a plan reads them: collected once, a row per flow (configuration)."""

    SCHEMA = ("flow_id int, flow_name string, threshold double, rule_id int, metric string, rule_type int, crawler_type int, "
              "arg0 double, arg1 double, score int, cmp string")

    def __init__(self, nested: DataFrame):
        self.spark = nested.sparkSession
        self.flows = sorted((f.asDict(recursive=True) for f in nested.collect()), key=lambda f: f["flow_id"])

    @classmethod
    def load(cls, flows: DataFrame, strategies: DataFrame, rules: DataFrame, maintenance: DataFrame) -> RuleBook:
        """From the four tables; each is configuration and one partition, so that one job joins and reads them all."""
        return cls(nested_flows(*[t.coalesce(1) for t in (flows, strategies, rules, maintenance)]))

    @classmethod
    def defaults(cls, spark: SparkSession) -> RuleBook:
        from tollgate.sources import dimensions as dim
        return cls.load(dim.flows(spark), dim.strategies(spark), dim.score_rules(spark), dim.maintenance(spark))

    @classmethod
    def from_tables(cls, spark: SparkSession, source: str | dict) -> RuleBook:
        """The flow tables of a deployment: a folder of parquet tables, or JDBC options."""
        from tollgate.sources import rule_tables as t
        opened = t.open_tables(spark, source)
        return cls.load(t.flows(opened), t.strategies(opened), t.score_rules(opened), t.maintenance(opened))

    def rules(self, rule_type: int | None = None, crawler_type: int | None = None) -> list[dict]:
        """Enabled rules of active flows with their flow and its threshold, optionally of one tier or crawler type."""
        return [{**f, **r, "threshold": f["crawler_threshold"] if r["crawler_type"] == 0 else f["occ_threshold"]}
                for f in self.flows for r in f["rules"]
                if rule_type in (None, r["rule_type"]) and crawler_type in (None, r["crawler_type"])]

    def metrics(self, rule_type: int, crawler_type: int | None = None) -> set[str]:
        """The metrics that the rules of a tier read."""
        return {r["metric"] for r in self.rules(rule_type, crawler_type)}

    def gaps(self, rule_type: int) -> list[int]:
        """The different ``arg1`` of a tier's close-interval rules."""
        return sorted({int(r["arg1"]) for r in self.rules(rule_type) if r["metric"] == CLOSE_INTERVALS and r["arg1"] is not None})

    def table(self, rule_type: int | None = None, crawler_type: int | None = None) -> DataFrame:
        """``rules`` as a table of values."""
        from tollgate.sources.dimensions import values
        names = [f.split(" ")[0] for f in self.SCHEMA.split(", ")]
        rows = [tuple(r[n] for n in names) for r in self.rules(rule_type, crawler_type)]
        return values(self.spark, rows or [(None,) * len(names)], self.SCHEMA).filter("rule_id IS NOT NULL")


def hit(value, arg0, cmp) -> F.Column:
    """B1 comparison; a minimum interval of -1 (single hit) never hits."""
    v = value.cast("double")
    return (F.when(cmp == "<", (v >= 0) & (v < arg0))
             .when(cmp == ">", v > arg0)
             .when(cmp == "<=", (v >= 0) & (v <= arg0))
             .otherwise(v >= arg0))


def evaluate_rules(metrics_long: DataFrame, book: RuleBook, rule_type: int | None = None,
                   crawler_type: int | None = None) -> DataFrame:
    """B1: one row per (window, flow, rule, key) with the rule's score when it hits, else 0.

    A metric made for an argument (the gap of a close-interval count, column ``arg1``) only meets
    the rules with that ``arg1``."""
    fr = book.table(rule_type, crawler_type).select(
        "flow_id", "flow_name", "threshold", "rule_id", F.col("metric").alias("_metric"), "crawler_type", "arg0",
        F.col("arg1").alias("_arg1"), "cmp", "score")
    m = metrics_long if "arg1" in metrics_long.columns else metrics_long.withColumn("arg1", F.lit(None).cast("double"))
    j = m.join(fr, (F.col("metric") == F.col("_metric"))
               & (F.col("arg1").isNull() | (F.col("arg1") == F.col("_arg1"))))
    h = hit(F.col("value"), F.col("arg0"), F.col("cmp"))
    return j.select(*WIN, "flow_id", "flow_name", "threshold", "rule_id", "crawler_type", "metric", "key", "value",
                    h.alias("hit"), F.when(h, F.col("score")).otherwise(F.lit(0)).alias("rule_score"))


def flow_scores(evaluated: DataFrame) -> DataFrame:
    """B2: Σ hit scores per (window, flow, crawler type, key) and the hit rule ids."""
    return (evaluated.groupBy(*WIN, "flow_id", "flow_name", "crawler_type", "key")
            .agg(F.sum("rule_score").cast("bigint").alias("score"),
                 F.sort_array(F.collect_list(F.when(F.col("hit"), F.col("rule_id")))).alias("hit_rules"),
                 F.first("threshold").alias("threshold")))


def blacklist_decisions(scores: DataFrame) -> DataFrame:
    """Keys whose score is strictly above the flow's threshold (scraper and
    seat-hoarding thresholds are separate)."""
    return scores.filter(F.col("score") > F.col("threshold"))


def metric_histogram(metrics_long: DataFrame) -> DataFrame:
    """Per window and metric, number of keys at each metric value."""
    return (metrics_long.groupBy(*WIN, "metric", "value")
            .agg(F.count(F.lit(1)).alias("key_count")))
