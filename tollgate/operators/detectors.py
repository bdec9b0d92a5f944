"""Model-based detectors (V20, V21) and their monitoring.

Features are the per-IP metric vector of a window; the label is the rule
verdict (blacklisted by a scraper flow in that window). Training and scoring
run on pyspark.ml, distributed like any other job. Every row is predicted, by a
model fitted on the other folds of IPs. Gain ratio, for which the library has no
impurity, is in ``gain_ratio.py``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.operators import gain_ratio

FEATURES = ["access_count", "critical_count", "user_agent_count", "cookie_count", "route_count",
            "min_interval_ms", "close_interval_count"]
FOLDS = 3
IMPURITY = {"info_gain": "entropy", "gini": "gini"}


def feature_frame(wide_metrics: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Metric vector per (window, ip) with the rule label (1 = blacklisted)."""
    v = verdicts.select("window_start", F.col("key").alias("ip")).distinct().withColumn("label", F.lit(1.0))
    f = wide_metrics.join(v, ["window_start", "ip"], "left").fillna({"label": 0.0})
    return f.fillna(-1, subset=["min_interval_ms"]).fillna(0, subset=FEATURES)


def folds_of(features: DataFrame, folds: int) -> list[tuple[DataFrame, DataFrame | None]]:
    """(rows, training rows) per fold, by a hash of the IP: all windows of one IP are in one fold.

    The training rows are those of all other folds, None if there are none.
    """
    fold = F.pmod(F.xxhash64("ip"), F.lit(folds))
    filled = {r.fold for r in features.select(fold.alias("fold")).distinct().collect()}   # folds numbers at most
    return [(features.filter(fold == k), features.filter(fold != k) if filled - {k} else None) for k in range(folds)]


def cross_fit(features: DataFrame, folds: int, predict, model: str) -> DataFrame:
    """Every row with the prediction of ``predict(training rows, rows)``, fitted without its IP.

    Rows stay without a prediction if there are no rows of other folds to learn from.
    """
    done = [predict(train, rows) if train is not None else rows.withColumn("prediction", F.lit(None).cast("double"))
            for rows, train in folds_of(features, folds)]
    columns = [*features.columns, "prediction"]
    return reduce(DataFrame.unionByName, [d.select(columns) for d in done]).withColumn("model", F.lit(model))


def _features_of() -> list:
    """Metrics as one vector, scaled to unit deviation (a gap in ms would drown the counts)."""
    return [VectorAssembler(inputCols=FEATURES, outputCol="raw_features", handleInvalid="keep"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)]


def decision_tree(features: DataFrame, criterion: str = "info_gain", max_depth: int = 5,
                  min_instances: int = 1, folds: int = FOLDS, seed: int = 7) -> DataFrame:
    """Supervised detector; each fold is predicted by the tree fitted on the others."""
    def predict(train, rows):
        if criterion == "gain_ratio":
            tree = gain_ratio.grow(train, FEATURES, "label", max_depth=max_depth, min_instances=min_instances)
            return rows.withColumn("prediction", gain_ratio.predict(tree))
        dt = DecisionTreeClassifier(labelCol="label", featuresCol="features", impurity=IMPURITY[criterion],
                                    maxDepth=max_depth, minInstancesPerNode=min_instances, seed=seed)
        return Pipeline(stages=[*_features_of(), dt]).fit(train).transform(rows)

    return cross_fit(features, folds, predict, "supervised")


def kmeans(features: DataFrame, k: int = 2, max_iter: int = 20, folds: int = FOLDS, seed: int = 7) -> DataFrame:
    """Unsupervised detector; each fold is predicted by the clusters of the others. The cluster
    whose training members have the highest mean access count is read as the bot cluster (prediction 1)."""
    def predict(train, rows):
        km = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol="features", predictionCol="cluster")
        model = Pipeline(stages=[*_features_of(), km]).fit(train)
        bot = (model.transform(train).groupBy("cluster").agg(F.avg("access_count").alias("m"))
               .orderBy(F.desc("m"), "cluster").first()["cluster"])     # k rows at most
        return model.transform(rows).withColumn("prediction", (F.col("cluster") == bot).cast("double"))

    return cross_fit(features, folds, predict, "unsupervised")


def threshold_rule(features: DataFrame, metric: str, at_least: float) -> DataFrame:
    """The simplest detector: one metric against a threshold, for every row."""
    return (features.withColumn("prediction", (F.col(metric) >= at_least).cast("double"))
            .withColumn("model", F.lit("threshold")))


def accuracy_by_date(predictions: DataFrame) -> DataFrame:
    """Share of correct predictions per model and date."""
    return (predictions.groupBy("model", F.to_date("window_start").alias("day"))
            .agg(F.round(F.avg((F.col("prediction") == F.col("label")).cast("double")), 6).alias("accuracy"),
                 F.count(F.lit(1)).alias("rows")))


def fit_rate(predictions: DataFrame) -> DataFrame:
    """Per user (IP), agreement of algorithm and rule verdicts."""
    return (predictions.groupBy("model", "ip")
            .agg(F.round(F.avg((F.col("prediction") == F.col("label")).cast("double")), 6).alias("fit_rate"),
                 F.count(F.lit(1)).alias("windows")))
