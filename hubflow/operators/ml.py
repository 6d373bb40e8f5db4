"""Trip-level split, Spark ML training, evaluation tables and permutation importance.

Training uses ``pyspark.ml`` estimators (distributed tree / linear fitting on the executors);
evaluation tables are plain aggregates over a predictions DataFrame (label + prediction columns),
so they apply to any model, including the closed-form stand-in used for exact checks.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hubflow import schema as S
from hubflow.functions.exprs import hash_percent, hash_order
from hubflow.operators.profile import histogram
from hubflow.session import written


# ---- split --------------------------------------------------------------------------------

def trip_split(df: DataFrame, test_share: float = S.TEST_SHARE, seed: int = S.SEED,
               trip: str = S.TRIP_ID) -> DataFrame:
    """Hold out whole trips: a stable hash of the trip id decides the side, so every segment of a
    trip lands on the same side with no shuffle and no driver-side id list.  Null trips dropped."""
    pct = hash_percent(trip, seed)
    return (df.filter(F.col(trip).isNotNull())
              .withColumn("split", F.when(pct < int(round(test_share * 100)), "test").otherwise("train")))

#: Rows that one group of a permutation holds on average.
ROWS_PER_BUCKET = 2_000


def split_leak_check(split_df: DataFrame, trip: str = S.TRIP_ID) -> DataFrame:
    """Trips found on both sides of the split (must be empty)."""
    return (split_df.groupBy(trip).agg(F.count_distinct("split").alias("sides"))
                    .filter(F.col("sides") > 1))


# ---- metrics ------------------------------------------------------------------------------

def regression_metrics(df: DataFrame, label: str = S.TARGET, pred: str = "prediction") -> DataFrame:
    """MAE, RMSE, R^2 in ONE pass (SST = n * population variance of the label)."""
    err = F.col(label) - F.col(pred)
    n = F.count(F.lit(1))
    return df.agg(F.avg(F.abs(err)).alias("MAE"), F.sqrt(F.avg(err * err)).alias("RMSE"),
                  (1 - F.sum(err * err) / (F.var_pop(label) * n)).alias("R2"), n.alias("n"))


def metrics_frame(model_name: str, metrics: DataFrame) -> DataFrame:
    return metrics.select(F.lit(model_name).alias("Model"), "*")


def residual_std(df: DataFrame, label: str = S.TARGET, pred: str = "prediction") -> float:
    return df.agg(F.stddev_samp(F.col(label) - F.col(pred))).first()[0] or 0.0


def mae_by_route_type(df: DataFrame, label: str = S.TARGET, pred: str = "prediction") -> DataFrame:
    return (df.groupBy("route_type").agg(F.count(F.lit(1)).alias("n"),
                                         F.avg(F.abs(F.col(label) - F.col(pred))).alias("MAE"))
              .orderBy(F.col("MAE").desc(), "route_type"))


def error_hotspots(df: DataFrame, key: str, k: int = 25, label: str = S.TARGET, pred: str = "prediction",
                   min_segments: int = 0) -> DataFrame:
    """Rows + mean absolute error per ``key``; top ``k`` by MAE (optionally only keys with at
    least ``min_segments`` rows, the reference's escalation guidance)."""
    g = (df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("hub_id" if key != "route_lane" else key))
           .agg(F.count(F.lit(1)).alias("segments"), F.avg(F.abs(F.col(label) - F.col(pred))).alias("MAE")))
    if min_segments:
        g = g.filter(F.col("segments") >= min_segments)
    name = "hub_id" if key != "route_lane" else key
    return g.orderBy(F.col("MAE").desc(), name).limit(k)


def worst_predictions(df: DataFrame, k: int = 15, label: str = S.TARGET, pred: str = "prediction",
                      tie: str = "segment_key") -> DataFrame:
    cols = ["trip_uuid", "route_lane", "route_type", "source_center", "destination_center"]
    out = df.withColumn("abs_error", F.abs(F.col(label) - F.col(pred)))
    ties = [tie] if tie in df.columns else []
    return (out.orderBy(F.col("abs_error").desc(), *ties).limit(k)
               .select(*cols, label, F.col(pred).alias("predicted"), "abs_error"))


def residual_histogram(df: DataFrame, bins: int = 60, label: str = S.TARGET, pred: str = "prediction") -> DataFrame:
    """Equal-width histogram of residuals (actual - predicted) with the common actual/predicted
    axis range attached."""
    res = df.select((F.col(label) - F.col(pred)).alias("residual"))
    rng = df.agg(F.least(F.min(label), F.min(pred)).alias("axis_min"), F.greatest(F.max(label), F.max(pred)).alias("axis_max"))
    return histogram(res, "residual", bins).crossJoin(F.broadcast(rng))


# ---- training -----------------------------------------------------------------------------

def _assembler(features):
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def train_eta(train: DataFrame, features, label: str = S.TARGET, max_iter: int = S.GBT_PARAMS["maxIter"],
              max_depth: int = S.GBT_PARAMS["maxDepth"], step_size: float = S.GBT_PARAMS["stepSize"],
              subsample: float = S.GBT_PARAMS["subsamplingRate"], feature_fraction: str = "0.8",
              seed: int = S.SEED) -> PipelineModel:
    """Gradient-boosted trees on squared error (the production regressor)."""
    gbt = GBTRegressor(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth,
                       stepSize=step_size, subsamplingRate=subsample, featureSubsetStrategy=feature_fraction,
                       seed=seed, lossType="squared", maxBins=64)
    return Pipeline(stages=[_assembler(features), gbt]).fit(train)


def train_generic(train: DataFrame, features, estimator=None, label: str = S.TARGET) -> PipelineModel:
    """Any ``pyspark.ml`` regressor behind the feature assembler (default: GBT, 200 x depth 5, lr 0.1)."""
    est = estimator or GBTRegressor(featuresCol="features", labelCol=label, maxIter=200, maxDepth=5,
                                    stepSize=0.1, seed=S.SEED)
    return Pipeline(stages=[_assembler(features), est]).fit(train)


def model_linear(train: DataFrame, features, label: str = S.TARGET) -> PipelineModel:
    """Ordinary least squares on standardized features (normal-equation solver)."""
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    lr = LinearRegression(featuresCol="scaled", labelCol=label, solver="normal", regParam=0.0)
    return Pipeline(stages=[_assembler(features), scaler, lr]).fit(train)


def model_forest(train: DataFrame, features, label: str = S.TARGET, num_trees: int = 200, max_depth: int = 14,
                 min_leaf: int = 5) -> PipelineModel:
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=num_trees, maxDepth=max_depth,
                               minInstancesPerNode=min_leaf, seed=S.SEED)
    return Pipeline(stages=[_assembler(features), rf]).fit(train)


def model_comparison(test: DataFrame, models: dict, label: str = S.TARGET) -> DataFrame:
    """One metrics row per fitted model plus ``is_best`` (lowest MAE)."""
    rows = None
    for name, m in models.items():
        r = metrics_frame(name, regression_metrics(m.transform(test), label))
        rows = r if rows is None else rows.unionByName(r)
    best = rows.agg(F.min_by("Model", "MAE").alias("_best"))
    return rows.crossJoin(F.broadcast(best)).withColumn("is_best", F.col("Model") == F.col("_best")).drop("_best")


def graph_ablation(train: DataFrame, test: DataFrame, base_features, all_features, label: str = S.TARGET,
                   **gbt) -> DataFrame:
    """Same split, base vs base+graph features; the MAE change is reported on each row."""
    base = train_eta(train, base_features, label, **gbt)
    full = train_eta(train, all_features, label, **gbt)
    a = metrics_frame("GBT (no graph)", regression_metrics(base.transform(test), label))
    b = metrics_frame("GBT (+ graph)", regression_metrics(full.transform(test), label))
    both = a.unionByName(b)
    d = a.select(F.col("MAE").alias("_a")).crossJoin(b.select(F.col("MAE").alias("_b")))
    return both.crossJoin(F.broadcast(d.select((F.col("_a") - F.col("_b")).alias("mae_gain"))))


def permuted_columns(df: DataFrame, columns: list[str], key: str, seed: int = S.SEED, buckets: int | None = None) -> DataFrame:
    """Adds ``<column>_permuted`` for every column: rows are hashed into ``buckets`` groups and the values rotate by
    one place inside each group (hash order).  Marginals are kept exactly, the link to the row is broken, every
    group is a balanced hash slice of about ``ROWS_PER_BUCKET`` rows, and all columns share one exchange."""
    buckets = buckets or 1 + df.count() // ROWS_PER_BUCKET
    w = Window.partitionBy("_b").orderBy(hash_order(key, seed + 1), key)
    wall = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dealt = df.withColumn("_b", F.abs(F.xxhash64(F.col(key), F.lit(seed))) % buckets)
    before = F.lag(F.struct(*columns), 1).over(w)
    moved = dealt.withColumn("_x", F.coalesce(before, F.last(F.struct(*columns)).over(wall)))
    return moved.select(*df.columns, *[F.col("_x")[c].alias(f"{c}_permuted") for c in columns])


def permutation_importance(model: PipelineModel, test: DataFrame, features, key: str = "segment_key",
                           label: str = S.TARGET) -> DataFrame:
    """MAE increase when one feature is permuted (model-agnostic explainability)."""
    test = written(permuted_columns(test, list(features), key))
    base = regression_metrics(model.transform(test), label).select(F.col("MAE").alias("base_mae"))
    out = None
    for f in features:
        m = regression_metrics(model.transform(test.withColumn(f, F.col(f"{f}_permuted"))), label).select(
            F.lit(f).alias("feature"), F.col("MAE").alias("permuted_mae"))
        out = m if out is None else out.unionByName(m)
    return (out.crossJoin(F.broadcast(base))
               .withColumn("mae_increase", F.col("permuted_mae") - F.col("base_mae"))
               .orderBy(F.col("mae_increase").desc(), "feature"))


def smoke_train(df: DataFrame, features, trees: int = 50, depth: int = 6, label: str = S.TARGET) -> DataFrame:
    """A quick end-to-end fit (few, shallow trees) on all rows: split, fit, test metrics (one row)."""
    sp = written(trip_split(df).select(label, "split", *features))  # the fit reads its rows several times
    tr, te = sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "test")
    model = train_eta(tr, features, label, max_iter=trees, max_depth=depth)
    return regression_metrics(model.transform(te), label)
