"""Batch scoring: feature path -> model -> risk columns.  Risk rules are native ``when`` chains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubflow import schema as S
from hubflow.functions.exprs import finite_or_null, hash_order, risk_level, route_insight, route_lane


def eta_ratio(pred="predicted_eta", osrm="osrm_time") -> F.Column:
    """predicted / OSRM; zero OSRM, inf and missing fold to 1.0."""
    r = F.try_divide(F.col(pred), F.nullif(F.col(osrm), F.lit(0)))
    return F.coalesce(finite_or_null(r), F.lit(1.0))


def attach_risk(df: DataFrame, residual_std: float = 0.0, osrm_time_median: float = 0.0) -> DataFrame:
    """route_lane, eta_vs_osrm_ratio, confidence band, bottleneck warning, risk level, insights."""
    std = residual_std or S.DEFAULT_RESIDUAL_STD
    src = F.coalesce(F.col("source_bottleneck_score"), F.lit(0.0)) if "source_bottleneck_score" in df.columns else F.lit(0.0)
    dst = (F.coalesce(F.col("destination_bottleneck_score"), F.lit(0.0))
           if "destination_bottleneck_score" in df.columns else F.lit(0.0))
    out = df.withColumn("route_lane", route_lane())
    if "osrm_time" not in df.columns:
        out = out.withColumn("osrm_time", F.lit(float(osrm_time_median)))
    out = out.withColumns({
        "_max_bn": F.greatest(src, dst),
        "eta_vs_osrm_ratio": eta_ratio(),
        "confidence_low": F.col("predicted_eta") - S.CONFIDENCE_Z * std,
        "confidence_high": F.col("predicted_eta") + S.CONFIDENCE_Z * std,
    })
    out = out.withColumns({
        "confidence_band": F.struct(F.col("confidence_low").alias("low"), F.col("confidence_high").alias("high")),
        "bottleneck_warning": F.col("_max_bn") >= S.RISK_BOTTLENECK_MEDIUM,
        "risk_level": risk_level("_max_bn", "eta_vs_osrm_ratio"),
    })
    return out.withColumn("route_insights", route_insight("eta_vs_osrm_ratio", "bottleneck_warning")).drop("_max_bn")


def prediction_error(df: DataFrame) -> DataFrame:
    """|actual - predicted|, null when no actual."""
    if "actual_time" not in df.columns:
        return df.withColumn("prediction_error", F.lit(None).cast("double"))
    return df.withColumn("prediction_error", F.abs(F.col("actual_time") - F.col("predicted_eta")))


def one_row_per_trip(df: DataFrame, order_key: str = "segment_key", trip: str = S.TRIP_ID) -> DataFrame:
    """First segment of each trip (smallest ``order_key``) via a partial ``min_by`` aggregate."""
    others = [c for c in df.columns if c != trip]
    return (df.groupBy(trip).agg(F.min_by(F.struct(*others), F.col(order_key)).alias("_r"))
              .select(trip, "_r.*"))


def batch_sample(df: DataFrame, n: int = 500, seed: int = S.SEED, order_key: str = "segment_key") -> DataFrame:
    """One row per trip, then a seeded sample of ``n`` trips (md5 order: deterministic, portable,
    planned as a per-partition top-k)."""
    one = one_row_per_trip(df, order_key)
    return one.orderBy(hash_order(S.TRIP_ID, seed), S.TRIP_ID).limit(n)


def top_risky(scored: DataFrame, k: int = 10) -> DataFrame:
    cols = ["route_lane", "predicted_eta", "risk_level", "bottleneck_warning"]
    if "route_insights" in scored.columns:
        cols.append("route_insights")
    key = [S.TRIP_ID] if S.TRIP_ID in scored.columns else []
    return scored.orderBy(F.col("predicted_eta").desc(), *key).limit(k).select(*cols)


def predict_batch(df: DataFrame, model, artifact, hubs: DataFrame) -> DataFrame:
    """Expand minimal input -> enrich with hub features -> model features -> fitted transform ->
    model -> risk columns, as ONE lazy plan (the hub table is broadcast after a size check)."""
    from hubflow.operators.features import build_ml_features, expand_minimal
    from hubflow.operators.joins import enrich_graph
    from hubflow.operators.preprocess import transform_features

    work = df
    if "osrm_time" not in work.columns:
        work = expand_minimal(work, artifact.osrm_minutes_per_km)
    if "trip_hour" in work.columns and "trip_dayofweek" not in work.columns:
        work = work.withColumn("trip_dayofweek", F.lit(2))
    work = expand_minimal(work, artifact.osrm_minutes_per_km)   # missing segment fields (always expanded)
    work = enrich_graph(work, hubs)
    cats = [c[len("route_type_"):] for c in artifact.route_type_columns]
    work = build_ml_features(work, cats)
    for c in artifact.route_type_columns:
        if c not in work.columns:
            work = work.withColumn(c, F.lit(0.0))
    # the model sees filled/clipped features; the output keeps the raw values (risk uses raw OSRM)
    feats = list(artifact.feature_columns)
    work = work.withColumn("_raw", F.struct(*[F.col(c) for c in feats]))
    keep = [c for c in work.columns if c not in feats]
    X = transform_features(work, artifact, keep=keep)
    pred = model.transform(X)
    pred_col = "prediction" if "prediction" in pred.columns else "predicted_eta"
    rest = [c for c in work.columns if c not in feats and c != "_raw"]
    scored = pred.select(*rest, "_raw.*", F.col(pred_col).alias("predicted_eta"))
    return attach_risk(scored, artifact.residual_std, artifact.osrm_time_median)


def score_requests(requests: DataFrame, model, artifact, hubs: DataFrame) -> DataFrame:
    """Per-request scoring re-aimed as a DataFrame job: one result struct per request."""
    scored = predict_batch(requests, model, artifact, hubs)
    src = F.coalesce(F.col("source_bottleneck_score"), F.lit(0.0))
    dst = F.coalesce(F.col("destination_bottleneck_score"), F.lit(0.0))
    key = [c for c in ("request_id",) if c in scored.columns]
    return scored.select(*key, F.struct(
        F.col("predicted_eta"), F.col("risk_level"), F.col("bottleneck_warning"), F.col("confidence_band"),
        F.col("osrm_time").alias("osrm_baseline"), F.col("eta_vs_osrm_ratio"),
        src.alias("source_bottleneck_score"), dst.alias("destination_bottleneck_score"),
        F.col("route_lane"), F.col("route_insights").alias("insights")).alias("result"))
