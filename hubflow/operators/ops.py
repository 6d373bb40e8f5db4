"""Operations KPI tables over a scored batch (one-pass conditional aggregates and top-k)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubflow import schema as S
from hubflow.operators.profile import histogram
from hubflow.operators.quantiles import wide_quantiles

RISKY = ["HIGH", "CRITICAL"]


def summary_cards(df: DataFrame) -> DataFrame:
    """trips, mean ETA, critical count, alerts, SLA-breach %, mean band half-width, high-risk count."""
    hc = F.count_if(F.col("risk_level").isin(*RISKY))
    n = F.count(F.lit(1))
    if "confidence_low" in df.columns and "confidence_high" in df.columns:
        half = F.avg((F.col("confidence_high") - F.col("confidence_low")) / 2)
    else:
        half = F.stddev_samp("predicted_eta") * 0.15
    alerts = F.count_if(F.col("bottleneck_warning")) if "bottleneck_warning" in df.columns else F.lit(0).cast("bigint")
    return df.agg(n.alias("trips_scored"), F.avg("predicted_eta").alias("mean_predicted_eta"),
                  F.count_if(F.col("risk_level") == "CRITICAL").alias("critical_risk_count"),
                  alerts.alias("bottleneck_alerts"),
                  F.round(100 * hc / F.greatest(n, F.lit(1)), 1).alias("sla_breach_pct"),
                  half.alias("avg_confidence_half_width"), hc.alias("high_risk_count"))


def _levels(spark) -> DataFrame:
    return spark.createDataFrame([(i, lv) for i, lv in enumerate(S.RISK_LEVELS)], "level_order int, risk_level string")


def risk_distribution(df: DataFrame) -> DataFrame:
    """Trips per risk level in the fixed order LOW..CRITICAL, zero-filled."""
    c = df.groupBy("risk_level").agg(F.count(F.lit(1)).alias("trips"))
    return (_levels(df.sparkSession).join(c, "risk_level", "left")
            .select("level_order", "risk_level", F.coalesce("trips", F.lit(0)).cast("bigint").alias("trips")))


def eta_vs_osrm(df: DataFrame) -> DataFrame:
    """Scatter rows with the diagonal's extent max(max OSRM, max ETA) x 1.05."""
    lim = df.agg((F.greatest(F.max("osrm_time"), F.max("predicted_eta")) * 1.05).alias("axis_max"))
    return df.select("trip_uuid", "osrm_time", "predicted_eta", "risk_level", "route_lane").crossJoin(F.broadcast(lim))


def lane_congestion(df: DataFrame, k: int = 12) -> DataFrame:
    g = df.groupBy("route_lane").agg(F.avg("predicted_eta").alias("mean_eta"), F.count("predicted_eta").alias("trips"))
    return g.orderBy(F.col("mean_eta").desc(), F.col("route_lane").desc()).limit(k)


def bottleneck_hubs(df: DataFrame, k: int = 12) -> DataFrame:
    g = df.groupBy("source_center").agg(F.max("source_bottleneck_score").alias("bottleneck"),
                                        F.count("predicted_eta").alias("trips"))
    return g.orderBy(F.col("bottleneck").desc_nulls_last(), "source_center").limit(k)


def risk_heatmap(df: DataFrame) -> DataFrame:
    """High-risk rate by route type (rows) x trip hour (columns), missing cells 0; a missing
    hour column means hour 12."""
    work = df if "trip_hour" in df.columns else df.withColumn("trip_hour", F.lit(12))
    work = work.withColumn("is_high_risk", F.col("risk_level").isin(*RISKY).cast("int"))
    idx = "route_type" if "route_type" in work.columns else "risk_level"
    return work.groupBy(idx).pivot("trip_hour", list(range(24))).agg(F.avg("is_high_risk")).na.fill(0.0)


def route_mix(df: DataFrame) -> DataFrame:
    g = df.filter(F.col("route_type").isNotNull()).groupBy("route_type").agg(F.count(F.lit(1)).alias("trips"))
    tot = g.agg(F.sum("trips").alias("_t"))
    return g.crossJoin(F.broadcast(tot)).select("route_type", "trips", (F.col("trips") / F.col("_t")).alias("share"))


def eta_distribution(df: DataFrame, bins: int = 40) -> DataFrame:
    """Equal-width histogram of predicted ETA with the P50 and P90 markers."""
    q = wide_quantiles(df, ["predicted_eta"], [0.5, 0.9]).select(F.col("q_predicted_eta").alias("q"))
    h = histogram(df, "predicted_eta", bins)
    return h.crossJoin(F.broadcast(q.select(F.col("q")[0].alias("p50"), F.col("q")[1].alias("p90"))))


def risk_index(df: DataFrame) -> DataFrame:
    """clip(0.6 x mean risk weight + 40 x mean source score, 0, 100); an empty batch scores 0."""
    w = F.col("risk_level")
    weight = F.lit(S.RISK_INDEX_UNKNOWN_WEIGHT)
    for lv in reversed(S.RISK_LEVELS):
        weight = F.when(w == lv, F.lit(S.RISK_INDEX_WEIGHTS[lv])).otherwise(weight)
    bn = (F.avg(F.coalesce(F.col("source_bottleneck_score"), F.lit(0.0))) * 40
          if "source_bottleneck_score" in df.columns else F.lit(0.0))
    raw = 0.6 * F.avg(weight.cast("double")) + bn
    return df.agg(F.when(F.count(F.lit(1)) == 0, F.lit(0.0))
                  .otherwise(F.least(F.greatest(raw, F.lit(0.0)), F.lit(100.0))).alias("risk_index"))


def risky_lanes(df: DataFrame, k: int = 10, min_trips: int = 3) -> DataFrame:
    g = df.groupBy("route_lane").agg(F.avg((F.col("risk_level") == "CRITICAL").cast("double")).alias("critical_rate"),
                                     F.count("predicted_eta").alias("trips"))
    return g.filter(F.col("trips") >= min_trips).orderBy(F.col("critical_rate").desc(), "route_lane").limit(k)


def hub_hotspots(df: DataFrame, k: int = 15) -> DataFrame:
    """HIGH/CRITICAL trips counted at both ends per hub; avg_eta = (mean as source, 0 if none
    + mean as destination, 0 if none) / 2.  With no risky trip: the busiest source hubs."""
    risky = df.filter(F.col("risk_level").isin(*RISKY))
    src = risky.groupBy(F.col("source_center").alias("hub_id")).agg(
        F.count(F.lit(1)).alias("ns"), F.avg("predicted_eta").alias("es"))
    dst = risky.groupBy(F.col("destination_center").alias("hub_id")).agg(
        F.count(F.lit(1)).alias("nd"), F.avg("predicted_eta").alias("ed"))
    both = src.join(dst, "hub_id", "full_outer").select(
        "hub_id", (F.coalesce("ns", F.lit(0)) + F.coalesce("nd", F.lit(0))).cast("bigint").alias("risky_trips"),
        ((F.coalesce("es", F.lit(0.0)) + F.coalesce("ed", F.lit(0.0))) / 2).alias("avg_eta"))
    main = both.orderBy(F.col("risky_trips").desc(), "hub_id").limit(k)
    # fallback only when the risky set is empty: guarded by a 1-row count (lazy, no driver branch)
    n_risky = risky.agg(F.count(F.lit(1)).alias("_n"))
    busiest = (df.groupBy(F.col("source_center").alias("hub_id"))
                 .agg(F.count("predicted_eta").alias("risky_trips"), F.avg("predicted_eta").alias("avg_eta"))
                 .orderBy(F.col("risky_trips").desc(), "hub_id").limit(k))
    fallback = busiest.crossJoin(F.broadcast(n_risky)).filter(F.col("_n") == 0).drop("_n")
    return main.unionByName(fallback)


def critical_lanes(df: DataFrame, k: int = 10) -> DataFrame:
    risky = df.filter(F.col("risk_level").isin(*RISKY))
    g = risky.groupBy("route_lane").agg(
        F.count("predicted_eta").alias("alert_trips"), F.avg("predicted_eta").alias("mean_eta"),
        F.when(F.bool_or(F.col("risk_level") == "CRITICAL"), "CRITICAL").otherwise("HIGH").alias("worst_risk"))
    return g.orderBy("worst_risk", F.col("alert_trips").desc(), "route_lane").limit(k)


def ops_summary(df: DataFrame) -> DataFrame:
    risky = F.col("risk_level").isin(*RISKY)
    return df.agg(F.count_if(risky).alias("sla_at_risk_trips"),
                  F.count_distinct(F.when(risky, F.col("route_lane"))).alias("critical_lane_count"),
                  F.count_if(F.col("bottleneck_warning")).alias("bottleneck_alerts"),
                  F.count_if(F.col("risk_level") == "CRITICAL").alias("critical_trips"))


def congestion_hotspots(df: DataFrame, k: int = 12) -> DataFrame:
    """Per lane: trips, mean ETA, most frequent risk level (named ``max_risk``, smallest on ties),
    max source bottleneck score; top ``k`` by mean ETA."""
    g = df.groupBy("route_lane").agg(
        F.count("predicted_eta").alias("trips"), F.avg("predicted_eta").alias("mean_eta"),
        F.mode("risk_level", True).alias("max_risk"), F.max("source_bottleneck_score").alias("bottleneck"))
    return g.orderBy(F.col("mean_eta").desc(), "route_lane").limit(k)


def network_summary(df: DataFrame) -> DataFrame:
    """Distinct hubs over both columns, distinct lanes, mean source score, same-community %, rows."""
    hubs = (df.select(F.col("source_center").alias("h")).union(df.select(F.col("destination_center").alias("h")))
              .distinct().agg(F.count(F.lit(1)).alias("unique_hubs")))
    same = F.coalesce(F.col("source_community") == F.col("destination_community"), F.lit(False)).cast("double")
    rest = df.agg(F.count_distinct("route_lane").alias("unique_lanes"),
                  F.avg("source_bottleneck_score").alias("avg_source_bottleneck"),
                  (F.avg(same) * 100).alias("same_community_pct"),
                  F.count(F.lit(1)).alias("graph_enriched_trips"))
    return hubs.crossJoin(rest)


def risk_breakdown(df: DataFrame) -> DataFrame:
    g = df.groupBy("risk_level").agg(F.count(F.lit(1)).alias("trips"), F.avg("predicted_eta").alias("mean_eta"))
    return g.orderBy(F.col("trips").desc(), "risk_level")


def actual_vs_predicted(df: DataFrame, actual: str = "actual_time", pred: str = "predicted_eta") -> DataFrame:
    """Scatter rows with the common axis limits (min and max over both series)."""
    lim = df.agg(F.least(F.min(actual), F.min(pred)).alias("axis_min"),
                 F.greatest(F.max(actual), F.max(pred)).alias("axis_max"))
    return df.select(S.TRIP_ID, actual, pred).crossJoin(F.broadcast(lim))
