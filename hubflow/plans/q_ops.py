"""Registered queries: scoring, risk and operations tables and evaluation tables
(SURVEY §2.D/§2.H) over closed-form stand-in predictions."""

from __future__ import annotations

from pyspark.sql import functions as F


from hubflow.operators import ml as ML
from hubflow.operators import ops as O
from hubflow.operators import score as SC
from hubflow.plans.common import clean_frame, query, round_doubles
from hubflow.plans.oracle import RISK, oracle
from hubflow.sources import fixtures


def risk_frame(spark, sf):
    return SC.attach_risk(fixtures.scored(spark, sf))


def evaluated(spark, sf):
    """Test-side segments with a stand-in prediction (osrm_time x 1.1 + segment OSRM time)."""
    seg = ML.trip_split(clean_frame(spark, sf)).filter(F.col("split") == "test")
    return seg.withColumn("prediction", F.col("osrm_time") * 1.1 + F.col("segment_osrm_time"))


EVAL = """ev AS (SELECT *, osrm_time * 1.1 + segment_osrm_time AS prediction FROM clean
  WHERE CAST('0x' || substr(md5(trip_uuid || '|42'), 1, 8) AS BIGINT) % 100 < 20)"""


def reg(key, fn, sql, *extra):
    query(key)(fn)
    oracle(key, sql, *extra, scored=True)


# ---- risk columns -------------------------------------------------------------------------

reg("eta_ratio", lambda spark, sf: round_doubles(risk_frame(spark, sf).select("trip_uuid", "eta_vs_osrm_ratio")),
    "SELECT trip_uuid, round(eta_vs_osrm_ratio, 6) AS eta_vs_osrm_ratio FROM risk", RISK)
reg("confidence_band", lambda spark, sf: round_doubles(
    risk_frame(spark, sf).select("trip_uuid", "confidence_low", "confidence_high")),
    "SELECT trip_uuid, round(confidence_low, 6) AS confidence_low, round(confidence_high, 6) AS confidence_high FROM risk",
    RISK)
reg("bottleneck_warning", lambda spark, sf: risk_frame(spark, sf).groupBy("bottleneck_warning").agg(
    F.count(F.lit(1)).alias("n")), "SELECT bottleneck_warning, count(*) AS n FROM risk GROUP BY 1", RISK)
reg("risk_level", lambda spark, sf: risk_frame(spark, sf).select("trip_uuid", "risk_level"),
    "SELECT trip_uuid, risk_level FROM risk", RISK)
reg("route_insights", lambda spark, sf: risk_frame(spark, sf).groupBy("route_insights").agg(
    F.count(F.lit(1)).alias("n")), "SELECT route_insights, count(*) AS n FROM risk GROUP BY 1", RISK)
reg("prediction_error", lambda spark, sf: round_doubles(
    SC.prediction_error(fixtures.scored(spark, sf)).select("trip_uuid", "prediction_error")),
    "SELECT trip_uuid, round(abs(actual_time - predicted_eta), 6) AS prediction_error FROM scored")


@query("batch_sample")
def q_batch_sample(spark, sf):
    return SC.batch_sample(clean_frame(spark, sf), 500).select("trip_uuid", "segment_key", "source_center",
                                                               "destination_center")


oracle("batch_sample", """SELECT trip_uuid, segment_key, source_center, destination_center FROM (
  SELECT *, row_number() OVER (PARTITION BY trip_uuid ORDER BY segment_key) AS rn FROM clean) WHERE rn = 1
  ORDER BY md5(trip_uuid || '|42'), trip_uuid LIMIT 500""")

reg("top_risky", lambda spark, sf: round_doubles(SC.top_risky(risk_frame(spark, sf), 10)),
    """SELECT route_lane, round(predicted_eta, 6) AS predicted_eta, risk_level, bottleneck_warning, route_insights
  FROM risk ORDER BY predicted_eta DESC, trip_uuid LIMIT 10""", RISK)

# ---- KPI tables -------------------------------------------------------------------------------

reg("summary_cards", lambda spark, sf: round_doubles(O.summary_cards(risk_frame(spark, sf))),
    """SELECT count(*) AS trips_scored, round(avg(predicted_eta), 6) AS mean_predicted_eta,
  count_if(risk_level = 'CRITICAL') AS critical_risk_count, count_if(bottleneck_warning) AS bottleneck_alerts,
  round(100.0 * count_if(risk_level IN ('HIGH', 'CRITICAL')) / count(*), 1) AS sla_breach_pct,
  round(avg((confidence_high - confidence_low) / 2), 6) AS avg_confidence_half_width,
  count_if(risk_level IN ('HIGH', 'CRITICAL')) AS high_risk_count FROM risk""", RISK)
reg("risk_distribution", lambda spark, sf: O.risk_distribution(risk_frame(spark, sf)),
    """SELECT l.i AS level_order, l.r AS risk_level, coalesce(c.n, 0) AS trips
  FROM (SELECT * FROM (VALUES (0, 'LOW'), (1, 'MEDIUM'), (2, 'HIGH'), (3, 'CRITICAL')) t(i, r)) l
  LEFT JOIN (SELECT risk_level, count(*) AS n FROM risk GROUP BY 1) c ON c.risk_level = l.r""", RISK)
reg("eta_vs_osrm", lambda spark, sf: round_doubles(O.eta_vs_osrm(risk_frame(spark, sf))),
    """SELECT trip_uuid, osrm_time, round(predicted_eta, 6) AS predicted_eta, risk_level, route_lane,
  round(greatest(max(osrm_time) OVER (), max(predicted_eta) OVER ()) * 1.05, 6) AS axis_max FROM risk""", RISK)
reg("lane_congestion", lambda spark, sf: round_doubles(O.lane_congestion(risk_frame(spark, sf))),
    """SELECT route_lane, round(avg(predicted_eta), 6) AS mean_eta, count(predicted_eta) AS trips FROM risk
  GROUP BY route_lane ORDER BY avg(predicted_eta) DESC, route_lane DESC LIMIT 12""", RISK)
reg("bottleneck_hubs", lambda spark, sf: round_doubles(O.bottleneck_hubs(risk_frame(spark, sf))),
    """SELECT source_center, round(max(source_bottleneck_score), 6) AS bottleneck, count(predicted_eta) AS trips
  FROM risk GROUP BY source_center ORDER BY max(source_bottleneck_score) DESC NULLS LAST, source_center LIMIT 12""", RISK)


@query("risk_heatmap")
def q_risk_heatmap(spark, sf):
    return round_doubles(O.risk_heatmap(risk_frame(spark, sf)))


oracle("risk_heatmap", "SELECT route_type, " + ", ".join(
    f"round(coalesce(avg(CAST(risk_level IN ('HIGH', 'CRITICAL') AS INT)) FILTER (WHERE trip_hour = {h}), 0), 6) AS \"{h}\""
    for h in range(24)) + " FROM risk GROUP BY route_type", RISK, scored=True)

reg("route_mix", lambda spark, sf: round_doubles(O.route_mix(risk_frame(spark, sf))),
    """SELECT route_type, count(*) AS trips, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM risk
  GROUP BY route_type""", RISK)
reg("eta_distribution", lambda spark, sf: round_doubles(O.eta_distribution(risk_frame(spark, sf))),
    """SELECT CAST(b AS INT) AS bin, round(lo + (hi - lo) * (b - 1) / 40, 6) AS bin_low, round(lo + (hi - lo) * b / 40, 6) AS bin_high,
  count(*) AS count, round(p50, 6) AS p50, round(p90, 6) AS p90 FROM (
  SELECT CASE WHEN hi - lo = 0 THEN 1 ELSE least(floor((predicted_eta - lo) / (hi - lo) * 40) + 1, 40) END AS b, lo, hi
  FROM risk CROSS JOIN (SELECT min(predicted_eta) AS lo, max(predicted_eta) AS hi FROM risk))
  CROSS JOIN (SELECT quantile_cont(predicted_eta, 0.5) AS p50, quantile_cont(predicted_eta, 0.9) AS p90 FROM risk)
  GROUP BY b, lo, hi, p50, p90""", RISK)
reg("risk_index", lambda spark, sf: round_doubles(O.risk_index(risk_frame(spark, sf))),
    """SELECT round(least(greatest(0.6 * avg(CASE risk_level WHEN 'LOW' THEN 0 WHEN 'MEDIUM' THEN 25 WHEN 'HIGH' THEN 60
  WHEN 'CRITICAL' THEN 100 ELSE 30 END) + 40 * avg(coalesce(source_bottleneck_score, 0)), 0), 100), 6) AS risk_index
  FROM risk""", RISK)
reg("risky_lanes", lambda spark, sf: round_doubles(O.risky_lanes(risk_frame(spark, sf))),
    """SELECT route_lane, round(avg(CAST(risk_level = 'CRITICAL' AS DOUBLE)), 6) AS critical_rate,
  count(predicted_eta) AS trips FROM risk GROUP BY route_lane HAVING count(predicted_eta) >= 3
  ORDER BY avg(CAST(risk_level = 'CRITICAL' AS DOUBLE)) DESC, route_lane LIMIT 10""", RISK)
reg("hub_hotspots", lambda spark, sf: round_doubles(O.hub_hotspots(risk_frame(spark, sf))),
    """SELECT coalesce(s.h, d.h) AS hub_id, coalesce(s.n, 0) + coalesce(d.n, 0) AS risky_trips,
  round((coalesce(s.e, 0) + coalesce(d.e, 0)) / 2, 6) AS avg_eta
  FROM (SELECT source_center AS h, count(*) AS n, avg(predicted_eta) AS e FROM risk WHERE risk_level IN ('HIGH', 'CRITICAL') GROUP BY 1) s
  FULL OUTER JOIN (SELECT destination_center AS h, count(*) AS n, avg(predicted_eta) AS e FROM risk
    WHERE risk_level IN ('HIGH', 'CRITICAL') GROUP BY 1) d ON s.h = d.h
  ORDER BY risky_trips DESC, hub_id LIMIT 15""", RISK)
reg("critical_lanes", lambda spark, sf: round_doubles(O.critical_lanes(risk_frame(spark, sf))),
    """SELECT route_lane, count(predicted_eta) AS alert_trips, round(avg(predicted_eta), 6) AS mean_eta,
  CASE WHEN bool_or(risk_level = 'CRITICAL') THEN 'CRITICAL' ELSE 'HIGH' END AS worst_risk
  FROM risk WHERE risk_level IN ('HIGH', 'CRITICAL') GROUP BY route_lane
  ORDER BY worst_risk, alert_trips DESC, route_lane LIMIT 10""", RISK)
reg("ops_summary", lambda spark, sf: O.ops_summary(risk_frame(spark, sf)),
    """SELECT count_if(risk_level IN ('HIGH', 'CRITICAL')) AS sla_at_risk_trips,
  count(DISTINCT CASE WHEN risk_level IN ('HIGH', 'CRITICAL') THEN route_lane END) AS critical_lane_count,
  count_if(bottleneck_warning) AS bottleneck_alerts, count_if(risk_level = 'CRITICAL') AS critical_trips FROM risk""", RISK)
reg("congestion_hotspots", lambda spark, sf: round_doubles(O.congestion_hotspots(risk_frame(spark, sf))),
    """SELECT l.route_lane, l.trips, round(l.mean_eta, 6) AS mean_eta, m.risk_level AS max_risk, round(l.bottleneck, 6) AS bottleneck
  FROM (SELECT route_lane, count(predicted_eta) AS trips, avg(predicted_eta) AS mean_eta,
    max(source_bottleneck_score) AS bottleneck FROM risk GROUP BY route_lane) l
  JOIN (SELECT route_lane, risk_level FROM (SELECT route_lane, risk_level, row_number() OVER (PARTITION BY route_lane
    ORDER BY count(*) DESC, risk_level) AS rn FROM risk GROUP BY route_lane, risk_level) WHERE rn = 1) m
  ON m.route_lane = l.route_lane ORDER BY l.mean_eta DESC, l.route_lane LIMIT 12""", RISK)
reg("network_summary", lambda spark, sf: round_doubles(O.network_summary(risk_frame(spark, sf))),
    """SELECT (SELECT count(*) FROM (SELECT source_center FROM risk UNION SELECT destination_center FROM risk)) AS unique_hubs,
  count(DISTINCT route_lane) AS unique_lanes, round(avg(source_bottleneck_score), 6) AS avg_source_bottleneck,
  round(avg(CAST(coalesce(source_community = destination_community, false) AS DOUBLE)) * 100, 6) AS same_community_pct,
  count(*) AS graph_enriched_trips FROM risk""", RISK)
reg("risk_breakdown", lambda spark, sf: round_doubles(O.risk_breakdown(risk_frame(spark, sf))),
    """SELECT risk_level, count(*) AS trips, round(avg(predicted_eta), 6) AS mean_eta FROM risk GROUP BY risk_level""", RISK)
reg("actual_vs_predicted", lambda spark, sf: round_doubles(O.actual_vs_predicted(risk_frame(spark, sf))),
    """SELECT trip_uuid, actual_time, round(predicted_eta, 6) AS predicted_eta,
  round(least(min(actual_time) OVER (), min(predicted_eta) OVER ()), 6) AS axis_min,
  round(greatest(max(actual_time) OVER (), max(predicted_eta) OVER ()), 6) AS axis_max FROM risk""", RISK)

# ---- evaluation tables (stand-in prediction on held-out segments) -----------------------------

reg("regression_metrics", lambda spark, sf: round_doubles(ML.regression_metrics(evaluated(spark, sf))),
    """SELECT round(avg(abs(actual_time - prediction)), 6) AS MAE,
  round(sqrt(avg((actual_time - prediction) * (actual_time - prediction))), 6) AS RMSE,
  round(1 - sum((actual_time - prediction) * (actual_time - prediction)) / (var_pop(actual_time) * count(*)), 6) AS R2,
  count(*) AS n FROM ev""", EVAL)
reg("metrics_frame", lambda spark, sf: round_doubles(
    ML.metrics_frame("standin", ML.regression_metrics(evaluated(spark, sf))).unionByName(
        ML.metrics_frame("osrm_only", ML.regression_metrics(evaluated(spark, sf).withColumn("prediction", F.col("osrm_time")))))),
    """SELECT 'standin' AS Model, round(avg(abs(actual_time - prediction)), 6) AS MAE,
  round(sqrt(avg((actual_time - prediction) ^ 2)), 6) AS RMSE,
  round(1 - sum((actual_time - prediction) ^ 2) / (var_pop(actual_time) * count(*)), 6) AS R2, count(*) AS n FROM ev
  UNION ALL SELECT 'osrm_only', round(avg(abs(actual_time - osrm_time)), 6), round(sqrt(avg((actual_time - osrm_time) ^ 2)), 6),
  round(1 - sum((actual_time - osrm_time) ^ 2) / (var_pop(actual_time) * count(*)), 6), count(*) FROM ev""", EVAL)
reg("mae_by_route_type", lambda spark, sf: round_doubles(ML.mae_by_route_type(evaluated(spark, sf))),
    "SELECT route_type, count(*) AS n, round(avg(abs(actual_time - prediction)), 6) AS MAE FROM ev GROUP BY route_type", EVAL)
for _key, _col, _name in [("error_hotspots_source", "source_center", "hub_id"),
                          ("error_hotspots_destination", "destination_center", "hub_id"),
                          ("error_hotspots_lane", "route_lane", "route_lane")]:
    reg(_key, (lambda c: lambda spark, sf: round_doubles(ML.error_hotspots(evaluated(spark, sf), c)))(_col),
        f"""SELECT {_col} AS {_name}, count(*) AS segments, round(avg(abs(actual_time - prediction)), 6) AS MAE FROM ev
  WHERE {_col} IS NOT NULL GROUP BY {_col} ORDER BY avg(abs(actual_time - prediction)) DESC, {_name} LIMIT 25""", EVAL)
reg("worst_predictions", lambda spark, sf: round_doubles(ML.worst_predictions(evaluated(spark, sf))),
    """SELECT trip_uuid, route_lane, route_type, source_center, destination_center, actual_time,
  round(prediction, 6) AS predicted, round(abs(actual_time - prediction), 6) AS abs_error FROM ev
  ORDER BY abs(actual_time - prediction) DESC, segment_key LIMIT 15""", EVAL)
reg("residual_histogram", lambda spark, sf: round_doubles(ML.residual_histogram(evaluated(spark, sf))),
    """SELECT CAST(b AS INT) AS bin, round(lo + (hi - lo) * (b - 1) / 60, 6) AS bin_low, round(lo + (hi - lo) * b / 60, 6) AS bin_high,
  count(*) AS count, round(amin, 6) AS axis_min, round(amax, 6) AS axis_max FROM (
  SELECT CASE WHEN hi - lo = 0 THEN 1 ELSE least(floor((r - lo) / (hi - lo) * 60) + 1, 60) END AS b, lo, hi FROM
  (SELECT actual_time - prediction AS r FROM ev) CROSS JOIN (SELECT min(actual_time - prediction) AS lo,
   max(actual_time - prediction) AS hi FROM ev))
  CROSS JOIN (SELECT least(min(actual_time), min(prediction)) AS amin, greatest(max(actual_time), max(prediction)) AS amax FROM ev)
  GROUP BY b, lo, hi, amin, amax""", EVAL)
reg("residual_std", lambda spark, sf: round_doubles(evaluated(spark, sf).agg(
    F.stddev_samp(F.col("actual_time") - F.col("prediction")).alias("residual_std"))),
    "SELECT round(stddev_samp(actual_time - prediction), 6) AS residual_std FROM ev", EVAL)


@query("split_leak_check")
def q_split_leak_check(spark, sf):
    return ML.split_leak_check(ML.trip_split(clean_frame(spark, sf)))


oracle("split_leak_check", """SELECT trip_uuid, count(DISTINCT s) AS sides FROM (SELECT trip_uuid,
  CASE WHEN CAST('0x' || substr(md5(trip_uuid || '|42'), 1, 8) AS BIGINT) % 100 < 20 THEN 'test' ELSE 'train' END AS s
  FROM clean) GROUP BY trip_uuid HAVING count(DISTINCT s) > 1""")


@query("trip_split")
def q_trip_split(spark, sf):
    return ML.trip_split(clean_frame(spark, sf)).groupBy("split").agg(
        F.count_distinct("trip_uuid").alias("trips"), F.count(F.lit(1)).alias("rows"))


oracle("trip_split", """SELECT s AS split, count(DISTINCT trip_uuid) AS trips, count(*) AS rows FROM (SELECT trip_uuid,
  CASE WHEN CAST('0x' || substr(md5(trip_uuid || '|42'), 1, 8) AS BIGINT) % 100 < 20 THEN 'test' ELSE 'train' END AS s
  FROM clean) GROUP BY s""")


