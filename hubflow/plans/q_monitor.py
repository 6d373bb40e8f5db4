"""Registered queries: monitoring jobs and Structured Streaming."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from hubflow.operators import ml as ML
from hubflow.operators import monitor as MO
from hubflow.operators.score import attach_risk
from hubflow.plans.common import clean_frame, lane_frame, query, round_doubles
from hubflow.plans.oracle import HUBS, RISK, oracle
from hubflow.plans.q_ml import _FEAT_TR, fitted, standin_model
from hubflow.session import cut_lineage
from hubflow.sources import files, fixtures, store
from hubflow.streaming import scoring as ST

DRIFT_FEATURES = ["osrm_time", "osrm_distance", "segment_osrm_time", "segment_osrm_distance", "segment_delay_ratio", "delay_ratio",
                  "actual_distance_to_destination", "segment_actual_time", "actual_time", "factor", "segment_factor"]


@query("data_drift")
def q_data_drift(spark, sf):
    sp = ML.trip_split(clean_frame(spark, sf))
    out = MO.data_drift(sp.filter(F.col("split") == "train"), sp.filter(F.col("split") == "test"), DRIFT_FEATURES)
    return round_doubles(out)


def _drift_sql():
    parts = []
    for f in DRIFT_FEATURES:
        edges = ", ".join(f"quantile_cont({f}, {i / 10})" for i in range(1, 10))
        parts.append(f"""SELECT '{f}' AS feature, b.k, coalesce(x.p, 0) AS base, coalesce(y.p, 0) AS cur
  FROM range(10) b(k)
  LEFT JOIN (SELECT k, count(*) / sum(count(*)) OVER () AS p FROM (SELECT list_count(list_filter(e, lambda q: {f} > q)) AS k
    FROM tr_ CROSS JOIN (SELECT [{edges}] AS e FROM tr_) WHERE {f} IS NOT NULL) GROUP BY k) x ON x.k = b.k
  LEFT JOIN (SELECT k, count(*) / sum(count(*)) OVER () AS p FROM (SELECT list_count(list_filter(e, lambda q: {f} > q)) AS k
    FROM te_ CROSS JOIN (SELECT [{edges}] AS e FROM tr_) WHERE {f} IS NOT NULL) GROUP BY k) y ON y.k = b.k""")
    body = " UNION ALL ".join(parts)
    return f"""SELECT feature, round(sum((c - b) * ln(c / b)), 6) AS psi, sum((c - b) * ln(c / b)) > 0.2 AS drift FROM (
  SELECT feature, greatest(base, 1e-4) AS b, greatest(cur, 1e-4) AS c FROM ({body})) GROUP BY feature"""


_SPLIT = """tr_ AS (SELECT * FROM clean WHERE CAST('0x' || substr(md5(trip_uuid || '|42'), 1, 8) AS BIGINT) % 100 >= 20),
te_ AS (SELECT * FROM clean WHERE CAST('0x' || substr(md5(trip_uuid || '|42'), 1, 8) AS BIGINT) % 100 < 20)"""
oracle("data_drift", _drift_sql(), _SPLIT)


@query("concept_drift")
def q_concept_drift(spark, sf):
    out = MO.concept_drift(fixtures.scored(spark, sf))
    return round_doubles(out.withColumn("week", F.col("week").cast("string")))


oracle("concept_drift", """SELECT CAST(week AS VARCHAR) AS week, round(mae, 6) AS mae, trips, round(prev, 6) AS prev_mae,
  coalesce(mae > prev * 1.15, false) AS concept_drift FROM (SELECT week, mae, trips, lag(mae) OVER (ORDER BY week) AS prev
  FROM (SELECT date_trunc('week', trip_creation_time) AS week, avg(abs(actual_time - predicted_eta)) AS mae, count(*) AS trips
  FROM scored WHERE actual_time IS NOT NULL GROUP BY 1))""", scored=True)


@query("sla_degradation")
def q_sla_degradation(spark, sf):
    out = MO.sla_degradation(attach_risk(fixtures.scored(spark, sf)))
    return round_doubles(out.withColumn("day", F.col("day").cast("string")))


oracle("sla_degradation", """SELECT CAST(CAST(trip_creation_time AS DATE) AS VARCHAR) AS day,
  round(avg(CAST(risk_level IN ('HIGH', 'CRITICAL') AS DOUBLE)), 6) AS high_risk_share, count(*) AS trips,
  avg(CAST(risk_level IN ('HIGH', 'CRITICAL') AS DOUBLE)) > 0.25 AS sla_alert FROM risk GROUP BY 1""", RISK, scored=True)


@query("retrain_window")
def q_retrain_window(spark, sf):
    seg = clean_frame(spark, sf)
    return MO.retrain_window(seg).groupBy("route_type").agg(F.count(F.lit(1)).alias("rows"))


oracle("retrain_window", """SELECT route_type, count(*) AS rows FROM clean
  WHERE trip_creation_time > (SELECT max(trip_creation_time) FROM clean) - INTERVAL 90 DAY GROUP BY route_type""")


@query("rolling_lane_graph")
def q_rolling_lane_graph(spark, sf):
    """The 90-day lane network of the last day, rolled on from a week before: days added and dropped, nothing rebuilt."""
    path = files.scratch_path(spark, "lane-days")
    MO.lane_day_partials(clean_frame(spark, sf)).repartitionByRange("day").write.parquet(path)  # files hold ranges of days
    partials = files.load_parquet(spark, path)
    last = partials.agg(F.max("day")).first()[0]
    day = last - timedelta(days=7)
    window = MO.window_sums(partials, day)
    for step in (3, 1, 3):
        window = cut_lineage(MO.roll_window(window, partials, day, day + timedelta(days=step)))
        day += timedelta(days=step)
    return round_doubles(MO.window_lanes(window))


oracle("rolling_lane_graph", """SELECT source_center AS u, destination_center AS v, count(*) AS weight, round(avg(segment_delay_ratio), 6) AS avg_delay,
  round(avg(segment_actual_time), 6) AS avg_actual_time, round(avg(segment_osrm_time), 6) AS avg_osrm_time FROM clean
  WHERE source_center IS NOT NULL AND destination_center IS NOT NULL
  AND CAST(trip_creation_time AS DATE) > (SELECT CAST(max(trip_creation_time) AS DATE) FROM clean WHERE source_center IS NOT NULL AND destination_center IS NOT NULL) - 90
  GROUP BY 1, 2""")


@query("graph_staleness")
def q_graph_staleness(spark, sf):
    """A fresh snapshot is used, the same one dated ten days back is stale: the tables are rebuilt from the segments and
    published as the next version; rows of the table used, versions in the store."""
    from hubflow.plans.q_ml import standin_tables
    seg, out = lane_frame(spark, sf), None
    tables = standin_tables(spark, sf, fixtures.hub_table(spark, sf, seg))
    for days in (0, 10):
        path, built = files.scratch_path(spark, "hubs"), datetime.now(timezone.utc) - timedelta(days=days)
        store.persist_graph_tables(spark, tables, path, built_at=built)
        found, origin = store.load_or_build_graph(spark, seg, store=path)
        row = found["pagerank"].agg(F.count(F.lit(1)).alias("hubs")).select(
            F.lit(days).alias("days"), F.lit(bool(MO.graph_staleness(built)["stale"])).alias("stale"), F.lit(origin).alias("origin"), "hubs",
            F.lit(len(store.graph_versions(spark, path))).alias("versions"))
        out = row if out is None else out.unionByName(row)
    return out


oracle("graph_staleness", """SELECT d AS days, d > 7 AS stale, CASE WHEN d > 7 THEN 'built' ELSE 'store' END AS origin,
  (SELECT count(*) FROM hubs) AS hubs, CASE WHEN d > 7 THEN 2 ELSE 1 END AS versions FROM (VALUES (0), (10)) t(d)""", HUBS)


@query("inference_log")
def q_inference_log(spark, sf):
    art, hubs = fitted(spark, sf)
    from hubflow.operators.score import predict_batch
    scored = predict_batch(fixtures.requests(spark, sf), standin_model(), art, hubs)
    path = files.scratch_path(spark, "inference-log")
    log = MO.inference_log(scored, "standin-v1", "snapshot")
    MO.append_inference_log(log, path)
    MO.append_inference_log(log, path)
    return files.load_parquet(spark, path).groupBy("model_version", "risk_level").agg(F.count(F.lit(1)).alias("rows"))


oracle("inference_log", """SELECT 'standin-v1' AS model_version,
  CASE WHEN pts >= 4 THEN 'CRITICAL' WHEN pts >= 3 THEN 'HIGH' WHEN pts >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  2 * count(*) AS rows FROM z GROUP BY 2""", HUBS, _FEAT_TR)


def _request_files(spark, sf) -> str:
    """The request stream's input: several small Parquet files in event-time ranges."""
    path = files.scratch_path(spark, "requests")
    fixtures.requests(spark, sf).repartitionByRange(8, "ts").write.parquet(path)
    return path


def _scored_stream(spark, sf):
    art, hubs = fitted(spark, sf)
    src = ST.read_requests(spark, _request_files(spark, sf))
    return ST.stream_score(src, standin_model(), art, hubs)


@query("stream_score")
def q_stream_score(spark, sf):
    """Requests scored in micro-batches with a pinned version of the published hub tables."""
    from hubflow.plans.q_ml import standin_tables
    out, ck, home = files.scratch_path(spark, "stream-out"), files.scratch_path(spark, "stream-ck"), files.scratch_path(spark, "hubs")
    art, hubs = fitted(spark, sf)
    store.publish_graph_tables(spark, standin_tables(spark, sf, hubs), home)
    ST.run_scored(ST.read_requests(spark, _request_files(spark, sf)), standin_model(), art, home, out, ck,
                  ["request_id", "predicted_eta", "risk_level", "bottleneck_warning"])
    return round_doubles(files.load_parquet(spark, out).drop("batch"))


oracle("stream_score", """SELECT request_id, round(predicted_eta, 6) AS predicted_eta,
  CASE WHEN pts >= 4 THEN 'CRITICAL' WHEN pts >= 3 THEN 'HIGH' WHEN pts >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  mbn >= 0.35 AS bottleneck_warning FROM z""", HUBS, _FEAT_TR)


@query("stream_risk_windows")
def q_stream_risk_windows(spark, sf):
    out, ck = files.scratch_path(spark, "windows-out"), files.scratch_path(spark, "windows-ck")
    ST.run_to_parquet(ST.stream_risk_windows(_scored_stream(spark, sf)), out, ck)
    return files.load_parquet(spark, out).withColumn("window_start", F.col("window_start").cast("string")) \
                                         .withColumn("window_end", F.col("window_end").cast("string"))


# append mode: a window is emitted once the watermark (max event time - 1 hour) passes its end
oracle("stream_risk_windows", """SELECT CAST(window_start AS VARCHAR) AS window_start, CAST(window_start + INTERVAL 1 HOUR AS VARCHAR)
  AS window_end, risk_level, count(*) AS trips FROM (SELECT time_bucket(INTERVAL 1 HOUR, r.ts) AS window_start,
  CASE WHEN pts >= 4 THEN 'CRITICAL' WHEN pts >= 3 THEN 'HIGH' WHEN pts >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM z JOIN (SELECT event_id AS request_id, ts FROM events WHERE event_type = 'purchase') r USING (request_id))
  WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events WHERE event_type = 'purchase') - INTERVAL 1 HOUR
  GROUP BY ALL""", HUBS, _FEAT_TR)
