"""Registered queries: cleaning, quality and exploratory aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from hubflow import schema as S
from hubflow.operators import clean as C
from hubflow.operators import profile as P
from hubflow.plans.common import clean_frame, query, raw_frame, round_doubles
from hubflow.plans.oracle import oracle
from hubflow.sources import fixtures

# ---- 2.B cleaning ----------------------------------------------------------------------

_TIMES = ("trip_creation_time", "od_start_time", "od_end_time")


def shown_times(df):
    """Timestamps as text to the second, which both engines write alike."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in _TIMES})


TIMES_SQL = ", ".join(f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in _TIMES)


@query("clean_segments")
def q_clean_segments(spark, sf):
    return round_doubles(shown_times(clean_frame(spark, sf)))


oracle("clean_segments", """SELECT data, trip_uuid, route_schedule_uuid, route_type, source_center, destination_center,
  source_name, destination_name, actual_time, osrm_time, segment_actual_time, segment_osrm_time,
  round(delay_ratio, 6) AS delay_ratio, round(segment_delay_ratio, 6) AS segment_delay_ratio, route_lane,
  round(actual_distance_to_destination, 6) AS actual_distance_to_destination, osrm_distance, segment_osrm_distance,
  round(factor, 6) AS factor, round(segment_factor, 6) AS segment_factor, is_cutoff, segment_key, """ + TIMES_SQL + " FROM clean")


@query("delay_ratios")
def q_delay_ratios(spark, sf):
    df = C.add_delay_ratios(fixtures.segments(spark, sf))
    return round_doubles(df.select("segment_key", "delay_ratio", "segment_delay_ratio"))


oracle("delay_ratios", """SELECT segment_key, round(delay_ratio, 6) AS delay_ratio,
  round(segment_delay_ratio, 6) AS segment_delay_ratio FROM raw""")


@query("route_lane")
def q_route_lane(spark, sf):
    return C.add_route_lane(fixtures.segments(spark, sf)).groupBy("route_lane").agg(
        F.count(F.lit(1)).alias("n"))


oracle("route_lane", "SELECT route_lane, count(*) AS n FROM raw GROUP BY route_lane")


@query("trip_time_parts")
def q_trip_time_parts(spark, sf):
    df = C.add_trip_time_parts(fixtures.segments(spark, sf))
    return df.groupBy("trip_hour", "trip_dayofweek", "trip_day_name").agg(F.count(F.lit(1)).alias("n"))


oracle("trip_time_parts", """SELECT trip_hour, trip_dayofweek, trip_day_name, count(*) AS n FROM raw
  GROUP BY ALL""")


@query("temporal_generic")
def q_temporal_generic(spark, sf):
    df = C.add_temporal_parts(fixtures.segments(spark, sf), "od_start_time", "od_start")
    return df.groupBy("od_start_hour", "od_start_dow", "od_start_is_weekend").agg(F.count(F.lit(1)).alias("n"))


oracle("temporal_generic", """SELECT CAST(hour(od_start_time) AS INT) AS od_start_hour,
  CAST(isodow(od_start_time) - 1 AS INT) AS od_start_dow,
  CAST(isodow(od_start_time) - 1 >= 5 AS INT) AS od_start_is_weekend, count(*) AS n FROM segments GROUP BY ALL""")


@query("coerce_datetime")
def q_coerce_datetime(spark, sf):
    # timestamps travel as text (as in the raw CSV), then parse back; one malformed value per
    # 97 trips must come back null rather than fail the job
    seg = fixtures.segments(spark, sf)
    txt = seg.select("segment_key", F.when(F.col("cutoff_factor") == 7, F.lit("not a time"))
                     .otherwise(F.col("od_end_time").cast("string")).alias("od_end_time"),
                     F.col("trip_creation_time").cast("string").alias("trip_creation_time"))
    parsed = C.coerce_datetime(txt, ["od_end_time", "trip_creation_time"])
    return parsed.select("segment_key", F.col("od_end_time").cast("string").alias("od_end_time"),
                         F.col("trip_creation_time").cast("string").alias("trip_creation_time"))


oracle("coerce_datetime", """SELECT segment_key,
  CASE WHEN cutoff_factor = 7 THEN NULL ELSE strftime(od_end_time, '%Y-%m-%d %H:%M:%S') END AS od_end_time,
  strftime(trip_creation_time, '%Y-%m-%d %H:%M:%S') AS trip_creation_time FROM segments""")


@query("parsed_rate")
def q_parsed_rate(spark, sf):
    seg = fixtures.segments(spark, sf)
    # a text copy where every 7th line number's cutoff is unparseable, parsed back
    txt = seg.withColumn("cutoff_timestamp", F.when(F.col("cutoff_factor") == 7, F.lit("n/a"))
                         .otherwise(F.col("cutoff_timestamp").cast("string")))
    return round_doubles(C.parsed_rate(C.coerce_datetime(txt)))


oracle("parsed_rate", """SELECT round(avg(CASE WHEN cutoff_factor = 7 THEN 0.0 ELSE 1.0 END) * 100, 6) AS parsed_pct
  FROM segments""")


@query("drop_missing_targets")
def q_drop_missing_targets(spark, sf):
    seg = fixtures.segments(spark, sf)
    seg = seg.withColumn("actual_time", F.when(F.col("segment_actual_time") < 0, None).otherwise(F.col("actual_time")))
    return C.drop_missing_targets(seg).groupBy("route_type").agg(F.count(F.lit(1)).alias("n"))


oracle("drop_missing_targets", """SELECT route_type, count(*) AS n FROM segments WHERE segment_actual_time >= 0
  GROUP BY route_type""")


@query("quality_flags")
def q_quality_flags(spark, sf):
    f = C.quality_flags(raw_frame(spark, sf))
    cols = [c for c in f.columns if c.startswith("flag_")]
    return f.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


_P99 = "p99 AS (SELECT quantile_cont(delay_ratio, 0.99) AS pt, quantile_cont(segment_delay_ratio, 0.99) AS ps FROM raw)"
_FLAGS = """flags AS (SELECT coalesce(actual_time < 0, false) AS flag_negative_actual,
  coalesce(segment_actual_time < 0, false) AS flag_negative_segment,
  coalesce(osrm_time = 0, false) AS flag_zero_osrm, coalesce(segment_osrm_time = 0, false) AS flag_zero_segment_osrm,
  coalesce(delay_ratio > pt, false) AS flag_extreme_delay, coalesce(segment_delay_ratio > ps, false) AS flag_extreme_segment_delay
  FROM raw CROSS JOIN p99)"""
oracle("quality_flags", """SELECT *, count(*) AS n FROM (SELECT *, flag_negative_actual OR flag_negative_segment
  OR flag_zero_osrm OR flag_zero_segment_osrm OR flag_extreme_delay OR flag_extreme_segment_delay AS flag_any_issue
  FROM flags) GROUP BY ALL""", _P99, _FLAGS)


@query("quality_report")
def q_quality_report(spark, sf):
    return C.quality_report(raw_frame(spark, sf))


oracle("quality_report", """SELECT issue, count, round(count / n * 100, 6) AS pct_of_rows FROM (
  SELECT count(*) AS n, count_if(flag_negative_actual) AS negative_actual,
  count_if(flag_negative_segment) AS negative_segment_actual, count_if(flag_zero_osrm) AS zero_osrm,
  count_if(flag_zero_segment_osrm) AS zero_segment_osrm, count_if(flag_extreme_delay) AS extreme_delay_ratio,
  count_if(flag_extreme_segment_delay) AS extreme_segment_delay_ratio,
  count_if(flag_negative_actual OR flag_negative_segment OR flag_zero_osrm OR flag_zero_segment_osrm
           OR flag_extreme_delay OR flag_extreme_segment_delay) AS any_issue FROM flags)
UNPIVOT (count FOR issue IN (negative_actual, negative_segment_actual, zero_osrm, zero_segment_osrm,
  extreme_delay_ratio, extreme_segment_delay_ratio, any_issue))""", _P99, _FLAGS)


_MISSING_COLS = S.PROCESSED_COLS + ["cutoff_timestamp", "cutoff_factor", "segment_key"]


@query("missing_summary")
def q_missing_summary(spark, sf):
    return C.missing_summary(raw_frame(spark, sf).select(*_MISSING_COLS))


oracle("missing_summary", "SELECT column_name AS \"column\", missing_count, round(missing_count / n * 100, 6) AS missing_pct FROM ("
       "SELECT count(*) AS n, " + ", ".join(f"count_if({c} IS NULL) AS {c}" for c in _MISSING_COLS)
       + " FROM raw) UNPIVOT (missing_count FOR column_name IN (" + ", ".join(_MISSING_COLS) + "))")

_PROFILE_COLS = [c for c in S.PROCESSED_COLS if c not in _TIMES] + ["segment_key", *_TIMES]
_NUMBERS = ("actual_time", "osrm_time", "segment_actual_time", "segment_osrm_time", "delay_ratio", "segment_delay_ratio",
            "actual_distance_to_destination", "osrm_distance", "segment_osrm_distance", "factor", "segment_factor")


@query("table_profile")
def q_table_profile(spark, sf):
    prof = C.table_profile(shown_times(clean_frame(spark, sf)), _PROFILE_COLS).drop("dtype")
    return round_doubles(prof)


def _profile_sql():
    parts = []
    for c in _PROFILE_COLS:
        num = c in _NUMBERS
        x = f"strftime({c}, '%Y-%m-%d %H:%M:%S')" if c in _TIMES else c
        m = (f"round(avg({c}), 6), round(stddev_samp({c}), 6), round(min({c}), 6), round(quantile_cont({c}, 0.25), 6), "
             f"round(quantile_cont({c}, 0.5), 6), round(quantile_cont({c}, 0.75), 6), round(max({c}), 6)"
             if num else "NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE")
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS count, {m},
  (SELECT count(DISTINCT {x}) FROM clean) AS "unique",
  (SELECT v FROM (SELECT CAST({x} AS VARCHAR) AS v, count(*) AS f FROM clean WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY f DESC, v LIMIT 1) AS top,
  (SELECT max(f) FROM (SELECT count(*) AS f FROM clean WHERE {c} IS NOT NULL GROUP BY {x})) AS freq FROM clean""")
    cols = '"column", count, mean, std, min, p25, p50, p75, max, "unique", top, freq'
    body = " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)
    return f"SELECT * FROM (SELECT * FROM ({body})) t({cols})"


oracle("table_profile", _profile_sql())


@query("prepare_display")
def q_prepare_display(spark, sf):
    df = fixtures.scored(spark, sf).withColumn("eta_vs_osrm_ratio", F.col("predicted_eta") / F.col("osrm_time"))
    return C.prepare_display(df).select("trip_uuid", "predicted_eta", "osrm_time", "source_bottleneck_score",
                                        "eta_vs_osrm_ratio", "destination_community")


oracle("prepare_display", """SELECT trip_uuid, round_even(predicted_eta * 10, 0) / 10 AS predicted_eta,
  round_even(osrm_time * 10, 0) / 10 AS osrm_time,
  round_even(source_bottleneck_score * 1000, 0) / 1000 AS source_bottleneck_score,
  round_even(predicted_eta / osrm_time * 10, 0) / 10 AS eta_vs_osrm_ratio,
  destination_community FROM scored""", scored=True)


# ---- 2.D exploratory aggregates ---------------------------------------------------------

@query("univariate_summary")
def q_univariate_summary(spark, sf):
    return P.univariate_summary(raw_frame(spark, sf), decimals=6)


def _univariate_sql():
    parts = []
    for c in S.UNIVARIATE_COLS:
        parts.append(f"""SELECT '{c}' AS variable, count({c}) AS count, round(avg({c}), 6) AS mean,
  round(median({c}), 6) AS median, round(stddev_samp({c}), 6) AS std, round(skewness({c}), 6) AS skewness,
  round(q1 - 1.5 * (q3 - q1), 6) AS iqr_low, round(q3 + 1.5 * (q3 - q1), 6) AS iqr_high,
  count_if({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outlier_count,
  round(count_if({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) / count(*) * 100, 6) AS outlier_pct
  FROM raw CROSS JOIN (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM raw)
  GROUP BY q1, q3""")
    return " UNION ALL ".join(parts)


oracle("univariate_summary", _univariate_sql())


@query("iqr_bounds")
def q_iqr_bounds(spark, sf):
    return round_doubles(P.iqr_bounds(raw_frame(spark, sf), "segment_delay_ratio"))


oracle("iqr_bounds", """SELECT round(q1, 6) AS q1, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS iqr_low,
  round(q3 + 1.5 * (q3 - q1), 6) AS iqr_high FROM (SELECT quantile_cont(segment_delay_ratio, 0.25) AS q1,
  quantile_cont(segment_delay_ratio, 0.75) AS q3 FROM raw)""")


@query("capped_distribution")
def q_capped_distribution(spark, sf):
    return round_doubles(P.capped_distribution(raw_frame(spark, sf), "delay_ratio", bins=40))


oracle("capped_distribution", """SELECT CAST(b AS INT) AS bin, round(lo + (hi - lo) * (b - 1) / 40, 6) AS bin_low,
  round(lo + (hi - lo) * b / 40, 6) AS bin_high, count(*) AS count FROM (
  SELECT CASE WHEN hi - lo = 0 THEN 1 ELSE least(floor((x - lo) / (hi - lo) * 40) + 1, 40) END AS b, lo, hi
  FROM (SELECT least(delay_ratio, cap) AS x FROM raw CROSS JOIN (SELECT quantile_cont(delay_ratio, 0.99) AS cap FROM raw)
        WHERE delay_ratio IS NOT NULL) c
  CROSS JOIN (SELECT min(least(delay_ratio, cap)) AS lo, max(least(delay_ratio, cap)) AS hi FROM raw
              CROSS JOIN (SELECT quantile_cont(delay_ratio, 0.99) AS cap FROM raw) WHERE delay_ratio IS NOT NULL) r)
GROUP BY b, lo, hi""")


@query("route_compare")
def q_route_compare(spark, sf):
    return round_doubles(P.route_compare(raw_frame(spark, sf), decimals=6))


oracle("route_compare", "SELECT route_type, " + ", ".join(
    f"count({c}) AS {c}_count, round(avg({c}), 6) AS {c}_mean, round(median({c}), 6) AS {c}_median, "
    f"round(stddev_samp({c}), 6) AS {c}_std" for c in S.ROUTE_COMPARE_COLS)
    + " FROM raw WHERE route_type IS NOT NULL GROUP BY route_type")


@query("route_box_stats")
def q_route_box_stats(spark, sf):
    return round_doubles(P.route_box_stats(raw_frame(spark, sf)))


def _box(col, name):
    return (f"SELECT route_type, round(min({col}), 6) AS min, round(quantile_cont({col}, 0.25), 6) AS q1, "
            f"round(quantile_cont({col}, 0.5), 6) AS median, round(quantile_cont({col}, 0.75), 6) AS q3, "
            f"round(max({col}), 6) AS max, '{name}' AS measure FROM capped GROUP BY route_type")


oracle("route_box_stats", _box("actual_time", "actual_time") + " UNION ALL " + _box("drc", "delay_ratio_capped"),
       """capped AS (SELECT *, least(delay_ratio, cap) AS drc FROM raw CROSS JOIN
  (SELECT quantile_cont(delay_ratio, 0.99) AS cap FROM raw) WHERE route_type IS NOT NULL)""")


@query("corr_matrix")
def q_corr_matrix(spark, sf):
    return round_doubles(P.corr_matrix(raw_frame(spark, sf)))


def _corr_sql():
    cols = S.CORR_COLS
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                parts.append(f"SELECT '{a}' AS x, '{b}' AS y, 1.0::DOUBLE AS corr")
            else:
                parts.append(f"SELECT '{a}' AS x, '{b}' AS y, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM raw")
    return " UNION ALL ".join(parts)


oracle("corr_matrix", _corr_sql())


@query("hourly_median")
def q_hourly_median(spark, sf):
    return round_doubles(P.hourly_median(raw_frame(spark, sf)))


oracle("hourly_median", """SELECT trip_hour, round(median(actual_time), 6) AS median_actual_time FROM raw
  WHERE trip_hour IS NOT NULL GROUP BY trip_hour""")


@query("dow_median")
def q_dow_median(spark, sf):
    return round_doubles(P.dow_median(raw_frame(spark, sf)))


oracle("dow_median", """SELECT c.i AS day_index, c.d AS trip_day_name, round(m.v, 6) AS median_actual_time
  FROM (SELECT * FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'), (4, 'Friday'),
  (5, 'Saturday'), (6, 'Sunday')) t(i, d)) c
  LEFT JOIN (SELECT trip_day_name, median(actual_time) AS v FROM raw GROUP BY trip_day_name) m ON m.trip_day_name = c.d""")

_LANE_SQL = """SELECT route_lane, count(segment_actual_time) AS n_segments,
  round(median(segment_delay_ratio), 6) AS median_segment_delay, round(avg(segment_actual_time), 6) AS mean_segment_actual,
  round(avg(segment_osrm_time), 6) AS mean_segment_osrm FROM clean GROUP BY route_lane HAVING count(segment_actual_time) >= 50"""


@query("lane_stats")
def q_lane_stats(spark, sf):
    return round_doubles(P.lane_stats(clean_frame(spark, sf)))


oracle("lane_stats", _LANE_SQL)


@query("top_delayed_lanes")
def q_top_delayed_lanes(spark, sf):
    return round_doubles(P.top_delayed_lanes(clean_frame(spark, sf)))


oracle("top_delayed_lanes", """SELECT route_lane, count(segment_actual_time) AS n_segments,
  round(median(segment_delay_ratio), 6) AS median_segment_delay, round(avg(segment_actual_time), 6) AS mean_segment_actual,
  round(avg(segment_osrm_time), 6) AS mean_segment_osrm FROM clean GROUP BY route_lane
  HAVING count(segment_actual_time) >= 50 ORDER BY median(segment_delay_ratio) DESC, route_lane LIMIT 15""")


@query("hub_activity")
def q_hub_activity(spark, sf):
    return P.hub_activity(fixtures.segments(spark, sf))


oracle("hub_activity", """SELECT coalesce(s.hub, d.hub) AS hub, coalesce(s.n, 0) AS as_source,
  coalesce(d.n, 0) AS as_destination, coalesce(s.n, 0) + coalesce(d.n, 0) AS total_appearances
  FROM (SELECT source_center AS hub, count(*) AS n FROM segments WHERE source_center IS NOT NULL GROUP BY 1) s
  FULL OUTER JOIN (SELECT destination_center AS hub, count(*) AS n FROM segments GROUP BY 1) d ON s.hub = d.hub""")


@query("od_pairs")
def q_od_pairs(spark, sf):
    return P.od_pairs(fixtures.segments(spark, sf))


oracle("od_pairs", """SELECT source_center, destination_center, source_name, destination_name, count(*) AS segment_count
  FROM segments WHERE source_center IS NOT NULL GROUP BY ALL
  ORDER BY segment_count DESC, source_center, destination_center, source_name, destination_name LIMIT 15""")


@query("route_type_counts")
def q_route_type_counts(spark, sf):
    return round_doubles(P.route_type_counts(fixtures.segments(spark, sf)))


oracle("route_type_counts", """SELECT route_type, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share
  FROM segments GROUP BY route_type""")


@query("scatter_sample")
def q_scatter_sample(spark, sf):
    return P.scatter_sample(raw_frame(spark, sf), "osrm_time", "actual_time")


oracle("scatter_sample", """SELECT *, greatest(max(osrm_time) OVER (), max(actual_time) OVER ()) AS axis_limit FROM (
  SELECT segment_key, osrm_time, actual_time, route_type FROM raw ORDER BY md5(segment_key || '|42'), segment_key LIMIT 8000)
  WHERE osrm_time > 0 AND actual_time > 0""")


@query("safe_ratio")
def q_safe_ratio(spark, sf):
    """Zero denominators -> null; negative denominators still divide."""
    from hubflow.functions.exprs import safe_ratio
    seg = fixtures.segments(spark, sf)
    return round_doubles(seg.select("segment_key", safe_ratio(F.col("actual_time") - 100, F.col("segment_osrm_time") - 5)
                                    .alias("ratio")))


oracle("safe_ratio", """SELECT segment_key, round((actual_time - 100) / nullif(segment_osrm_time - 5, 0), 6) AS ratio
  FROM segments""")


@query("unknown_fill")
def q_unknown_fill(spark, sf):
    """Per-column constant fills (fillna) on the raw frame."""
    df = C.unknown_fill(raw_frame(spark, sf), {"delay_ratio": 1.0, "segment_delay_ratio": 0.0, "source_center": "UNKNOWN"})
    return round_doubles(df.select("segment_key", "delay_ratio", "segment_delay_ratio", "source_center"))


oracle("unknown_fill", """SELECT segment_key, round(coalesce(delay_ratio, 1.0), 6) AS delay_ratio,
  round(coalesce(segment_delay_ratio, 0.0), 6) AS segment_delay_ratio, coalesce(source_center, 'UNKNOWN') AS source_center
  FROM raw""")
