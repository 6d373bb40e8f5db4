"""Schemas and constants.

Fixed values: these must equal the reference application's settings for results to agree.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values (must match the reference behaviour) ----------------------------------
SEED = 42
TARGET = "actual_time"
TRIP_ID = "trip_uuid"
TEST_SHARE = 0.2
CLIP_QUANTILE = 0.99
GRAPH_COVERAGE_THRESHOLD = 0.80
RISK_BOTTLENECK_MEDIUM = 0.35
RISK_BOTTLENECK_HIGH = 0.55
RISK_BOTTLENECK_CRITICAL = 0.75
CONFIDENCE_Z = 1.28
DEFAULT_RESIDUAL_STD = 30.0
ETA_RATIO_STEP_1 = 1.4
ETA_RATIO_STEP_2 = 1.8
ETA_RATIO_INSIGHT = 1.5
LANE_SEPARATOR = " → "
RISK_LEVELS = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
RISK_INDEX_WEIGHTS = {"LOW": 0, "MEDIUM": 25, "HIGH": 60, "CRITICAL": 100}
RISK_INDEX_UNKNOWN_WEIGHT = 30
INSIGHT_BOTTLENECK = "Touches high-bottleneck hub; expect elevated dwell risk."
INSIGHT_ETA = "Predicted ETA materially above OSRM baseline."
INSIGHT_NORMAL = "Within normal network operating envelope."
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
DATETIME_COLS = ["trip_creation_time", "od_start_time", "od_end_time", "cutoff_timestamp"]
UNIVARIATE_COLS = ["actual_time", "osrm_time", "delay_ratio", "segment_delay_ratio"]
CORR_COLS = [
    "actual_time", "osrm_time", "delay_ratio",
    "segment_actual_time", "segment_osrm_time", "segment_delay_ratio",
    "actual_distance_to_destination", "osrm_distance",
    "segment_osrm_distance", "factor", "segment_factor",
    "trip_hour", "trip_dayofweek",
]
ROUTE_COMPARE_COLS = [
    "actual_time", "osrm_time", "delay_ratio",
    "segment_actual_time", "segment_osrm_time", "segment_delay_ratio",
]
PROCESSED_COLS = [
    "data", "trip_uuid", "route_schedule_uuid", "route_type",
    "source_center", "destination_center", "source_name", "destination_name",
    "trip_creation_time", "od_start_time", "od_end_time",
    "actual_time", "osrm_time", "segment_actual_time", "segment_osrm_time",
    "delay_ratio", "segment_delay_ratio", "route_lane",
    "actual_distance_to_destination", "osrm_distance", "segment_osrm_distance",
    "factor", "segment_factor", "is_cutoff",
]
BASE_FEATURES = [
    "osrm_time", "osrm_distance", "segment_osrm_time", "segment_osrm_distance",
    "trip_hour_sin", "trip_hour_cos", "is_weekend",
    "segment_time_share", "segment_distance_share", "segment_osrm_to_trip_osrm_time",
]
GRAPH_FEATURES = [
    "source_pagerank", "destination_pagerank", "source_degree", "destination_degree",
    "source_bottleneck_score", "destination_bottleneck_score",
    "source_community", "destination_community",
    "graph_pagerank_product", "graph_bottleneck_sum", "graph_pagerank_gap", "same_community",
]
MIN_LANE_ROWS = 50
# production bottleneck score weights (betweenness, traffic) and analyst weights (+ delay)
BOTTLENECK_PROD_WEIGHTS = (0.6, 0.4)
BOTTLENECK_ANALYST_WEIGHTS = (0.45, 0.35, 0.20)
PAGERANK_ALPHA = 0.85
PAGERANK_TOL = 1e-6
PAGERANK_MAX_ITER = 100
# names under which a fitted preprocessor is stored
ARTIFACT_KEYS = ["feature_columns", "fill_values", "clip_upper", "route_type_columns", "osrm_minutes_per_km", "residual_std",
                 "osrm_time_median"]
GBT_PARAMS = dict(maxIter=300, maxDepth=8, stepSize=0.05, subsamplingRate=0.8)
RAW_SEGMENT_SCHEMA = T.StructType([
    T.StructField("data", T.StringType()),
    T.StructField("trip_creation_time", T.StringType()),
    T.StructField("route_schedule_uuid", T.StringType()),
    T.StructField("route_type", T.StringType()),
    T.StructField("trip_uuid", T.StringType()),
    T.StructField("source_center", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("destination_center", T.StringType()),
    T.StructField("destination_name", T.StringType()),
    T.StructField("od_start_time", T.StringType()),
    T.StructField("od_end_time", T.StringType()),
    T.StructField("start_scan_to_end_scan", T.DoubleType()),
    T.StructField("is_cutoff", T.BooleanType()),
    T.StructField("cutoff_factor", T.IntegerType()),
    T.StructField("cutoff_timestamp", T.StringType()),
    T.StructField("actual_distance_to_destination", T.DoubleType()),
    T.StructField("actual_time", T.DoubleType()),
    T.StructField("osrm_time", T.DoubleType()),
    T.StructField("osrm_distance", T.DoubleType()),
    T.StructField("factor", T.DoubleType()),
    T.StructField("segment_actual_time", T.DoubleType()),
    T.StructField("segment_osrm_time", T.DoubleType()),
    T.StructField("segment_osrm_distance", T.DoubleType()),
    T.StructField("segment_factor", T.DoubleType()),
])

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("source_center", T.StringType()),
    T.StructField("destination_center", T.StringType()),
    T.StructField("osrm_distance", T.DoubleType()),
    T.StructField("trip_hour", T.IntegerType()),
    T.StructField("route_type", T.StringType()),
])

# ---- end of the fixed values ------------------------------------------------------------


def require_columns(df, columns) -> None:
    """Fail fast with the full list of missing columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"Missing required columns: {missing}")
