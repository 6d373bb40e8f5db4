"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hubflow.operators.clean import add_delay_ratios, add_route_lane, add_trip_time_parts, clean_segments
from hubflow.session import written
from hubflow.sources import fixtures

QUERIES: dict = {}


def query(key: str):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``."""
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


def round_doubles(df: DataFrame, decimals: int = 6) -> DataFrame:
    """Round every double column (engines sum floats in different orders).

    The decimal arithmetic of ``round`` costs more than the rest of a wide row, so it is left to values near a tie, large or not
    finite.  Elsewhere the nearest multiple is a whole number divided by a power of ten: both are exact, so the quotient is the
    double that ``round`` returns.  Adding 0.0 makes -0.0 a plain zero, as ``round`` does."""
    def rounded(x, kind):
        if kind == "float":
            return F.when(F.rint(x) == x, x + F.lit(0.0)).otherwise(F.round(x, decimals))
        scaled = x * F.lit(10.0 ** decimals)
        whole = F.rint(scaled)
        plain = (F.abs(scaled) < F.lit(1e12)) & (F.abs(scaled - whole) < F.lit(0.499))
        return F.when(plain, whole / F.lit(10.0 ** decimals) + F.lit(0.0)).otherwise(F.round(x, decimals))

    return df.select(*[rounded(F.col(c), t).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])


def raw_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw segments with the EDA derivations (ratios, lane, calendar parts)."""
    seg = fixtures.segments(spark, sf_dir)
    return add_trip_time_parts(add_route_lane(add_delay_ratios(seg)))


def clean_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_segments(fixtures.segments(spark, sf_dir), keep_extra=["segment_key"])


#: What the lanes and hubs of segments are made of.
LANE_COLUMNS = ["source_center", "destination_center", "route_lane", "route_type", "source_name", "destination_name",
                "segment_delay_ratio", "segment_actual_time", "segment_osrm_time"]


def lane_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean segments' lane columns, written: for jobs that read the segments several times."""
    return written(clean_frame(spark, sf_dir).select(*LANE_COLUMNS))
