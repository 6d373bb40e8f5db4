"""Reusable column expressions.  All are JVM-side built-ins (no UDFs), so they stay inside
whole-stage codegen wherever they are used."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hubflow import schema as S


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num, den) -> Column:
    """``num / den`` with a zero (or null) denominator giving null (never an ANSI error).

    Negative denominators still divide, as in the reference.
    """
    return F.try_divide(col(num), F.nullif(col(den), F.lit(0)))


def finite_or_null(c) -> Column:
    """Fold NaN and +/-inf into null (Spark's aggregates do not skip NaN; pandas' do)."""
    c = col(c)
    return F.when(F.abs(c) < F.lit(float("inf")), c)  # NaN is above every number here


def route_lane(src="source_center", dst="destination_center") -> Column:
    return F.concat(col(src), F.lit(S.LANE_SEPARATOR), col(dst))


def weekday_monday0(ts) -> Column:
    """Monday = 0 ... Sunday = 6 (pandas ``dayofweek``); Spark's ``dayofweek`` is Sunday = 1."""
    return F.weekday(col(ts))


def day_name(ts) -> Column:
    return F.date_format(col(ts), "EEEE")


def hash_percent(key, seed: int = S.SEED) -> Column:
    """Stable 0..99 bucket of a key: first 32 bits of md5(key|seed).

    Engine-portable (DuckDB: ``cast('0x'||substr(md5(k||'|42'),1,8) as bigint) % 100``) and
    needs no shuffle, so a split is a pure per-row predicate.
    """
    h = F.conv(F.substring(F.md5(F.concat(col(key).cast("string"), F.lit(f"|{seed}"))), 1, 8), 16, 10)
    return (h.cast("bigint") % 100).cast("int")


def hash_order(key, seed: int = S.SEED) -> Column:
    """Deterministic pseudo-random order key used for seeded samples."""
    return F.md5(F.concat(col(key).cast("string"), F.lit(f"|{seed}")))


def bias_corrected_skew(c) -> Column:
    """Sample skewness (pandas ``skew``) from Spark's population ``skewness``."""
    n = F.count(col(c)).cast("double")
    return F.when(n > 2, F.skewness(col(c)) * F.sqrt(n * (n - 1)) / (n - 2))


def bottleneck_points(bn) -> Column:
    bn = col(bn)
    return (F.when(bn >= S.RISK_BOTTLENECK_CRITICAL, 3)
             .when(bn >= S.RISK_BOTTLENECK_HIGH, 2)
             .when(bn >= S.RISK_BOTTLENECK_MEDIUM, 1)
             .otherwise(0))


def ratio_points(ratio) -> Column:
    ratio = col(ratio)
    return (F.when(ratio >= S.ETA_RATIO_STEP_2, 2)
             .when(ratio >= S.ETA_RATIO_STEP_1, 1)
             .otherwise(0))


def risk_level(bn, ratio) -> Column:
    """Operational risk tier from the max hub bottleneck score and the ETA/OSRM ratio."""
    pts = bottleneck_points(bn) + ratio_points(ratio)
    return (F.when(pts >= 4, "CRITICAL")
             .when(pts >= 3, "HIGH")
             .when(pts >= 2, "MEDIUM")
             .otherwise("LOW"))


def route_insight(ratio, warning) -> Column:
    parts = F.concat_ws(" ",
                        F.when(col(warning), F.lit(S.INSIGHT_BOTTLENECK)),
                        F.when(col(ratio) >= S.ETA_RATIO_INSIGHT, F.lit(S.INSIGHT_ETA)))
    return F.when(parts == "", F.lit(S.INSIGHT_NORMAL)).otherwise(parts)
