"""Cleaning, derivations and data-quality reports (projections / filters / one-pass aggregates)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubflow import schema as S
from hubflow.functions.exprs import day_name, finite_or_null, route_lane, safe_ratio, weekday_monday0
from hubflow.operators.quantiles import wide_quantiles


def coerce_datetime(df: DataFrame, columns=S.DATETIME_COLS) -> DataFrame:
    """Parse text timestamps of the listed columns (if present); unparseable text becomes null."""
    types = dict(df.dtypes)
    repl = {c: F.try_to_timestamp(F.col(c)) for c in columns
            if c in df.columns and types[c] == "string"}
    return df.withColumns(repl) if repl else df


def parsed_rate(df: DataFrame, columns=S.DATETIME_COLS) -> DataFrame:
    """Percent of rows whose listed datetimes are all non-null (one row)."""
    present = [c for c in columns if c in df.columns]
    ok = F.lit(True)
    for c in present:
        ok = ok & F.col(c).isNotNull()
    return df.agg((F.avg(ok.cast("double")) * 100).alias("parsed_pct"))


def add_delay_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "delay_ratio": safe_ratio("actual_time", "osrm_time"),
        "segment_delay_ratio": safe_ratio("segment_actual_time", "segment_osrm_time"),
    })


def add_route_lane(df: DataFrame) -> DataFrame:
    return df.withColumn("route_lane", route_lane())


def add_trip_time_parts(df: DataFrame, ts: str = "trip_creation_time") -> DataFrame:
    return df.withColumns({
        "trip_hour": F.hour(ts).cast("int"),
        "trip_dayofweek": weekday_monday0(ts).cast("int"),
        "trip_day_name": day_name(ts),
    })


def add_temporal_parts(df: DataFrame, ts: str, prefix: str) -> DataFrame:
    """Generic ``{prefix}_hour``, ``_dow`` (Monday = 0) and ``_is_weekend`` from a timestamp."""
    return df.withColumns({
        f"{prefix}_hour": F.hour(ts).cast("int"),
        f"{prefix}_dow": weekday_monday0(ts).cast("int"),
        f"{prefix}_is_weekend": (weekday_monday0(ts) >= 5).cast("int"),
    })


def valid_segment() -> F.Column:
    """Rows usable for analytics/modelling.  Null comparisons evaluate to null => row dropped."""
    return ((F.col("segment_actual_time") >= 0) & (F.col("actual_time") >= 0)
            & (F.col("segment_osrm_time") > 0) & (F.col("osrm_time") > 0)
            & F.col("source_center").isNotNull() & F.col("destination_center").isNotNull())


def clean_segments(df: DataFrame, keep_extra=()) -> DataFrame:
    """Raw segments -> processed table: parse, derive ratios + lane, filter, project.

    One Filter + Project, fused into the scan's whole-stage codegen; the predicates on raw
    columns are pushed into the Parquet reader.
    """
    df = coerce_datetime(df)
    df = add_route_lane(add_delay_ratios(df))
    df = df.filter(valid_segment())
    keep = [c for c in S.PROCESSED_COLS if c in df.columns]
    keep += [c for c in keep_extra if c in df.columns and c not in keep]
    return df.select(*keep)


def drop_missing_targets(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    return df.na.drop(subset=[target])


def quality_flags(df: DataFrame) -> DataFrame:
    """Six row-level issue flags plus ``flag_any_issue``.

    The two p99 thresholds come from one aggregate row joined back by broadcast (one row,
    size-bounded), so the table is scanned twice but never shuffled.
    """
    if "delay_ratio" not in df.columns:
        df = add_delay_ratios(df)
    p99 = wide_quantiles(df, ["delay_ratio", "segment_delay_ratio"], [0.99]).select(
        F.col("q_delay_ratio")[0].alias("_p99_trip"), F.col("q_segment_delay_ratio")[0].alias("_p99_seg"))
    flags = {
        "flag_negative_actual": F.col("actual_time") < 0,
        "flag_negative_segment": F.col("segment_actual_time") < 0,
        "flag_zero_osrm": F.col("osrm_time") == 0,
        "flag_zero_segment_osrm": F.col("segment_osrm_time") == 0,
        "flag_extreme_delay": F.col("delay_ratio") > F.col("_p99_trip"),
        "flag_extreme_segment_delay": F.col("segment_delay_ratio") > F.col("_p99_seg"),
    }
    # pandas compares NaN as False: a null comparison must read False, not null
    out = df.crossJoin(F.broadcast(p99)).withColumns(
        {k: F.coalesce(v, F.lit(False)) for k, v in flags.items()})
    anyf = F.lit(False)
    for k in flags:
        anyf = anyf | F.col(k)
    return out.withColumn("flag_any_issue", anyf).drop("_p99_trip", "_p99_seg")


QUALITY_ISSUES = [
    ("negative_actual", "flag_negative_actual"),
    ("negative_segment_actual", "flag_negative_segment"),
    ("zero_osrm", "flag_zero_osrm"),
    ("zero_segment_osrm", "flag_zero_segment_osrm"),
    ("extreme_delay_ratio", "flag_extreme_delay"),
    ("extreme_segment_delay_ratio", "flag_extreme_segment_delay"),
    ("any_issue", "flag_any_issue"),
]


def quality_report(df: DataFrame) -> DataFrame:
    """One row per issue: count and percent of rows (single aggregate, then unpivot)."""
    flagged = quality_flags(df)
    aggs = [F.count_if(F.col(f)).alias(i) for i, f in QUALITY_ISSUES] + [F.count(F.lit(1)).alias("_n")]
    wide = flagged.agg(*aggs)
    long = wide.unpivot(["_n"], [i for i, _ in QUALITY_ISSUES], "issue", "count")
    return long.select(
        "issue", F.col("count").cast("bigint").alias("count"),
        F.round(F.col("count") / F.col("_n") * 100, 6).alias("pct_of_rows"))


def missing_summary(df: DataFrame) -> DataFrame:
    """Per column: null count and percent (one pass over the data, then unpivot)."""
    cols = df.columns
    aggs = [F.count_if(F.col(c).isNull()).alias(c) for c in cols] + [F.count(F.lit(1)).alias("__n")]
    wide = df.agg(*aggs)
    long = wide.unpivot(["__n"], cols, "column", "missing_count")
    return long.select("column", F.col("missing_count").cast("bigint").alias("missing_count"),
                       F.round(F.col("missing_count") / F.col("__n") * 100, 6).alias("missing_pct"))


def table_profile(df: DataFrame, columns=None) -> DataFrame:
    """``describe(include='all')``-style profile: count, unique, top, freq, mean, std, min,
    quartiles, max per column.

    Two jobs regardless of the column count: one global aggregate for the moments (a struct per
    column, exploded to rows) and one (column, value) count for unique/top/freq -- instead of
    ``count_distinct`` per column, which Spark would expand into one copy of the data per column.
    """
    cols = columns or df.columns
    types = dict(df.dtypes)
    numeric = {c for c in cols if types[c] in ("double", "float", "int", "bigint", "smallint", "tinyint")
               or types[c].startswith("decimal")}
    stats = []
    for i, c in enumerate(cols):
        x = F.col(c)
        fields = [F.count(x).cast("bigint").alias("count")]
        if c in numeric:
            xd = finite_or_null(x.cast("double"))
            q = F.first(f"q_{c}")
            fields += [F.avg(xd).alias("mean"), F.stddev_samp(xd).alias("std"), F.min(xd).alias("min"),
                       q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"), F.max(xd).alias("max")]
        else:
            fields += [F.lit(None).cast("double").alias(k) for k in ("mean", "std", "min", "p25", "p50", "p75", "max")]
        stats.append(F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), *fields).alias(f"s{i}"))
    quartiles = wide_quantiles(df, sorted(numeric), [0.25, 0.5, 0.75])
    wide = df.select(*cols).crossJoin(F.broadcast(quartiles)).agg(*stats) if numeric else df.agg(*stats)
    moments = wide.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s")).select("s.*")
    return moments.join(top_values(df, cols), "column", "left")


def top_values(df: DataFrame, columns=None) -> DataFrame:
    """Most frequent value (smallest on ties) and its frequency per column: one shuffle for all
    columns (unpivot to (column, value) then count), not one job per column."""
    cols = columns or df.columns
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("kv")
    ).select("kv.*").filter(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("freq"))
    # highest frequency, smallest value on ties: one min_by over an ordered struct key
    best = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("unique"),
        F.min_by(F.struct("value", "freq"), F.struct(F.negative("freq"), F.col("value"))).alias("b"))
    return best.select("column", F.col("unique").cast("bigint").alias("unique"),
                       F.col("b.value").alias("top"), F.col("b.freq").cast("bigint").alias("freq"))


def pandas_round(c, decimals: int) -> F.Column:
    """Round like pandas/numpy: half-to-even on ``x * 10**d`` (``rint``), not Spark's HALF_UP."""
    f = 10.0 ** decimals
    return F.rint(F.col(c) * f) / f if isinstance(c, str) else F.rint(c * f) / f


def prepare_display(df: DataFrame) -> DataFrame:
    """Round numeric columns by name: *eta*/*time* -> 1 dp, else *score*/*ratio* -> 3 dp."""
    numeric = {c for c, t in df.dtypes if t in ("double", "float", "int", "bigint") or t.startswith("decimal")}
    out = []
    for c in df.columns:
        lc = c.lower()
        if c in numeric and ("eta" in lc or "time" in lc):
            out.append(pandas_round(c, 1).alias(c))
        elif c in numeric and ("score" in lc or "ratio" in lc):
            out.append(pandas_round(c, 3).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def unknown_fill(df: DataFrame, values: dict) -> DataFrame:
    """Null fills (``fillna`` with a per-column constant)."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})

