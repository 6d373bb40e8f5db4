"""Exploratory aggregates over segment tables (univariate stats, distributions, lanes, OD pairs).

Patterns used throughout: all statistics of a frame in ONE aggregate (structs per column, then
explode/unpivot), 1-row threshold tables joined back by broadcast (size-bounded by construction),
and top-k through ``orderBy(...).limit(k)`` which plans as TakeOrderedAndProject (per-partition
heaps, no global sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubflow import schema as S
from hubflow.functions.exprs import bias_corrected_skew, finite_or_null, hash_order
from hubflow.operators.quantiles import grouped_quantiles, wide_quantiles


def _r(c, decimals):
    return F.round(c, decimals) if decimals is not None else c


def iqr_bounds(df: DataFrame, column: str) -> DataFrame:
    """Q1 - 1.5 IQR and Q3 + 1.5 IQR of a column (one row)."""
    return wide_quantiles(df, [column], [0.25, 0.75]).select(F.col(f"q_{column}").alias("q")).select(
        F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"),
        (F.col("q")[0] - 1.5 * (F.col("q")[1] - F.col("q")[0])).alias("iqr_low"),
        (F.col("q")[1] + 1.5 * (F.col("q")[1] - F.col("q")[0])).alias("iqr_high"))


def univariate_summary(df: DataFrame, columns=S.UNIVARIATE_COLS, decimals=None) -> DataFrame:
    """count, mean, median, std, skew, IQR bounds, outlier count and % of all rows, per column.

    Pass 1: one aggregate of every moment, and the quartiles of all columns; pass 2: outlier counts
    against the 1-row bounds (broadcast).  Output is long: one row per variable.
    """
    stats = []
    for i, c in enumerate(columns):
        x = finite_or_null(F.col(c))
        q = F.first(f"q_{c}")
        stats.append(F.struct(
            F.count(x).alias("count"), F.avg(x).alias("mean"), q[1].alias("median"),
            F.stddev_samp(x).alias("std"), bias_corrected_skew(x).alias("skewness"),
            (q[0] - 1.5 * (q[2] - q[0])).alias("iqr_low"), (q[2] + 1.5 * (q[2] - q[0])).alias("iqr_high"),
        ).alias(f"s{i}"))
    quartiles = wide_quantiles(df, list(columns), [0.25, 0.5, 0.75])
    bounds = df.select(*columns).crossJoin(F.broadcast(quartiles)).agg(*stats, F.count(F.lit(1)).alias("_n"))
    joined = df.select(*columns).crossJoin(F.broadcast(bounds))
    outl = [F.count_if((F.col(c) < F.col(f"s{i}.iqr_low")) | (F.col(c) > F.col(f"s{i}.iqr_high"))).alias(f"o{i}")
            for i, c in enumerate(columns)]
    counts = joined.agg(*outl)
    wide = bounds.crossJoin(counts)
    rows = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"s{i}").alias("s"), F.col(f"o{i}").alias("o"))
                     for i, c in enumerate(columns)])
    return wide.select(F.explode(rows).alias("r"), "_n").select(
        F.col("r.variable").alias("variable"),
        F.col("r.s.count").cast("bigint").alias("count"),
        _r(F.col("r.s.mean"), decimals).alias("mean"),
        _r(F.col("r.s.median"), decimals).alias("median"),
        _r(F.col("r.s.std"), decimals).alias("std"),
        _r(F.col("r.s.skewness"), decimals).alias("skewness"),
        _r(F.col("r.s.iqr_low"), decimals).alias("iqr_low"),
        _r(F.col("r.s.iqr_high"), decimals).alias("iqr_high"),
        F.col("r.o").cast("bigint").alias("outlier_count"),
        _r(F.col("r.o") / F.col("_n") * 100, 2 if decimals is None else decimals).alias("outlier_pct"))


def capped_distribution(df: DataFrame, column: str, bins: int = 40, cap_quantile: float = 0.99) -> DataFrame:
    """Equal-width histogram of a column clipped at its p99 (numpy ``histogram`` bins: the last
    bin is closed).  Output: bin (1..bins), bin_low, bin_high, count; empty bins omitted."""
    x = finite_or_null(F.col(column))
    base = df.select(x.alias("x")).filter(F.col("x").isNotNull())
    cap = wide_quantiles(base, ["x"], [cap_quantile]).select(F.col("q_x")[0].alias("cap"))
    capped = base.crossJoin(F.broadcast(cap)).select(F.least("x", "cap").alias("x"))
    rng = capped.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    return histogram(capped, "x", bins, rng)


def histogram(df: DataFrame, column: str, bins: int, rng: DataFrame | None = None) -> DataFrame:
    """Equal-width bins between min and max (1-row range table broadcast), count per bin."""
    if rng is None:
        rng = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    w = F.col("hi") - F.col("lo")
    b = F.when(w == 0, F.lit(1)).otherwise(
        F.least(F.floor((F.col(column) - F.col("lo")) / w * bins) + 1, F.lit(bins)))
    binned = (df.select(column).filter(F.col(column).isNotNull())
                .crossJoin(F.broadcast(rng)).select(b.cast("int").alias("bin"), "lo", "hi"))
    return binned.groupBy("bin", "lo", "hi").agg(F.count(F.lit(1)).alias("count")).select(
        "bin",
        (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("bin") - 1) / bins).alias("bin_low"),
        (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("bin") / bins).alias("bin_high"),
        F.col("count").cast("bigint").alias("count"))


def box_stats(df: DataFrame, column: str, by: str | None = None) -> DataFrame:
    """Five-number summary (min, q1, median, q3, max), optionally per group."""
    q = grouped_quantiles(df, [by] if by else [], column, [0.0, 0.25, 0.5, 0.75, 1.0])
    names = ("min", "q1", "median", "q3", "max")
    five = q.select(*([by] if by else []), *[F.col("q")[i].alias(n) for i, n in enumerate(names)])
    if by:  # groups without values keep a row
        return df.select(by).distinct().alias("g").join(five.alias("v"), F.col(f"g.{by}").eqNullSafe(F.col(f"v.{by}")), "left").select(
            F.col(f"g.{by}").alias(by), *names)
    return five if not five.isEmpty() else df.sparkSession.range(1).select(*[F.lit(None).cast("double").alias(n) for n in names])


def route_compare(df: DataFrame, columns=S.ROUTE_COMPARE_COLS, by: str = "route_type", decimals=2) -> DataFrame:
    """Per route type and measure: count, mean, median, std."""
    known = df.filter(F.col(by).isNotNull())
    aggs = []
    for c in columns:
        x = finite_or_null(F.col(c))
        aggs += [F.count(x).alias(f"{c}_count"), _r(F.avg(x), decimals).alias(f"{c}_mean"),
                 _r(F.stddev_samp(x), decimals).alias(f"{c}_std")]
    medians = wide_quantiles(known, list(columns), [0.5], (by,)).select(
        by, *[_r(F.col(f"q_{c}")[0], decimals).alias(f"{c}_median") for c in columns])
    return known.groupBy(by).agg(*aggs).join(medians, by, "left")


def route_box_stats(df: DataFrame, by: str = "route_type") -> DataFrame:
    """Box stats of actual_time and of the p99-capped delay_ratio per route type (long form)."""
    cap = wide_quantiles(df, ["delay_ratio"], [0.99]).select(F.col("q_delay_ratio")[0].alias("cap"))
    capped = df.crossJoin(F.broadcast(cap)).withColumn("delay_ratio_capped", F.least("delay_ratio", "cap"))
    a = box_stats(capped.filter(F.col(by).isNotNull()), "actual_time", by).withColumn("measure", F.lit("actual_time"))
    d = box_stats(capped.filter(F.col(by).isNotNull()), "delay_ratio_capped", by).withColumn("measure", F.lit("delay_ratio_capped"))
    return a.unionByName(d)


def corr_matrix(df: DataFrame, columns=S.CORR_COLS) -> DataFrame:
    """Pairwise-complete Pearson correlation of every column pair, long form (x, y, corr).

    The frame is unpivoted to (pair, x, y) and ONE narrow ``groupBy(pair).agg(corr)`` runs: a
    small schema stays inside whole-stage codegen (one wide aggregate of n(n-1)/2 ``corr``
    buffers exceeds the codegen field limit and runs interpreted), and the partial aggregate
    reduces every partition to one row per pair before the shuffle.  Spark's ``corr`` skips
    rows where either side is null.
    """
    cols = list(columns)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    vals = {c: finite_or_null(F.col(c).cast("double")) for c in cols}
    cells = F.array(*[F.struct(F.lit(k).alias("p"), vals[cols[i]].alias("a"), vals[cols[j]].alias("b"))
                      for k, (i, j) in enumerate(pairs)])
    long = df.select(F.explode(cells).alias("c")).select("c.*")
    g = long.groupBy("p").agg(F.corr("a", "b").alias("corr"))
    names = df.sparkSession.createDataFrame(
        [(k, cols[i], cols[j]) for k, (i, j) in enumerate(pairs)], "p int, x string, y string")
    half = g.join(F.broadcast(names), "p").select("x", "y", "corr")
    diag = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "x string, y string, corr double")
    return half.unionByName(half.select(F.col("y").alias("x"), F.col("x").alias("y"), "corr")).unionByName(diag)


def _medians(df: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """by, name: the median of ``value``; groups without values keep a row with null."""
    q = grouped_quantiles(df, [by], value, [0.5]).select(by, F.col("q")[0].alias(name))
    return df.select(by).distinct().join(q, by, "left")


def hourly_median(df: DataFrame, value: str = "actual_time") -> DataFrame:
    return _medians(df.filter(F.col("trip_hour").isNotNull()), "trip_hour", value, f"median_{value}")


def dow_median(df: DataFrame, value: str = "actual_time") -> DataFrame:
    """Median per weekday, Monday first; days without rows are kept with a null median."""
    spark = df.sparkSession
    cal = spark.createDataFrame([(i, d) for i, d in enumerate(S.DAY_NAMES)], "day_index int, trip_day_name string")
    med = _medians(df.filter(F.col("trip_day_name").isNotNull()), "trip_day_name", value, f"median_{value}")
    return cal.join(med, "trip_day_name", "left").select("day_index", "trip_day_name", f"median_{value}")


def lane_stats(df: DataFrame, min_rows: int = S.MIN_LANE_ROWS) -> DataFrame:
    """Per lane: n_segments, median segment delay ratio, mean segment actual / OSRM times;
    lanes with fewer than ``min_rows`` segments are dropped (HAVING)."""
    known = df.filter(F.col("route_lane").isNotNull())
    g = (known.groupBy("route_lane")
         .agg(F.count("segment_actual_time").alias("n_segments"), F.avg("segment_actual_time").alias("mean_segment_actual"),
              F.avg("segment_osrm_time").alias("mean_segment_osrm")).filter(F.col("n_segments") >= min_rows))
    medians = grouped_quantiles(known, ["route_lane"], "segment_delay_ratio", [0.5]).select(
        "route_lane", F.col("q")[0].alias("median_segment_delay"))
    return g.join(medians, "route_lane", "left").select("route_lane", "n_segments", "median_segment_delay", "mean_segment_actual",
                                                        "mean_segment_osrm")


def top_delayed_lanes(df: DataFrame, k: int = 15, min_rows: int = S.MIN_LANE_ROWS) -> DataFrame:
    """The ``k`` lanes with the highest median segment delay ratio (lane name breaks ties)."""
    return (lane_stats(df, min_rows)
            .orderBy(F.col("median_segment_delay").desc_nulls_last(), F.col("route_lane"))
            .limit(k))


def hub_activity(df: DataFrame) -> DataFrame:
    """Appearances of each hub as source and as destination (0 when absent), and their total."""
    src = df.filter(F.col("source_center").isNotNull()).groupBy(F.col("source_center").alias("hub")).agg(
        F.count(F.lit(1)).alias("as_source"))
    dst = df.filter(F.col("destination_center").isNotNull()).groupBy(F.col("destination_center").alias("hub")).agg(
        F.count(F.lit(1)).alias("as_destination"))
    j = src.join(dst, "hub", "full_outer")
    return j.select("hub", F.coalesce("as_source", F.lit(0)).cast("bigint").alias("as_source"),
                    F.coalesce("as_destination", F.lit(0)).cast("bigint").alias("as_destination"),
                    (F.coalesce("as_source", F.lit(0)) + F.coalesce("as_destination", F.lit(0))).cast("bigint")
                    .alias("total_appearances"))


def od_pairs(df: DataFrame, k: int | None = 15) -> DataFrame:
    keys = ["source_center", "destination_center", "source_name", "destination_name"]
    g = (df.na.drop(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("segment_count"))
           .orderBy(F.col("segment_count").desc(), *keys))
    return g.limit(k) if k else g


def route_type_counts(df: DataFrame, by: str = "route_type") -> DataFrame:
    """Value counts with share of the non-null total (window over a handful of rows)."""
    g = df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("count"))
    tot = g.agg(F.sum("count").alias("_t"))
    return g.crossJoin(F.broadcast(tot)).select(by, "count", (F.col("count") / F.col("_t")).alias("share"))


def scatter_sample(df: DataFrame, x: str, y: str, key: str = "segment_key", n: int = 8000,
                   hue: str | None = "route_type") -> DataFrame:
    """Seeded sample of at most ``n`` rows (md5-ordered, deterministic and engine-portable), kept
    where both values are positive, with the common axis limit max(max x, max y)."""
    cols = [key, x, y] + ([hue] if hue else [])
    smp = df.select(*cols).orderBy(hash_order(key), key).limit(n)
    valid = smp.filter((F.col(x) > 0) & (F.col(y) > 0))
    lim = valid.agg(F.greatest(F.max(x), F.max(y)).alias("axis_limit"))
    return valid.crossJoin(F.broadcast(lim))
