"""Model and network monitoring jobs (drift, degradation, staleness, retraining window, logging)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hubflow.functions.exprs import finite_or_null
from hubflow.operators.quantiles import wide_quantiles

PSI_FLOOR = 1e-4


def data_drift(baseline: DataFrame, current: DataFrame, features: list[str], bins: int = 10,
               threshold: float = 0.2) -> DataFrame:
    """Population stability index per feature.

    Baseline quantile edges for every feature come from ONE aggregate; both frames are bucketed
    against the broadcast 1-row edge table, unpivoted to (feature, bucket) and counted with a
    single grouped aggregate each.  PSI = sum (cur - base) * ln(cur / base), proportions floored.
    """
    qs = [i / bins for i in range(1, bins)]
    edges = wide_quantiles(baseline, list(features), qs).select(*[F.col(f"q_{f}").alias(f"e{i}") for i, f in enumerate(features)])

    def above(c):
        return lambda acc, e: acc + (F.col(c) > e).cast("int")

    def bucketed(df, side):
        j = df.select(*[finite_or_null(F.col(f).cast("double")).alias(f) for f in features]).crossJoin(F.broadcast(edges))
        # bucket = number of baseline edges below the value (0 .. bins-1)
        cells = F.array(*[F.struct(F.lit(f).alias("feature"),
                                   F.aggregate(F.col(f"e{i}"), F.lit(0), above(f)).alias("bucket"),
                                   F.col(f).isNotNull().alias("present"))
                          for i, f in enumerate(features)])
        long = j.select(F.explode(cells).alias("c")).select("c.*").filter("present")
        g = long.groupBy("feature", "bucket").agg(F.count(F.lit(1)).alias("n"))
        tot = g.groupBy("feature").agg(F.sum("n").alias("t"))
        return g.join(tot, "feature").select("feature", "bucket", (F.col("n") / F.col("t")).alias(side))

    spark = baseline.sparkSession
    grid = (spark.createDataFrame([(f,) for f in features], "feature string")
                 .crossJoin(spark.range(bins).select(F.col("id").cast("int").alias("bucket"))))
    p = (grid.join(bucketed(baseline, "base"), ["feature", "bucket"], "left")
             .join(bucketed(current, "cur"), ["feature", "bucket"], "left")
             .select("feature", "bucket", F.greatest(F.coalesce("base", F.lit(0.0)), F.lit(PSI_FLOOR)).alias("b"),
                     F.greatest(F.coalesce("cur", F.lit(0.0)), F.lit(PSI_FLOOR)).alias("c")))
    psi = p.groupBy("feature").agg(F.sum((F.col("c") - F.col("b")) * F.log(F.col("c") / F.col("b"))).alias("psi"))
    return psi.withColumn("drift", F.col("psi") > threshold)


def concept_drift(scored: DataFrame, ts: str = "trip_creation_time", actual: str = "actual_time",
                  pred: str = "predicted_eta", rise: float = 0.15) -> DataFrame:
    """Weekly MAE with week-over-week change; flag when MAE rose by more than ``rise``.
    The window runs over the weekly table (one row per week), not over trips."""
    wk = (scored.filter(F.col(actual).isNotNull())
                .groupBy(F.date_trunc("week", F.col(ts)).alias("week"))
                .agg(F.avg(F.abs(F.col(actual) - F.col(pred))).alias("mae"), F.count(F.lit(1)).alias("trips")))
    w = Window.orderBy("week")
    prev = F.lag("mae").over(w)
    return wk.select("week", "mae", "trips", prev.alias("prev_mae"),
                     F.coalesce(F.col("mae") > prev * (1 + rise), F.lit(False)).alias("concept_drift"))


def sla_degradation(scored: DataFrame, ts: str = "trip_creation_time", limit: float = 0.25) -> DataFrame:
    """Daily share of HIGH + CRITICAL trips; flag days above ``limit``."""
    d = (scored.groupBy(F.to_date(F.col(ts)).alias("day"))
               .agg(F.avg(F.col("risk_level").isin("HIGH", "CRITICAL").cast("double")).alias("high_risk_share"),
                    F.count(F.lit(1)).alias("trips")))
    return d.withColumn("sla_alert", F.col("high_risk_share") > limit)


def graph_staleness(built_at: datetime, now: datetime | None = None, max_age_days: float = 7.0) -> dict:
    age = ((now or datetime.now(timezone.utc)) - built_at).total_seconds() / 86400
    return {"age_days": age, "stale": age > max_age_days}


def retrain_window(df: DataFrame, ts: str = "trip_creation_time", days: int = 90) -> DataFrame:
    """Rows in the trailing ``days`` before the newest timestamp (1-row max broadcast)."""
    mx = df.agg(F.max(ts).alias("_mx"))
    return (df.crossJoin(F.broadcast(mx))
              .filter(F.col(ts) > F.col("_mx") - F.expr(f"INTERVAL {int(days)} DAYS")).drop("_mx"))


# ---- rolling lane network: a day is added, a day is dropped ---------------------------------------

LANE = ["source_center", "destination_center"]
_SUMMED = {"delay": "segment_delay_ratio", "actual": "segment_actual_time", "osrm": "segment_osrm_time"}


def lane_day_partials(df: DataFrame, ts: str = "trip_creation_time") -> DataFrame:
    """One row per lane and day: segments, and for each mean its sum and count; a table that days are appended to.

    Rows without a hub or a time belong to no lane or day and are left out.
    """
    rows = df.filter(F.col(LANE[0]).isNotNull() & F.col(LANE[1]).isNotNull() & F.col(ts).isNotNull()).withColumn("day", F.to_date(ts))
    sums = [x for name, c in _SUMMED.items() for x in (F.coalesce(F.sum(c), F.lit(0.0)).alias(f"{name}_sum"), F.count(c).alias(f"{name}_n"))]
    return rows.groupBy(*LANE, "day").agg(F.count(F.lit(1)).alias("weight"), *sums)


def _numbers(partials: DataFrame) -> list[str]:
    return [c for c in partials.columns if c not in (*LANE, "day")]


def window_sums(partials: DataFrame, last_day, days: int = 90) -> DataFrame:
    """Lanes of the ``days`` days up to and with ``last_day``, summed from the day partials."""
    inside = (F.col("day") <= F.lit(last_day)) & (F.col("day") > F.date_sub(F.lit(last_day), days))
    return partials.filter(inside).groupBy(*LANE).agg(*[F.sum(c).alias(c) for c in _numbers(partials)])


def roll_window(window: DataFrame, partials: DataFrame, from_day, to_day, days: int = 90) -> DataFrame:
    """The window that ends at ``from_day`` moved on to ``to_day``: the days between are added, as many at its start are
    subtracted, so only those days' partials are read.  A lane whose last segment left the window goes."""
    names = _numbers(partials)
    day, old, new = F.col("day"), F.lit(from_day), F.lit(to_day)
    came = (day > old) & (day <= new) & (day > F.date_sub(new, days))
    went = (day > F.date_sub(old, days)) & (day <= F.date_sub(new, days)) & (day <= old)
    change = partials.filter(came | went).select(*LANE, *[F.when(came, F.col(c)).otherwise(-F.col(c)).alias(c) for c in names])
    moved = window.select(*LANE, *names).unionByName(change).groupBy(*LANE).agg(*[F.sum(c).alias(c) for c in names])
    return moved.filter("weight > 0")


def window_lanes(window: DataFrame) -> DataFrame:
    """(u, v, weight, avg_delay, avg_actual_time, avg_osrm_time) of summed lanes, as the full aggregation gives them."""
    mean = lambda name: F.when(F.col(f"{name}_n") > 0, F.col(f"{name}_sum") / F.col(f"{name}_n"))
    return window.select(F.col(LANE[0]).alias("u"), F.col(LANE[1]).alias("v"), "weight", mean("delay").alias("avg_delay"),
                         mean("actual").alias("avg_actual_time"), mean("osrm").alias("avg_osrm_time"))


def inference_log(scored: DataFrame, model_version: str, graph_built_at: str,
                  inputs=("source_center", "destination_center", "osrm_distance", "trip_hour", "route_type")) -> DataFrame:
    """Audit rows: inputs, prediction, risk, model version and graph snapshot date."""
    cols = [F.col(c) for c in inputs if c in scored.columns]
    return scored.select(*cols, "predicted_eta", "risk_level", "bottleneck_warning",
                         F.lit(model_version).alias("model_version"), F.lit(graph_built_at).alias("graph_built_at"),
                         F.current_timestamp().alias("logged_at"))


def append_inference_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").parquet(path)
