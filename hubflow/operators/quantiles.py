"""Exact grouped quantiles whose work is shared out by value, not by group.

A group may be the whole table, so no task may hold one.  Equal values are counted first; the counted values
are range-partitioned by (group, value), numbered by running sums inside each range, and shifted by the sums of the
group's earlier ranges (one row for each range and group it touches).  Only the values around a wanted rank remain,
and linear interpolation gives the answer that ``percentile`` gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hubflow.functions.exprs import finite_or_null
from hubflow.session import cut_lineage


def grouped_quantiles(df: DataFrame, keys: list[str], value: str, probabilities: list[float]) -> DataFrame:
    """keys, q: array with a double for each probability.  Null and non-finite values do not count; groups without
    values have no row.  Null keys form a group."""
    rows = df.select(*keys, finite_or_null(F.col(value).cast("double")).alias("_x")).filter("_x is not null")
    counted = rows.groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_n"))
    # the ranges are read twice below: written once; finding their bounds reads the counted values' shuffle, not the rows
    ranged = cut_lineage(counted.repartitionByRange(*keys, "_x").withColumn("_part", F.spark_partition_id()))
    sums = ranged.groupBy(*keys, "_part").agg(F.sum("_n").alias("_sum"))
    inside = Window.partitionBy(*keys, "_part").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    line = Window.partitionBy(*keys)
    before = line.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(*keys, "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_shift"),
                         F.sum("_sum").over(line).alias("_total"))
    same = F.col("a._part") == F.col("b._part")
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    numbered = ranged.withColumn("_end", F.sum("_n").over(inside)).alias("a").join(shifts.alias("b"), same).select(
        *[F.col(f"a.{k}").alias(k) for k in keys], "_x", "_total", (F.col("_end") + F.col("_shift")).alias("_end"),
        (F.col("_end") + F.col("_shift") - F.col("_n")).alias("_start"))
    aggs, near = [], F.lit(False)
    for i, p in enumerate(probabilities):
        at = (F.col("_total") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            covers = (F.col("_start") <= rank) & (rank < F.col("_end"))
            near = near | covers
            aggs.append(F.max(F.when(covers, F.col("_x"))).alias(f"_{side}{i}"))
    picked = numbered.filter(near).groupBy(*keys).agg(F.first("_total").alias("_total"), *aggs)
    share = lambda i, p: (F.col("_total") - 1) * F.lit(float(p)) - F.floor((F.col("_total") - 1) * F.lit(float(p)))
    q = [F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * share(i, p) for i, p in enumerate(probabilities)]
    return picked.select(*keys, F.array(*q).alias("q"))


def column_quantiles(df: DataFrame, columns: list[str], probabilities: list[float], keys: tuple = ()) -> DataFrame:
    """keys, column, q: the quantiles of several columns in one pass (an unpivot, not a job per column).

    A cell is a place and a double: no struct is built for it, and no name is hashed with it.
    """
    long = df.select(*keys, F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("_at", "_v"))
    found = grouped_quantiles(long, [*keys, "_at"], "_v", probabilities)
    return found.select(*keys, F.array(*map(F.lit, columns))[F.col("_at")].alias("column"), "q")


def wide_quantiles(df: DataFrame, columns: list[str], probabilities: list[float], keys: tuple = ()) -> DataFrame:
    """keys and, for each column c, an array ``q_c``; a column without values is null.  One row for each group."""
    found = column_quantiles(df, columns, probabilities, keys)
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("column") == c, F.col("q"))).alias(f"q_{c}") for c in columns])
