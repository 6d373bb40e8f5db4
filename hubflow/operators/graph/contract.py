"""Connected components by alternating large-star / small-star contraction.

Each round is a grouped minimum plus one equi-join, both over the surviving edges only; the number
of rounds grows with the logarithm of the component size, not with the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubflow.session import NoConvergence, written


def rekeyed(df: DataFrame, column: str):
    """The same values under an expression that the planner does not take for the column.

    A table that was just grouped by a column is already dealt by it, and a join on that column would reuse this:
    then only one side is a shuffle of the join's own, and AQE does not split a hot key.  Joined on this
    expression both sides are.
    """
    return F.concat(column, F.lit("")) if dict(df.dtypes)[column] == "string" else F.bitwise_not(F.bitwise_not(column))


def _hang_on_minimum(pairs: DataFrame) -> DataFrame:
    """(u, v) neighbour rows -> (v, m): every neighbour and u itself hang on the smallest of them.

    The minima are keyed by a re-cast column, so both join inputs are plain exchanges and AQE may
    split a hub's rows over several tasks.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("mv"))
    least = least.select(rekeyed(least, "u").alias("mu"), F.least("u", "mv").alias("m"))
    return pairs.join(least, F.col("u") == F.col("mu")).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_hang_on_minimum(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    hung = _hang_on_minimum(down)
    return (hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(hung.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct())


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))),
                    F.sum(F.pmod(F.xxhash64("v", "u"), F.lit((1 << 40) - 87)))).first()
    return tuple(row)


def star_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(u, v) edges of numbers or strings -> (node, component) for every node on an edge; component = smallest node.

    Self edges and repeated edges are allowed; nulls are dropped.  Raises ``NoConvergence`` instead of
    returning an unfinished labelling.
    """
    cur = written(edges.select("u", "v")
                      .filter("u is not null and v is not null")
                      .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    loops = cur.filter("u = v").select(F.col("u").alias("node"))
    cur = cur.filter("u <> v")
    seen = _signature(cur)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        cur = written(_small_star(_large_star(cur)))
        now = _signature(cur)
        if now == seen:
            break
        seen = now
    else:
        raise NoConvergence("star contraction did not settle")
    roots = cur.select(F.col("v").alias("node")).union(loops).distinct()
    leaves = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    alone = roots.join(leaves.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
    return leaves.union(alone)
