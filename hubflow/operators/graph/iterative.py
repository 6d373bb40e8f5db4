"""Iterative graph algorithms as DataFrame supersteps.

Every loop follows the same discipline:
* the edge table is hash-partitioned by its join key once and cached;
* each round's state is written as a table under the shared ``spark.checkpoint.dir`` (survives executor loss, truncates
  the lineage, has as many partitions as its size asks for) and the stop test is ONE scalar action;
* a ``max_iter`` guard raises instead of returning a half-converged answer.

Path metrics from many sources are in ``paths``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from hubflow import schema as S
from hubflow.operators.graph.contract import star_components
from hubflow.operators.graph.edges import HEAVY_HUB, mirrors, to_mirrors, undirected_projection, vertices
from hubflow.operators.graph.paths import HUBS_PER_PART, betweenness, distance_sums  # noqa: F401 (betweenness: one import path for all metrics)
from hubflow.session import NoConvergence, fitting, written

# ---- PageRank ---------------------------------------------------------------------------

def pagerank(edges: DataFrame, alpha: float = S.PAGERANK_ALPHA, tol: float = S.PAGERANK_TOL,
             max_iter: int = S.PAGERANK_MAX_ITER, iterations: int | None = None, heavy: int = HEAVY_HUB) -> DataFrame:
    """Weighted PageRank with uniform teleport and dangling mass spread uniformly.

    Stops when the L1 change is below ``n * tol`` (or after exactly ``iterations`` rounds when
    given).  Each round: ranks, copied to the mirrors of heavy hubs, JOIN out-normalised edges -> sum by target
    (partial aggregate), plus the dangling mass as a 1-row broadcast.
    """
    spark = edges.sparkSession
    e = edges.select("u", "v", F.col("weight").cast("double").alias("w"))
    ow = e.groupBy("u").agg(F.sum("w").alias("sw"))
    shares = e.join(ow, "u").select("u", "v", (F.col("w") / F.col("sw")).alias("p")).filter(F.col("p").isNotNull())
    split, copies = mirrors(written(shares), "u", "v", heavy)
    en = fitting(written(split), "u", "mirror").persist(StorageLevel.MEMORY_AND_DISK)
    nodes = written(vertices(edges).withColumnRenamed("hub_id", "h").join(copies.withColumnRenamed("u", "h"), "h", "left"))
    n = nodes.count()
    if n == 0:
        return spark.createDataFrame([], "hub_id string, pagerank double")
    dangling = nodes.join(ow.filter(F.col("sw") != 0).withColumnRenamed("u", "h"), "h", "left_anti")
    dangling = written(dangling)
    ranks = nodes.withColumn("r", F.lit(1.0 / n))
    rounds = iterations or max_iter
    for i in range(1, rounds + 1):
        contrib = (en.join(to_mirrors(ranks).withColumnRenamed("h", "u"), ["u", "mirror"])
                     .groupBy(F.col("v").alias("h")).agg(F.sum(F.col("r") * F.col("p")).alias("s")))
        dsum = ranks.join(dangling, "h", "left_semi").agg(F.coalesce(F.sum("r"), F.lit(0.0)).alias("dm"))
        new = (nodes.join(contrib, "h", "left").crossJoin(F.broadcast(dsum))
                    .select("h", "mirrors", ((1 - alpha) / n + alpha * (F.coalesce("s", F.lit(0.0)) + F.col("dm") / n)).alias("r")))
        new = written(new)
        if iterations is None:
            err = (new.join(ranks.select("h", F.col("r").alias("r0")), "h")
                      .agg(F.sum(F.abs(F.col("r") - F.col("r0"))).alias("e")).first()["e"])
            ranks = new
            if err < n * tol:
                break
        else:
            ranks = new
    else:
        if iterations is None:
            raise NoConvergence(f"pagerank did not converge in {max_iter} iterations")
    en.unpersist()
    return ranks.select(F.col("h").alias("hub_id"), F.col("r").alias("pagerank"))


# ---- weak components ----------------------------------------------------------------------

def connected_components(edges: DataFrame) -> DataFrame:
    """Weakly connected components; ``component`` = smallest hub id in the component (star contraction)."""
    found = star_components(edges.select("u", "v"))
    return vertices(edges).join(found, F.col("hub_id") == F.col("node"), "left").select(
        "hub_id", F.coalesce("component", "hub_id").alias("component"))


def component_sizes(components: DataFrame) -> DataFrame:
    return components.groupBy("component").agg(F.count(F.lit(1)).alias("size"))


def largest_component(components: DataFrame) -> DataFrame:
    """Members of the largest component (smallest component id on size ties)."""
    best = component_sizes(components).orderBy(F.col("size").desc(), "component").limit(1)
    return components.join(F.broadcast(best.select("component")), "component", "left_semi")


# ---- DAG test -------------------------------------------------------------------------------

def _to_roots(parent: DataFrame) -> DataFrame | None:
    """(x, root) of a parent table (x, p) by pointer doubling; None if some hub never leaves the table: a cycle."""
    table = written(parent.select("x", F.col("p").alias("root")))
    n = table.count()
    for _ in range(n.bit_length() + 1):
        ahead = table.select(F.col("x").alias("y"), F.col("root").alias("further"))
        stepped = written(table.join(ahead, F.col("root") == F.col("y"), "left")
                              .select("x", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("inside")))
        table = stepped.select("x", "root")
        if stepped.filter("inside").isEmpty():
            return table
    return None


def is_dag(edges: DataFrame, max_iter: int = 100000) -> bool:
    """True iff the directed graph has no cycle (a self-loop is a cycle).

    A round drops the lanes out of hubs that no lane enters -- if there are lanes but no such hub, some cycle exists --
    and merges every hub that one lane enters into the lane's start, whole chains and trees at once by pointer
    doubling; a cycle through a merged hub shows as a self-loop.  The next round does the same against the lanes'
    direction.  A chain of n lanes takes about log2(n) joins, not n.
    """
    cur = written(edges.select("u", "v").filter(F.col("u").isNotNull() & F.col("v").isNotNull()).distinct())
    for _ in range(max_iter):
        lanes, loops = cur.agg(F.count(F.lit(1)), F.count_if(F.col("u") == F.col("v"))).first()
        if not lanes or loops:
            return not loops
        entered = cur.groupBy(F.col("v").alias("x")).agg(F.count(F.lit(1)).alias("n"), F.min("u").alias("p"))
        inner = written(cur.join(entered.select(F.col("x").alias("u")), "u", "left_semi"))
        if inner.count() == lanes:
            return False
        # counted after the trimming: a hub may have lost all lanes but one
        single = inner.groupBy(F.col("v").alias("x")).agg(F.count(F.lit(1)).alias("n"), F.min("u").alias("p")).filter("n = 1")
        roots = _to_roots(single)
        if roots is None:
            return False
        kept = inner.join(roots.select(F.col("x").alias("v")), "v", "left_anti")
        merged = kept.join(roots, F.col("u") == F.col("x"), "left").select(F.coalesce("root", "u").alias("u"), "v").distinct()
        cur = written(merged.select(F.col("v").alias("u"), F.col("u").alias("v")))
    raise NoConvergence("is_dag exceeded max_iter")


# ---- closeness ------------------------------------------------------------------------------

def closeness(edges: DataFrame, hubs_per_part: int = HUBS_PER_PART) -> DataFrame:
    """Closeness on the largest weak component of the undirected projection (weights of both
    directions summed), distance = that weight, Wasserman-Faust scaling; other hubs get null."""
    und = undirected_projection(edges).select(F.col("a").alias("u"), F.col("b").alias("v"),
                                              F.col("weight").cast("double").alias("length"))
    comps = connected_components(edges)
    big = largest_component(comps).select("hub_id")
    m = big.count()
    sub = (und.join(big.withColumnRenamed("hub_id", "u"), "u", "left_semi")
              .join(big.withColumnRenamed("hub_id", "v"), "v", "left_semi"))
    if m <= 1:
        return vertices(edges).select("hub_id", F.lit(None).cast("double").alias("closeness_centrality"))
    agg = distance_sums(sub, written(big), hubs_per_part)
    cl = agg.select("hub_id", F.when(F.col("total") > 0, (F.col("r") / F.col("total")) * (F.col("r") / F.lit(m - 1)))
                    .otherwise(F.lit(0.0)).alias("closeness_centrality"))
    return vertices(edges).join(cl, "hub_id", "left")


def is_dag_frame(edges: DataFrame) -> DataFrame:
    spark = edges.sparkSession
    return spark.createDataFrame([(is_dag(edges),)], "is_dag boolean")
