"""Hub graph as DataFrames: an edge table (u, v, weight, ...) plus derived vertex tables.

Nothing here collects the graph: every metric is a grouped aggregate or a join, so the edge
table can be as large as the lane set of the whole network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubflow.functions.exprs import route_lane

#: Two path lengths are equal if they differ by no more than this share: sums of the same lengths in
#: another order differ by rounding alone, sums of different lengths by far more.
TIE = 1e-10
#: Lanes of one hub that a partition may hold.
HEAVY_HUB = 100_000


def aggregate_lane_edges(df: DataFrame) -> DataFrame:
    """Collapse processed segments to weighted directed lane edges.

    weight = segments on the lane; mean delay / actual / OSRM times; first (smallest) names;
    up to three sorted distinct route types joined by ','.
    """
    if "route_lane" not in df.columns:
        df = df.withColumn("route_lane", route_lane())
    g = (df.filter(F.col("source_center").isNotNull() & F.col("destination_center").isNotNull())
           .groupBy("source_center", "destination_center")
           .agg(F.count("route_lane").alias("weight"),
                F.avg("segment_delay_ratio").alias("avg_delay"),
                F.avg("segment_actual_time").alias("avg_actual_time"),
                F.avg("segment_osrm_time").alias("avg_osrm_time"),
                F.min("source_name").alias("source_name"),
                F.min("destination_name").alias("destination_name"),
                F.array_join(F.slice(F.array_sort(F.collect_set("route_type")), 1, 3), ",").alias("route_types")))
    return g.withColumn("route_lane", route_lane())


def lane_edges(df: DataFrame) -> DataFrame:
    """Production edge table (u, v, weight, avg_delay) in the graph-operator naming."""
    e = aggregate_lane_edges(df)
    return e.select(F.col("source_center").alias("u"), F.col("destination_center").alias("v"),
                    F.col("weight").cast("bigint").alias("weight"), "avg_delay")


def build_digraph(edge_list: DataFrame, src: str, dst: str, weight: str | None = None,
                  order_col: str | None = None, attrs: dict | None = None) -> DataFrame:
    """Generic edge list -> one row per directed (u, v).

    A repeated pair keeps its *last* row (``add_edge`` overwrites), where "last" is the largest
    ``order_col``; ``max_by`` does this in a partial aggregate (no window, skew-safe).
    """
    cols = [F.col(src).alias("u"), F.col(dst).alias("v")]
    cols.append((F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"))
    for k, val in (attrs or {}).items():
        cols.append(F.lit(val).alias(k))
    order = F.col(order_col) if order_col else F.lit(0)
    base = edge_list.select(*cols, order.alias("_ord")).filter(F.col("u").isNotNull() & F.col("v").isNotNull())
    other = [c for c in base.columns if c not in ("u", "v", "_ord")]
    g = base.groupBy("u", "v").agg(F.max_by(F.struct(*other), F.col("_ord")).alias("a"))
    return g.select("u", "v", "a.*")


def vertices(edges: DataFrame) -> DataFrame:
    """Distinct endpoints of the edge table."""
    return edges.select(F.col("u").alias("hub_id")).union(edges.select(F.col("v").alias("hub_id"))).distinct()


def with_flow_distance(edges: DataFrame) -> DataFrame:
    """``flow_distance = 1/max(weight, 1)``; ``dist`` is the same length under the name that the
    path operators read.  Path sums are doubles, so they are compared with ``TIE`` (relative)."""
    length = 1.0 / F.greatest(F.col("weight"), F.lit(1)).cast("double")
    return edges.withColumns({"flow_distance": length, "dist": length})


def traffic_volume(edges: DataFrame, u: str | None = None, v: str | None = None, w: str = "weight") -> DataFrame:
    """In-weight + out-weight per hub (a self-loop counts twice)."""
    if u is None:
        u, v = ("u", "v") if "u" in edges.columns else ("source_center", "destination_center")
    ends = (edges.select(F.col(u).alias("hub_id"), F.col(w).alias("w"))
                 .union(edges.select(F.col(v).alias("hub_id"), F.col(w).alias("w"))))
    return ends.groupBy("hub_id").agg(F.sum("w").cast("bigint").alias("traffic_volume"))


def degree_table(edges: DataFrame) -> DataFrame:
    """Raw degree (in + out edge count, self-loop counts 2) per hub."""
    ends = edges.select(F.col("u").alias("hub_id")).union(edges.select(F.col("v").alias("hub_id")))
    return ends.groupBy("hub_id").agg(F.count(F.lit(1)).alias("degree"))


def degree_centrality(edges: DataFrame) -> DataFrame:
    """degree / (n - 1); a single-node graph gets 1.0 per node as in the reference library."""
    d = degree_table(edges)
    n = d.agg(F.count(F.lit(1)).alias("n"))
    return d.crossJoin(F.broadcast(n)).select(
        "hub_id", F.when(F.col("n") > 1, F.col("degree") / (F.col("n") - 1)).otherwise(F.lit(1.0))
        .alias("degree_centrality"))


def mirrors(lanes: DataFrame, key: str, other: str, heavy: int = HEAVY_HUB) -> tuple[DataFrame, DataFrame]:
    """Splits the lanes of heavy hubs over mirrors of the hub.

    Returns the lanes with ``mirror`` (0 for most; a hash of ``other`` below the number of mirrors for a hub with more
    than ``heavy`` lanes) and the table (key, mirrors) of the hubs with lanes.  Partitioned by (key, mirror) no
    partition holds much more than ``heavy`` lanes of one hub; the state of a hub goes to each of its mirrors, and sums by the
    other end are partial ones that a grouped aggregate adds up.
    """
    copies = lanes.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / heavy).cast("int").alias("mirrors"))
    several = copies.filter("mirrors > 1")
    split = lanes.join(several, key, "left").withColumn(
        "mirror", F.coalesce(F.pmod(F.xxhash64(other), F.col("mirrors")), F.lit(0)).cast("int")).drop("mirrors")
    return split, copies


def to_mirrors(state: DataFrame, count: str = "mirrors") -> DataFrame:
    """A row for each mirror of a row's hub (none for a null count: a hub without lanes)."""
    return state.withColumn("mirror", F.explode(F.sequence(F.lit(0), F.col(count) - 1))).drop(count)


def high_degree_nodes(edges: DataFrame, k: int = 10) -> DataFrame:
    return degree_table(edges).orderBy(F.col("degree").desc(), "hub_id").limit(k)


def undirected_projection(edges: DataFrame) -> DataFrame:
    """Undirected edge (a <= b) with the weights of both directions summed."""
    return (edges.groupBy(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"))
                 .agg(F.sum("weight").alias("weight")))


def top_n(df: DataFrame, metric: str, n: int, key: str = "hub_id") -> DataFrame:
    """Generic ranking: top ``n`` rows by ``metric`` (key breaks ties)."""
    return df.orderBy(F.col(metric).desc_nulls_last(), F.col(key)).limit(n)


def route_importance(lanes: DataFrame, k: int = 15) -> DataFrame:
    """Busiest, highest-delay and most critical (weight x delay) lanes, tagged by rank type."""
    r = lanes.withColumn("criticality", F.col("weight") * F.col("avg_delay"))

    def top(metric, tag):
        return top_n(r, metric, k, "route_lane").withColumn("rank_type", F.lit(tag))
    return top("weight", "busiest").unionByName(top("avg_delay", "highest_delay")).unionByName(top("criticality", "critical"))


def top_subgraph(edges: DataFrame, traffic: DataFrame, top_hubs: int = 35, top_edges: int = 80) -> DataFrame:
    """Edges among the top hubs by traffic and the endpoints of the heaviest edges.

    Both node sets are top-k results (bounded by k, so broadcasting them is safe); the edge filter
    is two left-semi joins.
    """
    hubs = top_n(traffic, "traffic_volume", top_hubs).select("hub_id")
    heavy = edges.orderBy(F.col("weight").desc(), "u", "v").limit(top_edges)
    ends = heavy.select(F.col("u").alias("hub_id")).union(heavy.select(F.col("v").alias("hub_id")))
    nodes = F.broadcast(hubs.union(ends).distinct())
    return (edges.join(nodes.withColumnRenamed("hub_id", "u"), "u", "left_semi")
                 .join(nodes.withColumnRenamed("hub_id", "v"), "v", "left_semi"))


def mean_outgoing_delay(edges: DataFrame) -> DataFrame:
    """Unweighted mean of ``avg_delay`` over each hub's out-edges (null when it has none)."""
    return edges.groupBy(F.col("u").alias("hub_id")).agg(F.avg("avg_delay").alias("mean_outgoing_delay"))


def minmax_scale(df: DataFrame, column: str, out: str, eps: float = 0.0) -> DataFrame:
    """(x - min) / (max - min + eps) with the 1-row range broadcast; all-equal -> 0."""
    rng = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    span = F.col("_hi") - F.col("_lo")
    if eps:
        val = (F.col(column) - F.col("_lo")) / (span + eps)
    else:
        val = F.when(span == 0, F.lit(0.0)).otherwise((F.col(column) - F.col("_lo")) / span)
    return df.crossJoin(F.broadcast(rng)).withColumn(out, val).drop("_lo", "_hi")

