"""Composite hub scores, topology summary and the full hub feature store build."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubflow import schema as S
from hubflow.operators.graph import communities as CM
from hubflow.operators.graph import iterative as IT
from hubflow.operators.quantiles import wide_quantiles
from hubflow.operators.graph.edges import (
    degree_centrality,
    mean_outgoing_delay,
    minmax_scale,
    traffic_volume,
    vertices,
    with_flow_distance,
)


def bottleneck_prod(betweenness: DataFrame, traffic: DataFrame) -> DataFrame:
    """Production score: 0.6 * scaled betweenness + 0.4 * scaled traffic (denominators + 1e-9)."""
    wb, wt = S.BOTTLENECK_PROD_WEIGHTS
    base = betweenness.join(traffic, "hub_id", "left").withColumn(
        "traffic_volume", F.coalesce("traffic_volume", F.lit(0)))
    base = minmax_scale(base, "betweenness_centrality", "_sb", eps=1e-9)
    base = minmax_scale(base, "traffic_volume", "_st", eps=1e-9)
    return base.select("hub_id", (wb * F.col("_sb") + wt * F.col("_st")).alias("bottleneck_score"),
                       "betweenness_centrality", F.col("traffic_volume").cast("bigint").alias("traffic_volume"))


def bottleneck_analyst(betweenness: DataFrame, traffic: DataFrame, edges: DataFrame) -> DataFrame:
    """Analyst score: 0.45 betweenness + 0.35 traffic + 0.20 mean outgoing delay (missing delay
    -> median over hubs), each min-max scaled (all-equal -> 0)."""
    wb, wt, wd = S.BOTTLENECK_ANALYST_WEIGHTS
    base = (betweenness.join(traffic, "hub_id", "left")
                       .join(mean_outgoing_delay(edges), "hub_id", "left"))
    med = wide_quantiles(base, ["mean_outgoing_delay"], [0.5]).select(F.col("q_mean_outgoing_delay")[0].alias("_med"))
    base = (base.crossJoin(F.broadcast(med))
                .withColumn("_delay", F.coalesce("mean_outgoing_delay", "_med")).drop("_med"))
    base = minmax_scale(base, "betweenness_centrality", "score_betweenness")
    base = minmax_scale(base, "traffic_volume", "score_traffic")
    base = minmax_scale(base, "_delay", "score_delay")
    return base.drop("_delay").withColumn(
        "bottleneck_score", wb * F.col("score_betweenness") + wt * F.col("score_traffic") + wd * F.col("score_delay"))


def graph_summary(edges: DataFrame) -> DataFrame:
    """nodes, edges, density, average degree, weak components, largest component size / %,
    DAG flag (one row)."""
    spark = edges.sparkSession
    nodes = vertices(edges).count()
    m = edges.select("u", "v").distinct().count()
    comps = IT.connected_components(edges)
    sizes = IT.component_sizes(comps).agg(F.count(F.lit(1)).alias("k"), F.max("size").alias("big")).first()
    dag = IT.is_dag(edges)
    dens = m / (nodes * (nodes - 1)) if nodes > 1 else 0.0
    row = (int(nodes), int(m), round(float(dens), 6), round(2 * m / nodes, 2) if nodes else 0.0, int(sizes["k"]),
           int(sizes["big"]), round(sizes["big"] / nodes * 100, 2) if nodes else 0.0, bool(dag))
    return spark.createDataFrame([row], "nodes bigint, edges bigint, density double, avg_degree double, "
                                        "weakly_connected_components bigint, largest_component_nodes bigint, "
                                        "largest_component_pct double, is_dag boolean")


def lane_graph_tables(edges: DataFrame, seed: int = S.SEED, pagerank_iterations: int | None = None) -> dict:
    """The four hub tables of the feature store: pagerank, degree, bottleneck, communities."""
    e = with_flow_distance(edges).persist()
    traffic = traffic_volume(e)
    bet = IT.betweenness(e)
    pr = IT.pagerank(e, iterations=pagerank_iterations)
    deg = degree_centrality(e)
    bn = bottleneck_prod(bet, traffic)
    comm = CM.community_table(CM.louvain(e, seed=seed))
    return {"pagerank": pr, "degree": deg, "bottleneck": bn, "communities": comm}


def hub_feature_table(tables: dict) -> DataFrame:
    """One wide row per hub (pagerank, degree, bottleneck score, community) so enrichment is two
    joins instead of eight."""
    pr = tables["pagerank"].select("hub_id", "pagerank")
    deg = tables["degree"].select("hub_id", "degree_centrality")
    bn = tables["bottleneck"].select("hub_id", "bottleneck_score")
    cm = tables["communities"].select("hub_id", "community_id")
    return (pr.join(deg, "hub_id", "full_outer").join(bn, "hub_id", "full_outer").join(cm, "hub_id", "full_outer"))
