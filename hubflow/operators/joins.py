"""Joins of hub features onto segment / trip tables.

The hub table has one row per hub: it grows with the network, not with the trip volume.  No side carries a broadcast
hint: the joins are planned as shuffle joins, and AQE broadcasts a side whose measured bytes are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HUB_COLUMNS = {"pagerank": "pagerank", "degree_centrality": "degree", "bottleneck_score": "bottleneck_score",
               "community_id": "community"}


def merge_hub_features(df: DataFrame, hubs: DataFrame, hub_col: str, prefix: str) -> DataFrame:
    """Attach ``{prefix}_pagerank/_degree/_bottleneck_score/_community`` by a left join on
    ``hub_col`` against the wide hub table (hub_id + metric columns)."""
    found = {k: v for k, v in HUB_COLUMNS.items() if k in hubs.columns}
    return df.join(hubs.select(F.col("hub_id").alias(hub_col), *[F.col(k).alias(f"{prefix}_{v}") for k, v in found.items()]), hub_col, "left")


def enrich_graph(df: DataFrame, hubs: DataFrame) -> DataFrame:
    """Source then destination hub features: two joins against one wide table (not eight)."""
    return merge_hub_features(merge_hub_features(df, hubs, "source_center", "source"), hubs, "destination_center", "destination")


def merge_graph_features(df: DataFrame, node_metrics: DataFrame, node_col: str,
                         metric_cols: list[str] | None = None, key: str = "hub_id") -> DataFrame:
    """Generic left join of a node-metric table on ``node_col`` (only ``metric_cols`` if given)."""
    cols = metric_cols or [c for c in node_metrics.columns if c != key]
    side = node_metrics.select(F.col(key).alias(node_col), *cols)
    return df.join(side, node_col, "left")


def attach_traffic(metrics: DataFrame, traffic: DataFrame) -> DataFrame:
    return metrics.join(traffic, "hub_id", "left")


def trip_holdout_filter(df: DataFrame, trips: DataFrame, key: str = "trip_uuid") -> DataFrame:
    """Rows whose trip is in the given trip set (``isin`` as a left-semi join)."""
    return df.join(trips.select(key).distinct(), key, "left_semi")


def hub_coverage(df: DataFrame, pagerank: DataFrame) -> DataFrame:
    """Share of distinct hubs (source or destination) present in the pagerank table (one row); ``df`` is read once."""
    hubs = df.select(F.explode(F.array("source_center", "destination_center")).alias("hub_id")).distinct()
    known = pagerank.select("hub_id").distinct().withColumn("_k", F.lit(1.0))
    j = hubs.join(known, "hub_id", "left")
    return j.agg((F.sum(F.coalesce("_k", F.lit(0.0))) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("coverage"))
