"""Fixture views derived by Spark from the driver's TPC-H-style tables.

``segments`` is a raw-schema segment table (a trip is an order, a segment a line item, hubs are
suppliers); ``scored`` is a one-row-per-trip batch carrying a closed-form stand-in prediction so
every risk / operations operator can be checked exactly.  Both grow linearly with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hubflow.functions.exprs import route_lane


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hub(c) -> F.Column:
    return F.concat(F.lit("H"), F.lpad(c.cast("string"), 6, "0"))


def _hubs(spark: SparkSession, sf_dir: str) -> F.Column:
    """The number of hubs as a scalar subquery: a value to the plan, not a join of every row."""
    return table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("n")).scalar()


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-schema segment table (see FIXTURES.md §2 for the SQL text of the same view)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
        "l_returnflag", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    n = _hubs(spark, sf_dir)
    q, disc = F.col("l_quantity"), F.col("l_discount")
    seg_osrm = F.floor(q * 0.75).cast("double")
    seg_act = (F.when(F.col("l_partkey") % 211 == 0, F.lit(-1.0))
                .otherwise((F.floor(q * 0.75) + F.floor(q * disc * 10 + 0.5) + F.col("l_suppkey") % 7).cast("double")))
    # trip totals need only line-item columns: a partial (map-side combined) aggregate of the
    # lineitem scan, joined back on the order key.  A hot trip is split by AQE's skew-join
    # handling instead of one window task buffering the whole trip.  Orders and totals have a row per trip, so their
    # partitions are hashed: line items are dealt out once, by the same plan at every size, and never sorted.
    trips = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(seg_act).alias("trip_act"), F.sum(seg_osrm).alias("trip_osrm"), F.sum("l_quantity").alias("trip_qty"))
    leg = (li.join(od.hint("shuffle_hash"), li.l_orderkey == od.o_orderkey)
             .withColumns({
                 "src": F.col("l_suppkey"),
                 "dst": F.when((q >= 50) & (disc >= 0.095), F.col("o_custkey") % n)
                         .otherwise((F.col("l_suppkey") + 1 + F.col("l_partkey") % 5) % n),
                 "seg_osrm": seg_osrm,
                 "seg_act": seg_act,
             }))
    leg = leg.join(trips.hint("shuffle_hash"), "o_orderkey")
    ts_str = F.col("l_shipdate").cast("string")
    return leg.select(
        F.when(F.col("o_orderkey") % 5 == 0, "test").otherwise("training").alias("data"),
        F.concat(F.lit("trip-"), F.col("o_orderkey").cast("string")).alias("trip_uuid"),
        F.concat(F.lit("rs-"), (F.col("o_custkey") % 97).cast("string")).alias("route_schedule_uuid"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "FTL").otherwise("Carting").alias("route_type"),
        F.when(F.col("l_partkey") % 503 == 0, F.lit(None).cast("string")).otherwise(_hub(F.col("src"))).alias("source_center"),
        _hub(F.col("dst")).alias("destination_center"),
        F.concat(F.lit("Hub "), F.col("src").cast("string")).alias("source_name"),
        F.concat(F.lit("Hub "), F.col("dst").cast("string")).alias("destination_name"),
        F.timestamp_add("HOUR", ((F.col("o_orderkey") * 7) % 24).cast("int"), F.col("o_orderdate")).alias("trip_creation_time"),
        F.col("l_shipdate").alias("od_start_time"),
        F.timestamp_add("MINUTE", F.greatest(F.col("seg_act"), F.lit(0.0)).cast("int"), F.col("l_shipdate")).alias("od_end_time"),
        F.timestamp_add("MINUTE", F.col("seg_osrm").cast("int"), F.col("l_shipdate")).alias("cutoff_timestamp"),
        F.col("trip_act").alias("actual_time"),
        F.col("trip_osrm").alias("osrm_time"),
        F.col("seg_act").alias("segment_actual_time"),
        F.col("seg_osrm").alias("segment_osrm_time"),
        (F.col("trip_qty") * 1.1).alias("actual_distance_to_destination"),
        F.col("trip_qty").alias("osrm_distance"),
        F.col("l_quantity").alias("segment_osrm_distance"),
        F.try_divide(F.col("trip_act"), F.nullif(F.col("trip_osrm"), F.lit(0.0))).alias("factor"),
        F.try_divide(F.col("seg_act"), F.nullif(F.col("seg_osrm"), F.lit(0.0))).alias("segment_factor"),
        (F.col("l_returnflag") == "R").alias("is_cutoff"),
        F.col("l_linenumber").cast("int").alias("cutoff_factor"),
        F.concat_ws("-", F.lit("seg"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                    F.col("l_partkey").cast("string"), F.col("src").cast("string"), ts_str).alias("segment_key"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scored row per trip with a closed-form stand-in prediction (FIXTURES.md §4)."""
    from hubflow.operators.clean import clean_segments
    from hubflow.operators.graph.edges import traffic_volume

    clean = clean_segments(segments(spark, sf_dir), keep_extra=["segment_key"])
    lane_counts = clean.groupBy("source_center", "destination_center").agg(F.count(F.lit(1)).alias("weight"))
    t = traffic_volume(lane_counts)
    stats = t.agg(F.min("traffic_volume").alias("lo"), F.max("traffic_volume").alias("hi"))
    hub = (t.crossJoin(F.broadcast(stats))
             .select("hub_id",
                     ((F.col("traffic_volume") - F.col("lo")) / (F.col("hi") - F.col("lo") + 1e-9)).alias("score"),
                     (F.substring("hub_id", 2, 100).cast("int") % 4).alias("community")))
    # first segment of each trip: min_by is partially aggregated map-side, so a trip with a huge
    # number of segments never lands whole in one task
    keep = ["source_center", "destination_center", "route_type", "trip_creation_time", "osrm_time", "actual_time"]
    one = (clean.groupBy("trip_uuid")
                .agg(F.min_by(F.struct(*keep), F.col("segment_key")).alias("r"))
                .select("trip_uuid", "r.*"))
    s = hub.select(F.col("hub_id").alias("source_center"), F.col("score").alias("source_bottleneck_score"),
                   F.col("community").alias("source_community"))
    d = hub.select(F.col("hub_id").alias("destination_center"), F.col("score").alias("destination_bottleneck_score"),
                   F.col("community").alias("destination_community"))
    # hub tables have one row per hub; the broadcast is guarded by AQE's size threshold
    out = one.join(s, "source_center", "left").join(d, "destination_center", "left")
    return out.select(
        "trip_uuid", route_lane().alias("route_lane"), "source_center", "destination_center", "route_type",
        F.hour("trip_creation_time").cast("int").alias("trip_hour"), "osrm_time", "actual_time",
        "source_bottleneck_score", "destination_bottleneck_score", "source_community", "destination_community",
        (F.col("osrm_time") * (1.1 + 0.8 * F.col("destination_bottleneck_score")) + 5).alias("predicted_eta"),
        "trip_creation_time",
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimal scoring requests derived from ``events`` purchases (FIXTURES.md §5)."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    n_hubs = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("n"))
    e = ev.crossJoin(F.broadcast(n_hubs))
    return e.select(
        F.col("event_id").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        _hub(F.col("user_id") % F.col("n")).alias("source_center"),
        _hub((F.col("user_id") + 1 + F.col("event_id") % 5) % F.col("n")).alias("destination_center"),
        F.col("value").cast("double").alias("osrm_distance"),
        F.hour("ts").cast("int").alias("trip_hour"),
        F.when(F.col("event_id") % 2 == 0, "FTL").otherwise("Carting").alias("route_type"),
    )


def hub_table(spark: SparkSession, sf_dir: str, clean: DataFrame | None = None) -> DataFrame:
    """Stand-in wide hub table (hub_id, pagerank, degree_centrality, bottleneck_score,
    community_id) computable in plain SQL: traffic share, degree centrality, min-max traffic,
    hub number mod 4.  Lets join/feature operators be checked exactly and cheaply.  ``clean``: the clean segments, if they are at hand."""
    from hubflow.operators.clean import clean_segments
    from hubflow.operators.graph.edges import degree_centrality, lane_edges, traffic_volume
    from hubflow.session import written

    # lanes and hubs are few beside the segments: both are written, so that no reader runs the segment scan again
    e = written(lane_edges(clean_segments(segments(spark, sf_dir)) if clean is None else clean))
    t = traffic_volume(e)
    stats = t.agg(F.min("traffic_volume").alias("lo"), F.max("traffic_volume").alias("hi"),
                  F.sum("traffic_volume").alias("tot"))
    hubs = (t.crossJoin(F.broadcast(stats)).join(degree_centrality(e), "hub_id")
             .select("hub_id", (F.col("traffic_volume") / F.col("tot")).alias("pagerank"), "degree_centrality",
                     ((F.col("traffic_volume") - F.col("lo")) / (F.col("hi") - F.col("lo") + 1e-9)).alias("bottleneck_score"),
                     (F.substring("hub_id", 2, 100).cast("int") % 4).alias("community_id")))
    return written(hubs)
