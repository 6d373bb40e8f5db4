"""Registered queries: hub-feature joins, model features, preprocessing."""

from __future__ import annotations

from pyspark.sql import functions as F

from hubflow import schema as S
from hubflow.operators import features as FE
from hubflow.operators import joins as J
from hubflow.operators import preprocess as PP
from hubflow.operators.clean import add_trip_time_parts
from hubflow.operators.graph import edges as G
from hubflow.plans.common import clean_frame, query, round_doubles
from hubflow.plans.oracle import HUBS, oracle
from hubflow.session import written
from hubflow.sources import fixtures


def enriched(spark, sf):
    """Cleaned segments with calendar parts and source/destination hub features."""
    seg = add_trip_time_parts(clean_frame(spark, sf))
    return J.enrich_graph(seg, fixtures.hub_table(spark, sf))


ENR = """enr AS (SELECT c.*,
  s.pagerank AS source_pagerank, s.degree_centrality AS source_degree, s.bottleneck_score AS source_bottleneck_score,
  s.community_id AS source_community, d.pagerank AS destination_pagerank, d.degree_centrality AS destination_degree,
  d.bottleneck_score AS destination_bottleneck_score, d.community_id AS destination_community
  FROM clean c LEFT JOIN hubs s ON s.hub_id = c.source_center LEFT JOIN hubs d ON d.hub_id = c.destination_center)"""

FEAT = """feat AS (SELECT *, sin(2 * pi() * trip_hour / 24) AS trip_hour_sin, cos(2 * pi() * trip_hour / 24) AS trip_hour_cos,
  CAST(trip_dayofweek >= 5 AS INT) AS is_weekend,
  CAST(route_type = 'Carting' AS DOUBLE) AS route_type_Carting, CAST(route_type = 'FTL' AS DOUBLE) AS route_type_FTL,
  segment_osrm_time / nullif(osrm_time, 0) AS segment_time_share,
  segment_osrm_distance / nullif(osrm_distance, 0) AS segment_distance_share,
  segment_osrm_time / nullif(osrm_time, 0) AS segment_osrm_to_trip_osrm_time,
  source_pagerank * destination_pagerank AS graph_pagerank_product,
  source_bottleneck_score + destination_bottleneck_score AS graph_bottleneck_sum,
  abs(source_pagerank - destination_pagerank) AS graph_pagerank_gap,
  CAST(coalesce(source_community = destination_community, false) AS DOUBLE) AS same_community FROM enr)"""


# ---- 2.C joins --------------------------------------------------------------------------

@query("merge_hub_features")
def q_merge_hub_features(spark, sf):
    seg = clean_frame(spark, sf).select("segment_key", "source_center")
    out = J.merge_hub_features(seg, fixtures.hub_table(spark, sf), "source_center", "source")
    return round_doubles(out)


oracle("merge_hub_features", """SELECT c.source_center, c.segment_key, round(h.pagerank, 6) AS source_pagerank,
  round(h.degree_centrality, 6) AS source_degree, round(h.bottleneck_score, 6) AS source_bottleneck_score,
  h.community_id AS source_community FROM clean c LEFT JOIN hubs h ON h.hub_id = c.source_center""", HUBS)


@query("enrich_graph")
def q_enrich_graph(spark, sf):
    out = enriched(spark, sf).select("segment_key", *[c for c in S.GRAPH_FEATURES[:8]])
    return round_doubles(out)


oracle("enrich_graph", "SELECT segment_key, " + ", ".join(
    f"round({c}, 6) AS {c}" if "community" not in c else c for c in S.GRAPH_FEATURES[:8]) + " FROM enr", HUBS, ENR)


@query("merge_graph_features")
def q_merge_graph_features(spark, sf):
    seg = clean_frame(spark, sf).select("segment_key", "destination_center")
    out = J.merge_graph_features(seg, fixtures.hub_table(spark, sf), "destination_center",
                                 metric_cols=["bottleneck_score"])
    return round_doubles(out)


oracle("merge_graph_features", """SELECT c.destination_center, c.segment_key, round(h.bottleneck_score, 6) AS bottleneck_score
  FROM clean c LEFT JOIN hubs h ON h.hub_id = c.destination_center""", HUBS)


@query("attach_traffic")
def q_attach_traffic(spark, sf):
    e = G.lane_edges(clean_frame(spark, sf))
    return round_doubles(J.attach_traffic(G.degree_centrality(e), G.traffic_volume(e)))


oracle("attach_traffic", """SELECT h.hub_id, round(h.degree_centrality, 6) AS degree_centrality, t.traffic_volume
  FROM hubs h LEFT JOIN (SELECT hub_id, CAST(sum(w) AS BIGINT) AS traffic_volume FROM (
    SELECT source_center AS hub_id, count(*) AS w FROM clean GROUP BY 1
    UNION ALL SELECT destination_center, count(*) FROM clean GROUP BY 1) GROUP BY hub_id) t ON t.hub_id = h.hub_id""", HUBS)


@query("centrality_diag")
def q_centrality_diag(spark, sf):
    """Hub table with traffic, mean outgoing delay and bottleneck score, left join the pagerank of the hubs that
    send segments (the others stay null)."""
    seg = clean_frame(spark, sf)
    e = G.lane_edges(seg)
    hubs = fixtures.hub_table(spark, sf)
    bn = J.attach_traffic(hubs.select("hub_id", "bottleneck_score"), G.traffic_volume(e)).join(G.mean_outgoing_delay(e), "hub_id", "left")
    pr = hubs.select("hub_id", "pagerank").join(seg.select(F.col("source_center").alias("hub_id")).distinct(), "hub_id", "left_semi")
    return round_doubles(J.merge_graph_features(bn, pr, "hub_id"))


oracle("centrality_diag", """SELECT b.hub_id, round(b.bottleneck_score, 6) AS bottleneck_score, t.traffic_volume,
  round(o.m, 6) AS mean_outgoing_delay, round(p.pagerank, 6) AS pagerank FROM hubs b
  LEFT JOIN (SELECT hub_id, CAST(sum(w) AS BIGINT) AS traffic_volume FROM (
    SELECT source_center AS hub_id, count(*) AS w FROM clean GROUP BY 1
    UNION ALL SELECT destination_center, count(*) FROM clean GROUP BY 1) GROUP BY hub_id) t ON t.hub_id = b.hub_id
  LEFT JOIN (SELECT u, avg(d) AS m FROM (SELECT source_center AS u, avg(segment_delay_ratio) AS d FROM clean
    GROUP BY source_center, destination_center) GROUP BY u) o ON o.u = b.hub_id
  LEFT JOIN (SELECT * FROM hubs WHERE hub_id IN (SELECT source_center FROM clean)) p ON p.hub_id = b.hub_id""", HUBS)


@query("trip_holdout_filter")
def q_trip_holdout_filter(spark, sf):
    from hubflow.operators.ml import trip_split
    seg = clean_frame(spark, sf)
    test_trips = trip_split(seg).filter(F.col("split") == "test").select("trip_uuid")
    return J.trip_holdout_filter(seg, test_trips).groupBy("route_type").agg(F.count(F.lit(1)).alias("rows"))


oracle("trip_holdout_filter", """SELECT route_type, count(*) AS rows FROM clean
  WHERE CAST('0x' || substr(md5(trip_uuid || '|42'), 1, 8) AS BIGINT) % 100 < 20 GROUP BY route_type""")


@query("hub_coverage")
def q_hub_coverage(spark, sf):
    """Share of all hubs that the table of sending hubs (of cut-off segments) covers."""
    seg = clean_frame(spark, sf)
    hubs = seg.filter("is_cutoff").select(F.col("source_center").alias("hub_id")).distinct()
    return round_doubles(J.hub_coverage(seg, hubs))


oracle("hub_coverage", """SELECT round(count(*) FILTER (WHERE h IN (SELECT source_center FROM clean WHERE is_cutoff)) / count(*), 6)
  AS coverage FROM (SELECT source_center AS h FROM clean UNION SELECT destination_center FROM clean)""")


# ---- 2.F features -----------------------------------------------------------------------

@query("cyclic_hour")
def q_cyclic_hour(spark, sf):
    df = FE.add_cyclic_hour(add_trip_time_parts(clean_frame(spark, sf)))
    return round_doubles(df.groupBy("trip_hour", "trip_hour_sin", "trip_hour_cos", "is_weekend").agg(
        F.count(F.lit(1)).alias("n")))


oracle("cyclic_hour", """SELECT trip_hour, round(sin(2 * pi() * trip_hour / 24), 6) AS trip_hour_sin,
  round(cos(2 * pi() * trip_hour / 24), 6) AS trip_hour_cos, CAST(trip_dayofweek >= 5 AS INT) AS is_weekend, count(*) AS n
  FROM clean GROUP BY ALL""")


@query("route_dummies")
def q_route_dummies(spark, sf):
    seg = clean_frame(spark, sf)
    out = FE.add_route_dummies(seg, FE.route_type_values(seg))
    return out.groupBy("route_type", "route_type_Carting", "route_type_FTL").agg(F.count(F.lit(1)).alias("n"))


oracle("route_dummies", """SELECT route_type, CAST(route_type = 'Carting' AS DOUBLE) AS route_type_Carting,
  CAST(route_type = 'FTL' AS DOUBLE) AS route_type_FTL, count(*) AS n FROM clean GROUP BY ALL""")


@query("osrm_ratios")
def q_osrm_ratios(spark, sf):
    out = FE.add_osrm_ratios(clean_frame(spark, sf))
    return round_doubles(out.select("segment_key", "segment_time_share", "segment_distance_share",
                                    "segment_osrm_to_trip_osrm_time"))


oracle("osrm_ratios", """SELECT segment_key, round(segment_osrm_time / nullif(osrm_time, 0), 6) AS segment_time_share,
  round(segment_osrm_distance / nullif(osrm_distance, 0), 6) AS segment_distance_share,
  round(segment_osrm_time / nullif(osrm_time, 0), 6) AS segment_osrm_to_trip_osrm_time FROM clean""")


@query("graph_interactions")
def q_graph_interactions(spark, sf):
    out = FE.add_graph_interactions(enriched(spark, sf))
    return round_doubles(out.select("segment_key", *S.GRAPH_FEATURES[8:]))


oracle("graph_interactions", """SELECT segment_key, round(source_pagerank * destination_pagerank, 6) AS graph_pagerank_product,
  round(source_bottleneck_score + destination_bottleneck_score, 6) AS graph_bottleneck_sum,
  round(abs(source_pagerank - destination_pagerank), 6) AS graph_pagerank_gap,
  CAST(coalesce(source_community = destination_community, false) AS DOUBLE) AS same_community FROM enr""", HUBS, ENR)


@query("build_ml_features")
def q_build_ml_features(spark, sf):
    df = enriched(spark, sf)
    out = FE.build_ml_features(df, FE.route_type_values(df))
    return round_doubles(out.select("segment_key", *FE.feature_list(["Carting", "FTL"])))


oracle("build_ml_features", "SELECT segment_key, " + ", ".join(
    f"round({c}, 6) AS {c}" if c not in ("is_weekend", "source_community", "destination_community") else c
    for c in FE.feature_list(["Carting", "FTL"])) + " FROM feat", HUBS, ENR, FEAT)


@query("expand_minimal")
def q_expand_minimal(spark, sf):
    req = fixtures.requests(spark, sf)
    req = req.withColumn("osrm_time", F.when(F.col("request_id") % 3 == 0, F.col("osrm_distance") * 0.5))
    out = FE.expand_minimal(req, osrm_minutes_per_km=0.76)
    return round_doubles(out.select("request_id", "osrm_time", "segment_osrm_time", "segment_osrm_distance",
                                    "trip_dayofweek"))


oracle("expand_minimal", """SELECT event_id AS request_id,
  round(CASE WHEN event_id % 3 = 0 THEN value * 0.5 ELSE value * 0.76 END, 6) AS osrm_time,
  round(CASE WHEN event_id % 3 = 0 THEN value * 0.5 ELSE value * 0.76 END, 6) AS segment_osrm_time,
  round(value, 6) AS segment_osrm_distance, 2 AS trip_dayofweek FROM events WHERE event_type = 'purchase'""")


# ---- 2.G preprocessing --------------------------------------------------------------------

_PP_FEATS = FE.feature_list(["Carting", "FTL"])


def _featured(spark, sf):
    df = enriched(spark, sf)
    return FE.build_ml_features(df, ["Carting", "FTL"])


@query("fit_preprocessor")
def q_fit_preprocessor(spark, sf):
    from hubflow.operators.ml import trip_split
    tr = trip_split(_featured(spark, sf)).filter(F.col("split") == "train")
    art = PP.fit_preprocessor(tr, _PP_FEATS)
    rows = [(c, art.fill_values[c], art.clip_upper[c]) for c in art.feature_columns]
    rows.append(("__osrm_minutes_per_km", art.osrm_minutes_per_km, art.osrm_time_median))
    return round_doubles(spark.createDataFrame(rows, "feature string, fill_value double, clip_upper double"))


_TRAIN = "tr AS (SELECT * FROM feat WHERE CAST('0x' || substr(md5(trip_uuid || '|42'), 1, 8) AS BIGINT) % 100 >= 20)"
oracle("fit_preprocessor", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(median({c}), 6) AS fill_value, round(quantile_cont({c}, 0.99), 6) AS clip_upper FROM tr"
    for c in _PP_FEATS) + """ UNION ALL SELECT '__osrm_minutes_per_km', round(median(osrm_time / nullif(osrm_distance, 0)), 6),
  round(median(osrm_time), 6) FROM tr""", HUBS, ENR, FEAT, _TRAIN)


@query("transform_features")
def q_transform_features(spark, sf):
    from hubflow.operators.ml import trip_split
    df = written(trip_split(_featured(spark, sf)).select("segment_key", "split", *_PP_FEATS))  # the fit and the transform read it
    art = PP.fit_preprocessor(df.filter(F.col("split") == "train"), _PP_FEATS)
    out = PP.transform_features(df.filter(F.col("split") == "test"), art, keep=["segment_key"])
    return round_doubles(out)


oracle("transform_features", "SELECT segment_key, " + ", ".join(
    f"round(CAST(least(coalesce({c}, (SELECT median({c}) FROM tr)), (SELECT quantile_cont({c}, 0.99) FROM tr)) AS DOUBLE), 6) AS {c}"
    for c in _PP_FEATS) + " FROM feat WHERE CAST('0x' || substr(md5(trip_uuid || '|42'), 1, 8) AS BIGINT) % 100 < 20",
       HUBS, ENR, FEAT, _TRAIN)


@query("sanitize_global")
def q_sanitize_global(spark, sf):
    from hubflow.operators.ml import trip_split
    df = written(trip_split(_featured(spark, sf)).select("segment_key", "split", *_PP_FEATS))  # two fits and the transform read it
    out = PP.sanitize_global(df, df.filter(F.col("split") == "train"), _PP_FEATS)
    return round_doubles(out.drop("split"))


oracle("sanitize_global", "SELECT segment_key, " + ", ".join(
    f"round(CAST(least(coalesce({c}, (SELECT median({c}) FROM feat)), (SELECT quantile_cont({c}, 0.99) FROM tr)) AS DOUBLE), 6) AS {c}"
    for c in _PP_FEATS) + " FROM feat", HUBS, ENR, FEAT, _TRAIN)


@query("standardize")
def q_standardize(spark, sf):
    out = PP.standardize(_featured(spark, sf).select("segment_key", *_PP_FEATS), _PP_FEATS)
    return round_doubles(out)


oracle("standardize", "SELECT segment_key, " + ", ".join(
    f"CASE WHEN (SELECT stddev_pop({c}) FROM feat) > 0 THEN round(({c} - (SELECT avg({c}) FROM feat)) / (SELECT stddev_pop({c}) FROM feat), 6) ELSE 0.0 END AS {c}"
    for c in _PP_FEATS) + " FROM feat", HUBS, ENR, FEAT)


@query("artifact_roundtrip")
def q_artifact_roundtrip(spark, sf):
    """Artifact -> JSON -> artifact -> one-row frame, opened again to a row for each feature."""
    from hubflow.operators.ml import trip_split
    art = PP.fit_preprocessor(trip_split(_featured(spark, sf)).filter(F.col("split") == "train"), _PP_FEATS)
    back = PP.Artifact.from_json(art.to_json())
    rows = back.to_frame(spark).select(F.explode("feature_columns").alias("feature"), "fill_values", "clip_upper")
    return round_doubles(rows.select("feature", F.col("fill_values")[F.col("feature")].alias("fill_value"),
                                     F.col("clip_upper")[F.col("feature")].alias("clip_upper"), F.lit(back == art).alias("lossless")))


oracle("artifact_roundtrip", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(median({c}), 6) AS fill_value, round(quantile_cont({c}, 0.99), 6) AS clip_upper, true AS lossless FROM tr"
    for c in _PP_FEATS), HUBS, ENR, FEAT, _TRAIN)


@query("feature_list")
def q_feature_list(spark, sf):
    """Canonical ordered feature names: base, the fitted route dummies (sorted), graph features."""
    names = FE.feature_list(FE.route_type_values(clean_frame(spark, sf)))
    return spark.createDataFrame(list(enumerate(names)), "position int, feature string")


oracle("feature_list", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS feature" for i, c in enumerate(S.BASE_FEATURES)) + f"""
  UNION ALL SELECT CAST({len(S.BASE_FEATURES)} + row_number() OVER (ORDER BY route_type) - 1 AS INT), 'route_type_' || route_type
    FROM (SELECT DISTINCT route_type FROM clean)
  UNION ALL SELECT CAST({len(S.BASE_FEATURES)} + (SELECT count(DISTINCT route_type) FROM clean) + g.i AS INT), g.f FROM (VALUES """
    + ", ".join(f"({i}, '{c}')" for i, c in enumerate(S.GRAPH_FEATURES)) + ") g(i, f))")
