"""Registered queries: hub graph operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from hubflow.operators.graph import bottleneck as BN
from hubflow.operators.graph import communities as CM
from hubflow.operators.graph import edges as G
from hubflow.operators.graph import iterative as IT
from hubflow.operators.graph import paths as PT
from hubflow.plans.common import clean_frame, query, round_doubles
from hubflow.plans.oracle import oracle
from hubflow.session import written
from hubflow.sources import fixtures


def graph_edges(spark, sf):
    """Lane edge table (u, v, weight, avg_delay, flow_distance, dist), materialized once so the
    iterative jobs never re-run the segment scan."""
    return written(G.with_flow_distance(G.lane_edges(clean_frame(spark, sf))))


# oracle side: lane edges with length 1/weight, node set, both-direction adjacency
E_SQL = """e AS (SELECT source_center AS u, destination_center AS v, count(route_lane) AS weight,
  avg(segment_delay_ratio) AS avg_delay, 1.0 / CAST(greatest(count(route_lane), 1) AS DOUBLE) AS d
  FROM clean GROUP BY 1, 2)"""
NODES_SQL = "nodes AS (SELECT u AS h FROM e UNION SELECT v FROM e)"
TRAFFIC_SQL = """traffic AS (SELECT hub_id, CAST(sum(w) AS BIGINT) AS traffic_volume FROM
  (SELECT u AS hub_id, weight AS w FROM e UNION ALL SELECT v, weight FROM e) GROUP BY hub_id)"""
CC_SQL = """und AS (SELECT u AS a, v AS b FROM e WHERE u <> v UNION SELECT v, u FROM e WHERE u <> v),
reach(h, c) AS (SELECT h, h FROM nodes UNION SELECT und.b, reach.c FROM reach JOIN und ON und.a = reach.h),
cc AS (SELECT h AS hub_id, min(c) AS component FROM reach GROUP BY h)"""


def _minplus(prefix: str, base: str, rounds: int = 8) -> list[str]:
    """Shortest distances by repeated min-plus squaring (covers paths up to 2^rounds hops)."""
    ctes = [f"{prefix}0 AS MATERIALIZED ({base})"]
    for i in range(1, rounds + 1):
        p = f"{prefix}{i - 1}"
        ctes.append(f"""{prefix}{i} AS MATERIALIZED (SELECT u, v, min(d) AS d FROM (
  SELECT u, v, d FROM {p} UNION ALL SELECT a.u, b.v, a.d + b.d FROM {p} a JOIN {p} b ON a.v = b.u WHERE a.u <> b.v) z
  GROUP BY 1, 2)""")
    return ctes


def _pagerank_sql(rounds: int = 30) -> list[str]:
    """Rounds r1, r2, ...; ``pr`` is the first whose L1 change is below 1e-6 per hub (none: no rows)."""
    ctes = ["ow AS (SELECT u, sum(CAST(weight AS DOUBLE)) AS sw FROM e GROUP BY u)",
            "cnt AS (SELECT count(*) AS n FROM nodes)",
            "r0 AS MATERIALIZED (SELECT h, 1.0 / n AS r FROM nodes CROSS JOIN cnt)"]
    for i in range(1, rounds + 1):
        p = f"r{i - 1}"
        ctes.append(f"""r{i} AS MATERIALIZED (SELECT nd.h, 0.15 / n + 0.85 * (coalesce(x.s, 0)
  + (SELECT coalesce(sum(r), 0) FROM {p} WHERE h NOT IN (SELECT u FROM ow)) / n) AS r
  FROM nodes nd CROSS JOIN cnt LEFT JOIN (SELECT e.v, sum(p.r * (e.weight / ow.sw)) AS s
    FROM e JOIN {p} p ON p.h = e.u JOIN ow ON ow.u = e.u GROUP BY e.v) x ON x.v = nd.h)""")
    every = " UNION ALL ".join(f"SELECT {i} AS k, a.h, a.r, abs(a.r - b.r) AS d FROM r{i} a JOIN r{i - 1} b ON a.h = b.h" for i in range(1, rounds + 1))
    ctes.append(f"prk AS MATERIALIZED ({every})")
    ctes.append("""pr AS (SELECT h, r FROM prk WHERE k = (SELECT min(k) FROM (SELECT k, sum(d) AS e FROM prk GROUP BY k)
  WHERE e < 1e-6 * (SELECT n FROM cnt)))""")
    return ctes


@query("aggregate_lane_edges")
def q_aggregate_lane_edges(spark, sf):
    return round_doubles(G.aggregate_lane_edges(clean_frame(spark, sf)))


oracle("aggregate_lane_edges", """SELECT source_center, destination_center, count(route_lane) AS weight,
  round(avg(segment_delay_ratio), 6) AS avg_delay, round(avg(segment_actual_time), 6) AS avg_actual_time,
  round(avg(segment_osrm_time), 6) AS avg_osrm_time, min(source_name) AS source_name,
  min(destination_name) AS destination_name,
  array_to_string(list_slice(list_sort(list_distinct(list(route_type))), 1, 3), ',') AS route_types,
  source_center || ' → ' || destination_center AS route_lane FROM clean GROUP BY source_center, destination_center""")


@query("build_digraph")
def q_build_digraph(spark, sf):
    seg = fixtures.segments(spark, sf)
    g = G.build_digraph(seg, "source_center", "destination_center", weight="segment_osrm_time",
                        order_col="segment_key", attrs={"kind": "lane"})
    return round_doubles(g)


oracle("build_digraph", """SELECT source_center AS u, destination_center AS v,
  round(arg_max(segment_osrm_time, segment_key), 6) AS weight, 'lane' AS kind
  FROM segments WHERE source_center IS NOT NULL GROUP BY 1, 2""")


@query("flow_distance")
def q_flow_distance(spark, sf):
    return round_doubles(graph_edges(spark, sf).select("u", "v", "flow_distance"))


oracle("flow_distance", """SELECT u, v, round(1.0 / greatest(weight, 1), 6) AS flow_distance FROM e""", E_SQL)


@query("traffic_volume")
def q_traffic_volume(spark, sf):
    return G.traffic_volume(graph_edges(spark, sf))


oracle("traffic_volume", "SELECT * FROM traffic", E_SQL, TRAFFIC_SQL)


@query("degree_centrality")
def q_degree_centrality(spark, sf):
    return round_doubles(G.degree_centrality(graph_edges(spark, sf)))


DEG_SQL = """deg AS (SELECT hub_id, count(*) AS degree FROM (SELECT u AS hub_id FROM e UNION ALL SELECT v FROM e) GROUP BY 1)"""
oracle("degree_centrality", """SELECT hub_id, round(degree / ((SELECT count(*) FROM deg) - 1), 6) AS degree_centrality
  FROM deg""", E_SQL, DEG_SQL)


@query("high_degree_nodes")
def q_high_degree_nodes(spark, sf):
    return G.high_degree_nodes(graph_edges(spark, sf), 10)


oracle("high_degree_nodes", "SELECT hub_id, degree FROM deg ORDER BY degree DESC, hub_id LIMIT 10", E_SQL, DEG_SQL)


@query("undirected_projection")
def q_undirected_projection(spark, sf):
    return G.undirected_projection(graph_edges(spark, sf))


oracle("undirected_projection", """SELECT least(u, v) AS a, greatest(u, v) AS b, sum(weight) AS weight FROM e
  GROUP BY 1, 2""", E_SQL)


@query("route_importance")
def q_route_importance(spark, sf):
    return round_doubles(G.route_importance(G.aggregate_lane_edges(clean_frame(spark, sf)))
                         .select("route_lane", "weight", "avg_delay", "criticality", "rank_type"))


oracle("route_importance", """SELECT * FROM (
  (SELECT route_lane, weight, round(avg_delay, 6) AS avg_delay, round(weight * avg_delay, 6) AS criticality,
    'busiest' AS rank_type FROM l ORDER BY weight DESC, route_lane LIMIT 15)
  UNION ALL (SELECT route_lane, weight, round(avg_delay, 6), round(weight * avg_delay, 6), 'highest_delay'
    FROM l ORDER BY avg_delay DESC, route_lane LIMIT 15)
  UNION ALL (SELECT route_lane, weight, round(avg_delay, 6), round(weight * avg_delay, 6), 'critical'
    FROM l ORDER BY weight * avg_delay DESC, route_lane LIMIT 15))""",
       """l AS (SELECT source_center || ' → ' || destination_center AS route_lane, count(route_lane) AS weight,
  avg(segment_delay_ratio) AS avg_delay FROM clean GROUP BY source_center, destination_center)""")


@query("top_subgraph")
def q_top_subgraph(spark, sf):
    e = graph_edges(spark, sf)
    return G.top_subgraph(e, G.traffic_volume(e), 35, 80).select("u", "v", "weight")


oracle("top_subgraph", """SELECT u, v, weight FROM e WHERE u IN (SELECT h FROM keep) AND v IN (SELECT h FROM keep)""",
       E_SQL, TRAFFIC_SQL, """heavy AS (SELECT u, v FROM e ORDER BY weight DESC, u, v LIMIT 80),
keep AS (SELECT h FROM (SELECT hub_id AS h FROM traffic ORDER BY traffic_volume DESC, hub_id LIMIT 35)
  UNION SELECT u FROM heavy UNION SELECT v FROM heavy)""")


@query("mean_outgoing_delay")
def q_mean_outgoing_delay(spark, sf):
    return round_doubles(G.mean_outgoing_delay(graph_edges(spark, sf)))


oracle("mean_outgoing_delay", "SELECT u AS hub_id, round(avg(avg_delay), 6) AS mean_outgoing_delay FROM e GROUP BY u",
       E_SQL)


@query("minmax_scale")
def q_minmax_scale(spark, sf):
    e = graph_edges(spark, sf)
    return round_doubles(G.minmax_scale(G.traffic_volume(e), "traffic_volume", "scaled"))


oracle("minmax_scale", """SELECT hub_id, traffic_volume, round(CASE WHEN hi = lo THEN 0.0 ELSE (traffic_volume - lo) / (hi - lo) END, 6)
  AS scaled FROM traffic CROSS JOIN (SELECT min(traffic_volume) AS lo, max(traffic_volume) AS hi FROM traffic)""",
       E_SQL, TRAFFIC_SQL)


@query("pagerank")
def q_pagerank(spark, sf):
    return round_doubles(IT.pagerank(graph_edges(spark, sf)))


oracle("pagerank", "SELECT h AS hub_id, round(r, 6) AS pagerank FROM pr", E_SQL, NODES_SQL, *_pagerank_sql())


@query("connected_components")
def q_connected_components(spark, sf):
    return IT.connected_components(graph_edges(spark, sf))


oracle("connected_components", "SELECT * FROM cc", E_SQL, NODES_SQL, CC_SQL)


@query("is_dag")
def q_is_dag(spark, sf):
    return IT.is_dag_frame(graph_edges(spark, sf))


oracle("is_dag", """SELECT NOT EXISTS (SELECT 1 FROM e WHERE u = v)
  AND NOT EXISTS (SELECT 1 FROM e JOIN r ON r.s = e.v AND r.t = e.u) AS is_dag""", E_SQL,
       "r(s, t) AS (SELECT u, v FROM e UNION SELECT r.s, e.v FROM r JOIN e ON e.u = r.t)")


@query("graph_summary")
def q_graph_summary(spark, sf):
    return round_doubles(BN.graph_summary(graph_edges(spark, sf)))


oracle("graph_summary", """SELECT (SELECT count(*) FROM nodes) AS nodes, (SELECT count(*) FROM e) AS edges,
  round((SELECT count(*) FROM e) / ((SELECT count(*) FROM nodes) * ((SELECT count(*) FROM nodes) - 1)), 6) AS density,
  round(2.0 * (SELECT count(*) FROM e) / (SELECT count(*) FROM nodes), 2) AS avg_degree,
  (SELECT count(DISTINCT component) FROM cc) AS weakly_connected_components,
  (SELECT max(c) FROM (SELECT count(*) AS c FROM cc GROUP BY component)) AS largest_component_nodes,
  round((SELECT max(c) FROM (SELECT count(*) AS c FROM cc GROUP BY component)) * 100.0 / (SELECT count(*) FROM nodes), 2)
    AS largest_component_pct,
  NOT EXISTS (SELECT 1 FROM e WHERE u = v) AND NOT EXISTS (SELECT 1 FROM e JOIN r ON r.s = e.v AND r.t = e.u) AS is_dag""",
       E_SQL, NODES_SQL, CC_SQL, "r(s, t) AS (SELECT u, v FROM e UNION SELECT r.s, e.v FROM r JOIN e ON e.u = r.t)")

_BETWEEN = _minplus("dd", "SELECT u, v, d FROM e WHERE u <> v") + [
    """dag AS (SELECT s.u AS s, e.u AS x, e.v AS y
  FROM (SELECT u, v, d FROM dd8 UNION ALL SELECT DISTINCT u, u, 0.0 FROM e) s
  JOIN e ON e.u = s.v AND e.u <> e.v
  JOIN dd8 t ON t.u = s.u AND t.v = e.v AND abs(s.d + e.d - t.d) <= 1e-10 * t.d)""",
    """lv(s, y, c, l) AS (SELECT DISTINCT u, u, CAST(1 AS BIGINT), 0 FROM e
  UNION ALL SELECT dag.s, dag.y, CAST(sum(lv.c) AS BIGINT), any_value(lv.l) + 1
  FROM lv JOIN dag ON dag.s = lv.s AND dag.x = lv.y GROUP BY dag.s, dag.y)""",
    "sg AS (SELECT s, y, sum(c) AS c FROM lv GROUP BY 1, 2)",
    """rawb AS (SELECT v.v AS hub_id, sum(a.c * b.c * 1.0 / st.c) AS raw_betweenness
  FROM dd8 v JOIN dd8 t ON t.u = v.v AND t.v <> v.u
  JOIN dd8 g ON g.u = v.u AND g.v = t.v AND abs(g.d - (v.d + t.d)) <= 1e-10 * g.d
  JOIN sg a ON a.s = v.u AND a.y = v.v JOIN sg b ON b.s = v.v AND b.y = t.v
  JOIN sg st ON st.s = v.u AND st.y = t.v GROUP BY 1)""",
    """btw AS (SELECT nodes.h AS hub_id, coalesce(rawb.raw_betweenness, 0)
  / (((SELECT count(*) FROM nodes) - 1) * ((SELECT count(*) FROM nodes) - 2)) AS betweenness_centrality
  FROM nodes LEFT JOIN rawb ON rawb.hub_id = nodes.h)"""]


@query("betweenness")
def q_betweenness(spark, sf):
    return round_doubles(IT.betweenness(graph_edges(spark, sf)))


oracle("betweenness", "SELECT hub_id, round(betweenness_centrality, 6) AS betweenness_centrality FROM btw",
       E_SQL, NODES_SQL, *_BETWEEN)


@query("betweenness_pivots")
def q_betweenness_pivots(spark, sf):
    """Betweenness from seeded pivots, as many as the stopping rule takes for an error of 0.05, with its error bound."""
    return round_doubles(PT.betweenness_by_pivots(graph_edges(spark, sf)))


# the same pivots and the same rule: dependencies of each source, sums over the first 64, 128, 256 ... pivots
_LOOKS = 24
oracle("betweenness_pivots", """SELECT d.h AS hub_id, round(m * n / (n - 1), 6) AS betweenness_centrality, round(err * n / (n - 1), 6) AS error_bound, d.k AS pivots
  FROM bound d JOIN chosen ON d.k = chosen.k""", E_SQL, NODES_SQL, *_BETWEEN,
       """per AS (SELECT v.u AS s, v.v AS h, sum(a.c * b.c * 1.0 / st.c) AS dep
  FROM dd8 v JOIN dd8 t ON t.u = v.v AND t.v <> v.u JOIN dd8 g ON g.u = v.u AND g.v = t.v AND abs(g.d - (v.d + t.d)) <= 1e-10 * g.d
  JOIN sg a ON a.s = v.u AND a.y = v.v JOIN sg b ON b.s = v.v AND b.y = t.v JOIN sg st ON st.s = v.u AND st.y = t.v GROUP BY 1, 2)""",
       "size AS (SELECT count(*) AS n FROM nodes)",
       "drawn AS (SELECT h AS s, row_number() OVER (ORDER BY md5('42:' || h), h) AS r FROM nodes)",
       f"look AS (SELECT DISTINCT CAST(least(64 * pow(2, i), n) AS BIGINT) AS k, n FROM range({_LOOKS}) t(i), size)",
       """moment AS (SELECT look.k, any_value(look.n) AS n, nodes.h, coalesce(sum(dep), 0) / (look.k * (any_value(look.n) - 2.0)) AS m,
  coalesce(sum(dep * dep), 0) / (look.k * pow(any_value(look.n) - 2.0, 2)) AS m2
  FROM look CROSS JOIN nodes JOIN drawn ON drawn.r <= look.k LEFT JOIN per ON per.s = drawn.s AND per.h = nodes.h GROUP BY look.k, nodes.h)""",
       """bound AS (SELECT *, CASE WHEN k >= n THEN 0.0 ELSE sqrt(2 * greatest(0, m2 - m * m) * lg / k) + 3 * lg / k END AS err
  FROM (SELECT *, ln(3.0 * n * greatest(1, ceil(log2(greatest(1, n / 64.0))) + 1) / 0.05) AS lg FROM moment))""",
       "chosen AS (SELECT min(k) AS k FROM (SELECT k, n, max(err * n / (n - 1)) AS worst FROM bound GROUP BY k, n) WHERE worst <= 0.05 OR k >= n)")


@query("bottleneck_prod")
def q_bottleneck_prod(spark, sf):
    e = graph_edges(spark, sf)
    return round_doubles(BN.bottleneck_prod(IT.betweenness(e), G.traffic_volume(e)))


oracle("bottleneck_prod", """SELECT b.hub_id, round(0.6 * (betweenness_centrality - lb) / (hb - lb + 1e-9)
  + 0.4 * (traffic_volume - lt) / (ht - lt + 1e-9), 6) AS bottleneck_score,
  round(betweenness_centrality, 6) AS betweenness_centrality, traffic_volume
  FROM btw b JOIN traffic t ON t.hub_id = b.hub_id CROSS JOIN (SELECT min(betweenness_centrality) AS lb,
  max(betweenness_centrality) AS hb FROM btw) CROSS JOIN (SELECT min(traffic_volume) AS lt, max(traffic_volume) AS ht FROM traffic)""",
       E_SQL, NODES_SQL, TRAFFIC_SQL, *_BETWEEN)


@query("bottleneck_analyst")
def q_bottleneck_analyst(spark, sf):
    e = graph_edges(spark, sf)
    out = BN.bottleneck_analyst(IT.betweenness(e), G.traffic_volume(e), e)
    return round_doubles(out.select("hub_id", "mean_outgoing_delay", "score_betweenness", "score_traffic",
                                    "score_delay", "bottleneck_score"))


oracle("bottleneck_analyst", """SELECT hub_id, round(mod_, 6) AS mean_outgoing_delay, round(sb, 6) AS score_betweenness,
  round(st, 6) AS score_traffic, round(sd, 6) AS score_delay, round(0.45 * sb + 0.35 * st + 0.20 * sd, 6) AS bottleneck_score
  FROM (SELECT hub_id, mod_,
    CASE WHEN max(bc) OVER () = min(bc) OVER () THEN 0.0 ELSE (bc - min(bc) OVER ()) / (max(bc) OVER () - min(bc) OVER ()) END AS sb,
    CASE WHEN max(tv) OVER () = min(tv) OVER () THEN 0.0 ELSE (tv - min(tv) OVER ()) / (max(tv) OVER () - min(tv) OVER ()) END AS st,
    CASE WHEN max(dl) OVER () = min(dl) OVER () THEN 0.0 ELSE (dl - min(dl) OVER ()) / (max(dl) OVER () - min(dl) OVER ()) END AS sd
  FROM (SELECT b.hub_id, b.betweenness_centrality AS bc, t.traffic_volume AS tv, o.m AS mod_,
      coalesce(o.m, (SELECT median(m) FROM od)) AS dl
    FROM btw b LEFT JOIN traffic t ON t.hub_id = b.hub_id LEFT JOIN od o ON o.hub_id = b.hub_id))""",
       E_SQL, NODES_SQL, TRAFFIC_SQL, "od AS (SELECT u AS hub_id, avg(avg_delay) AS m FROM e GROUP BY u)", *_BETWEEN)


_CLOSE = [CC_SQL.replace("und AS", "und0 AS").replace("JOIN und ON und.a", "JOIN und0 ON und0.a").replace("und.b", "und0.b"),
          """big AS (SELECT hub_id FROM cc WHERE component = (SELECT component FROM cc GROUP BY component
  ORDER BY count(*) DESC, component LIMIT 1))""",
          """uw AS (SELECT least(u, v) AS a, greatest(u, v) AS b, sum(weight) AS w FROM e GROUP BY 1, 2)"""] + _minplus(
    "cd", """SELECT a AS u, b AS v, w AS d FROM uw WHERE a <> b AND a IN (SELECT hub_id FROM big) AND b IN (SELECT hub_id FROM big)
  UNION ALL SELECT b, a, w FROM uw WHERE a <> b AND a IN (SELECT hub_id FROM big) AND b IN (SELECT hub_id FROM big)""")


@query("closeness")
def q_closeness(spark, sf):
    return round_doubles(IT.closeness(graph_edges(spark, sf)))


oracle("closeness", """SELECT nodes.h AS hub_id, round(c.r * 1.0 / c.tot * (c.r * 1.0 / ((SELECT count(*) FROM big) - 1)), 6)
  AS closeness_centrality FROM nodes LEFT JOIN (SELECT u, count(*) AS r, sum(d) AS tot FROM cd8 WHERE u <> v GROUP BY u) c
  ON c.u = nodes.h""", E_SQL, NODES_SQL, *_CLOSE)


def hub_metrics(e):
    """One table of rankable hub metrics: pagerank, degree, betweenness, closeness (long form)."""
    found = {"pagerank": IT.pagerank(e).select("hub_id", F.col("pagerank").alias("value")),
             "degree": G.degree_centrality(e).select("hub_id", F.col("degree_centrality").alias("value")),
             "betweenness": IT.betweenness(e).select("hub_id", F.col("betweenness_centrality").alias("value")),
             "closeness": IT.closeness(e).select("hub_id", F.col("closeness_centrality").alias("value"))}
    # engines sum in different orders: values equal to nine digits tie, and the hub id decides
    return {name: df.withColumn("value", F.round("value", 9)).filter("value is not null") for name, df in found.items()}


@query("hub_rankings")
def q_hub_rankings(spark, sf):
    """The 50 first hubs of each metric (the analyst exports' length) with their traffic."""
    e = graph_edges(spark, sf)
    t = G.traffic_volume(e)
    out = None
    for name, df in hub_metrics(e).items():
        top = G.top_n(df, "value", 50).join(t, "hub_id", "left").select(F.lit(name).alias("metric"), "hub_id", "value", "traffic_volume")
        out = top if out is None else out.unionByName(top)
    return round_doubles(out)


_CLOSENESS = """cls AS (SELECT nodes.h AS hub_id, c.r * 1.0 / c.tot * (c.r * 1.0 / ((SELECT count(*) FROM big) - 1)) AS value
  FROM nodes JOIN (SELECT u, count(*) AS r, sum(d) AS tot FROM cd8 WHERE u <> v GROUP BY u) c ON c.u = nodes.h)"""
_RANKED = {"pagerank": "SELECT h AS hub_id, r AS value FROM pr", "degree": "SELECT hub_id, degree / ((SELECT count(*) FROM deg) - 1) AS value FROM deg",
           "betweenness": "SELECT hub_id, betweenness_centrality AS value FROM btw", "closeness": "SELECT * FROM cls"}
oracle("hub_rankings", "SELECT m.metric, m.hub_id, round(m.value, 6) AS value, t.traffic_volume FROM (" + " UNION ALL ".join(
    f"(SELECT '{name}' AS metric, hub_id, round(value, 9) AS value FROM ({body}) ORDER BY round(value, 9) DESC, hub_id LIMIT 50)"
    for name, body in _RANKED.items()) + ") m LEFT JOIN traffic t ON t.hub_id = m.hub_id",
       E_SQL, NODES_SQL, TRAFFIC_SQL, DEG_SQL, *_pagerank_sql(), *_BETWEEN, *_CLOSE, _CLOSENESS)


_ROUNDS = 3


@query("communities")
def q_communities(spark, sf):
    """A row per hub: its community after the first rounds of local moving (seeded, so any engine finds the same), and
    whether the finished partition has it in exactly one connected community and beats label propagation."""
    e = graph_edges(spark, sf)
    start = CM.first_rounds(e, _ROUNDS)
    done = written(CM.louvain(e))
    named = done.select("hub_id", "community")
    better = CM.modularity(e, named) >= CM.modularity(e, CM.label_propagation(e)) - 1e-9
    a, b = named.select(F.col("hub_id").alias("u"), F.col("community").alias("cu")), named.select(F.col("hub_id").alias("v"), F.col("community").alias("cv"))
    parts = IT.connected_components(e.join(a, "u").join(b, "v").filter("cu = cv"))
    whole = named.join(parts, "hub_id", "left").groupBy("community").agg((F.count_distinct(F.coalesce("component", "hub_id")) == 1).alias("connected"))
    per_hub = named.join(whole, "community").groupBy("hub_id").agg(F.count(F.lit(1)).alias("communities"), F.every("connected").alias("connected"))
    return start.join(per_hub, "hub_id", "left").select("hub_id", F.col("community").alias("first_community"), "communities", "connected",
                                                       F.lit(bool(better)).alias("beats_label_propagation"))


def _moving_sql(rounds: int, seed: int = 42) -> list[str]:
    """Local moving unrolled: m0 is every hub by itself, m1, m2 ... the communities after each round."""
    ctes = ["un AS MATERIALIZED (SELECT least(u, v) AS a, greatest(u, v) AS b, CAST(sum(weight) AS DOUBLE) AS w FROM e GROUP BY 1, 2)",
            "ad AS MATERIALIZED (SELECT a AS i, b AS j, w FROM un WHERE a <> b UNION ALL SELECT b, a, w FROM un WHERE a <> b)",
            "mm AS (SELECT sum(w) AS m FROM un)",
            "st AS MATERIALIZED (SELECT h AS i, coalesce(k1, 0) + 2 * coalesce(lw, 0) AS k FROM nodes LEFT JOIN (SELECT i, sum(w) AS k1 FROM ad GROUP BY i) ON i = h "
            "LEFT JOIN (SELECT a, w AS lw FROM un WHERE a = b) ON a = h)",
            "m0 AS MATERIALIZED (SELECT i, i AS c FROM st)"]
    for r in range(rounds):
        ctes += [f"tt{r} AS MATERIALIZED (SELECT c, sum(k) AS tot FROM m{r} JOIN st USING (i) GROUP BY c)",
                 f"kk{r} AS MATERIALIZED (SELECT ad.i, m{r}.c, sum(w) AS kin FROM ad JOIN m{r} ON m{r}.i = ad.j GROUP BY ALL)",
                 f"""gg{r} AS MATERIALIZED (SELECT o.i, o.c AS d, st.k, td.tot AS tot_d, kk.c, kk.kin, kk.kin / m - st.k * tc.tot / (2 * m * m) AS g
  FROM m{r} o JOIN st ON st.i = o.i JOIN tt{r} td ON td.c = o.c CROSS JOIN mm LEFT JOIN kk{r} kk ON kk.i = o.i LEFT JOIN tt{r} tc ON tc.c = kk.c)""",
                 f"""m{r + 1} AS MATERIALIZED (SELECT i, CASE WHEN g > stay + 1e-12 AND CAST('0x' || md5('{seed}:0:{r}:' || i)[1:8] AS BIGINT) % 2 = 0 THEN c ELSE d END AS c
  FROM (SELECT i, d, coalesce(max(kin) FILTER (c = d), 0) / any_value(m) - any_value(k) * (any_value(tot_d) - any_value(k)) / (2 * any_value(m) * any_value(m)) AS stay,
    max(g) FILTER (c <> d) AS g, min(c) FILTER (c <> d AND g = top) AS c
    FROM (SELECT *, max(g) FILTER (c <> d) OVER (PARTITION BY i) AS top FROM gg{r}) CROSS JOIN mm GROUP BY i, d))"""]
    return ctes


oracle("communities", f"""SELECT i AS hub_id, c AS first_community, 1 AS communities, true AS connected, true AS beats_label_propagation FROM m{_ROUNDS}""",
       E_SQL, NODES_SQL, *_moving_sql(_ROUNDS))


@query("community_summary")
def q_community_summary(spark, sf):
    """Totals of the summary and of the size histogram, which hold for any partition."""
    e = graph_edges(spark, sf)
    table = written(CM.community_table(CM.louvain(e)))
    s = CM.community_summary(table).agg(F.sum("hubs").alias("hubs"), F.min(F.size("sample_hubs") == F.least("hubs", F.lit(5))).alias("samples_full"),
                                        F.count(F.lit(1)).alias("n"))
    h = CM.community_size_histogram(table).agg(F.sum("count").alias("binned"), F.max("bin").alias("last"))
    return s.crossJoin(h).select("hubs", "samples_full", (F.col("binned") == F.col("n")).alias("histogram_counts_all"),
                                 (F.col("last") <= 30).alias("at_most_30_bins"))


oracle("community_summary", """SELECT (SELECT count(*) FROM nodes) AS hubs, true AS samples_full, true AS histogram_counts_all,
  true AS at_most_30_bins""", E_SQL, NODES_SQL)


@query("lane_graph_tables")
def q_lane_graph_tables(spark, sf):
    """Full hub feature store (pagerank, degree, bottleneck, community) as one wide table; the community number
    depends on the seed, so only its presence is compared."""
    wide = BN.hub_feature_table(BN.lane_graph_tables(graph_edges(spark, sf)))
    return round_doubles(wide.select("hub_id", "pagerank", "degree_centrality", "bottleneck_score", F.col("community_id").isNotNull().alias("has_community")))


oracle("lane_graph_tables", """SELECT b.hub_id, round(p.r, 6) AS pagerank, round(d.degree / ((SELECT count(*) FROM deg) - 1), 6) AS degree_centrality,
  round(0.6 * (betweenness_centrality - lb) / (hb - lb + 1e-9) + 0.4 * (traffic_volume - lt) / (ht - lt + 1e-9), 6) AS bottleneck_score,
  true AS has_community FROM btw b JOIN traffic t ON t.hub_id = b.hub_id JOIN pr p ON p.h = b.hub_id JOIN deg d ON d.hub_id = b.hub_id
  CROSS JOIN (SELECT min(betweenness_centrality) AS lb, max(betweenness_centrality) AS hb FROM btw)
  CROSS JOIN (SELECT min(traffic_volume) AS lt, max(traffic_volume) AS ht FROM traffic)""",
       E_SQL, NODES_SQL, TRAFFIC_SQL, DEG_SQL, *_pagerank_sql(), *_BETWEEN)
