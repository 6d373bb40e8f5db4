"""Hand-sized graphs with known answers (FIXTURES.md §3)."""

import heapq
import math
import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from hubflow.operators.graph import communities as CM
from hubflow.operators.graph import edges as G
from hubflow.operators.graph import iterative as IT
from hubflow.operators.graph import paths as PT

PATH4 = [("a", "b", 1), ("b", "c", 1), ("c", "d", 1)]
STAR = [("c", f"x{i}", 1) for i in range(1, 5)] + [(f"x{i}", "c", 1) for i in range(1, 5)]
CYCLE3 = [("a", "b", 1), ("b", "c", 1), ("c", "a", 1)]
DANGLING = [("a", "b", 1)]
SELFLOOP = [("a", "a", 2), ("a", "b", 1)]
DISCONNECTED = [("a", "b", 1), ("c", "d", 1)]


def _k4(prefix, w):
    n = [f"{prefix}{i}" for i in range(4)]
    return [(x, y, w) for x in n for y in n if x != y]


# both cliques and the bridge carry traffic in both directions
TWO_CLIQUES = _k4("p", 5) + _k4("q", 5) + [("p0", "q0", 1), ("q0", "p0", 1)]


def as_map(df, key, val):
    return {r[key]: r[val] for r in df.collect()}


def test_betweenness_path(graph):
    b = as_map(IT.betweenness(graph(PATH4)), "hub_id", "betweenness_centrality")
    assert b["b"] == pytest.approx(2 / 6) and b["c"] == pytest.approx(2 / 6)
    assert b["a"] == 0 and b["d"] == 0


def test_betweenness_star(graph):
    b = as_map(IT.betweenness(graph(STAR)), "hub_id", "betweenness_centrality")
    assert b["c"] == pytest.approx(1.0)
    assert all(b[f"x{i}"] == 0 for i in range(1, 5))


def test_betweenness_counts_equal_paths(graph):
    # two equal shortest routes a->b->d and a->c->d: b and c each carry half of the a-d pair
    b = as_map(IT.betweenness(graph([("a", "b", 1), ("b", "d", 1), ("a", "c", 1), ("c", "d", 1)]), normalized=False),
               "hub_id", "betweenness_centrality")
    assert b["b"] == pytest.approx(0.5) and b["c"] == pytest.approx(0.5)


@pytest.mark.parametrize("per_part", [1, 256])
def test_betweenness_ties_of_unequal_hops(graph, per_part):
    # 1/3 + 1/6 == 1/2: c carries half of a-d; three hops of 1/3 tie with one of 1
    b = as_map(IT.betweenness(graph([("a", "d", 2), ("a", "c", 3), ("c", "d", 6)]), normalized=False, hubs_per_part=per_part), "hub_id", "betweenness_centrality")
    assert b["c"] == pytest.approx(0.5)
    b = as_map(IT.betweenness(graph([("a", "d", 1), ("a", "b", 3), ("b", "c", 3), ("c", "d", 3)]), normalized=False, hubs_per_part=per_part),
               "hub_id", "betweenness_centrality")
    # b: half of a-d, all of a-c; c: half of a-d, all of b-d
    assert b["b"] == pytest.approx(1.5) and b["c"] == pytest.approx(1.5)


def test_lengths_of_heavy_lanes_stay_apart(graph):
    d = as_map(graph([("a", "b", 70_000), ("b", "c", 70_001), ("c", "d", 3_000_000_000)]), "u", "dist")
    assert len(set(d.values())) == 3 and min(d.values()) > 0


def test_star_components(spark):
    from hubflow.operators.graph.contract import star_components
    edges = [(i, i + 1) for i in range(200)] + [(1000, k) for k in range(1001, 1400)] + [(5000, 5000), (7, 3), (None, 9)]
    got = {r["node"]: r["component"] for r in star_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1400)}, 5000: 5000}
    named = spark.createDataFrame([("b", "c"), ("c", "a"), ("x", "y")], "u string, v string")
    assert {r["node"]: r["component"] for r in star_components(named).collect()} == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}
    assert star_components(named.limit(0)).count() == 0


def test_degree_star_and_selfloop(graph):
    d = as_map(G.degree_centrality(graph(STAR)), "hub_id", "degree_centrality")
    assert d["c"] == pytest.approx(2.0)
    s = as_map(G.degree_centrality(graph(SELFLOOP)), "hub_id", "degree_centrality")
    assert s["a"] == pytest.approx(3.0)


def test_traffic_selfloop(graph):
    t = as_map(G.traffic_volume(graph(SELFLOOP)), "hub_id", "traffic_volume")
    assert t["a"] == 5 and t["b"] == 1


def test_heavy_hubs_are_split_over_mirrors(graph):
    edges = [("hot", f"x{i}", 1 + i % 3) for i in range(300)] + [(f"x{i}", "hot", 1) for i in range(300)] + random_lanes(50, 100, 3)
    e = graph(edges)
    split, copies = G.mirrors(e, "u", "v", 20)
    assert as_map(copies, "u", "mirrors")["hot"] == 15
    most = split.repartition("u", "mirror").groupBy("u", "mirror").count().agg(F.max("count")).first()[0]
    assert most < 60 and split.count() == e.count()  # no mirror holds more than a small part of the 300 lanes
    a, b = (as_map(IT.pagerank(e, heavy=k, iterations=2), "hub_id", "pagerank") for k in (20, 10**6))
    assert a == pytest.approx(b)
    c, d = (as_map(CM.first_rounds(e, 2, heavy=k), "hub_id", "community") for k in (20, 10**6))
    assert c == d


def test_communities_are_connected(graph):
    # two pairs that only a hub of another community joins
    e = graph(TWO_CLIQUES)
    und = G.undirected_projection(e).select("a", "b", F.col("weight").cast("double").alias("w"))
    comm = G.vertices(e).select(F.col("hub_id").alias("i"), F.when(F.col("hub_id").isin("p0", "q0"), F.lit("m")).otherwise(F.lit("z")).alias("c"))
    got = as_map(CM._connected(und, comm), "i", "c")
    assert got == {"p0": "p0", "q0": "p0", **{f"p{i}": "p1" for i in (1, 2, 3)}, **{f"q{i}": "q1" for i in (1, 2, 3)}}


def test_pagerank_cycle_and_dangling(graph):
    p = as_map(IT.pagerank(graph(CYCLE3)), "hub_id", "pagerank")
    assert all(v == pytest.approx(1 / 3, abs=1e-6) for v in p.values())
    q = as_map(IT.pagerank(graph(DANGLING)), "hub_id", "pagerank")
    assert sum(q.values()) == pytest.approx(1.0, abs=1e-9)
    assert q["b"] > q["a"]


def test_dag(graph):
    assert IT.is_dag(graph(PATH4))
    assert not IT.is_dag(graph(CYCLE3))
    assert not IT.is_dag(graph(SELFLOOP))
    # the cycle lies behind sources, before sinks, and between hubs with several lanes
    assert not IT.is_dag(graph([("s", "a", 1), ("a", "b", 1), ("b", "c", 1), ("c", "a", 1), ("c", "t", 1), ("s", "b", 1), ("a", "c", 1)]))
    rnd = random.Random(2)
    order = [(f"h{i:02d}", f"h{j:02d}", 1) for i in range(30) for j in rnd.sample(range(i + 1, 31), min(3, 30 - i))]
    assert IT.is_dag(graph(order)) and not IT.is_dag(graph([*order, ("h29", "h03", 1)]))


def test_dag_of_a_long_chain(spark):
    chain = spark.range(100_000).select(F.col("id").cast("string").alias("u"), (F.col("id") + 1).cast("string").alias("v"))
    assert IT.is_dag(chain)
    assert not IT.is_dag(chain.union(spark.createDataFrame([("100000", "70000")], "u string, v string")))


def test_components_and_closeness(graph):
    c = as_map(IT.connected_components(graph(DISCONNECTED)), "hub_id", "component")
    assert c == {"a": "a", "b": "a", "c": "c", "d": "c"}
    cl = as_map(IT.closeness(graph(DISCONNECTED)), "hub_id", "closeness_centrality")
    # largest component ties on size -> the one with the smallest id; the rest is null
    assert cl["a"] == pytest.approx(1.0) and cl["b"] == pytest.approx(1.0)
    assert cl["c"] is None and cl["d"] is None


def test_communities_two_cliques(graph):
    e = graph(TWO_CLIQUES)
    mem = CM.louvain(e)
    tab = as_map(CM.community_table(mem), "hub_id", "community_id")
    assert len(set(tab.values())) == 2
    assert len({tab[f"p{i}"] for i in range(4)}) == 1 and len({tab[f"q{i}"] for i in range(4)}) == 1
    q = CM.modularity(e, mem)
    single = CM.modularity(e, mem.withColumn("community", F.lit("x")))
    assert q > single
    # bridge ends carry the most betweenness
    b = as_map(IT.betweenness(e), "hub_id", "betweenness_centrality")
    top2 = sorted(b, key=lambda h: -b[h])[:2]
    assert set(top2) == {"p0", "q0"}


def test_modularity_beats_baselines(spark):
    from hubflow.plans.q_graph import graph_edges
    e = graph_edges(spark, "/root/testdata/sf0.001")
    lv = CM.louvain(e)
    ids = [r["hub_id"] for r in lv.collect()]
    assert len(ids) == len(set(ids))                      # a partition: every hub exactly once
    q = CM.modularity(e, lv)
    assert q >= CM.modularity(e, CM.label_propagation(e)) - 1e-9
    assert q >= CM.modularity(e, IT.connected_components(e), "component") - 1e-9
    assert not math.isnan(q)


def exact_betweenness(edges):
    """Brandes on exact fractions."""
    best = {}
    for u, v, w in edges:
        if u != v:
            best[u, v] = min(best.get((u, v), Fraction(2)), Fraction(1, max(w, 1)))
    hubs = sorted({h for u, v, _ in edges for h in (u, v)})
    out = defaultdict(list)
    for (u, v), d in best.items():
        out[u].append((v, d))
    score = dict.fromkeys(hubs, 0.0)
    for s in hubs:
        dist, count, before, order, done, heap = {s: Fraction(0)}, {s: 1}, {s: []}, [], set(), [(Fraction(0), s)]
        while heap:
            d, x = heapq.heappop(heap)
            if x in done:
                continue
            done.add(x)
            order.append(x)
            for y, w in out[x]:
                if y not in dist or d + w < dist[y]:
                    dist[y], count[y], before[y] = d + w, count[x], [x]
                    heapq.heappush(heap, (d + w, y))
                elif d + w == dist[y]:
                    count[y] += count[x]
                    before[y].append(x)
        dep = dict.fromkeys(order, 0.0)
        for w in reversed(order):
            for v in before[w]:
                dep[v] += count[v] * (1 + dep[w]) / count[w]
            if w != s:
                score[w] += dep[w]
    return score


def random_lanes(hubs, lanes, seed, weights=(1, 1, 2, 3, 6)):
    rnd = random.Random(seed)
    return [(u, v, w) for (u, v), w in {(f"h{rnd.randrange(hubs):03d}", f"h{rnd.randrange(hubs):03d}"): rnd.choice(weights) for _ in range(lanes)}.items()]


@pytest.mark.parametrize("edges, per_part", [(STAR, 2), (TWO_CLIQUES, 3), (random_lanes(40, 160, 1), 6), (random_lanes(60, 120, 2), 256),
                                             ([(f"h{i:03d}", f"h{(i + k) % 90:03d}", 90 + i % 7) for i in range(90) for k in (1, 2, 3)] + [("h010", "h050", 1)], 30)])
def test_betweenness_of_any_parts_equals_exact(graph, monkeypatch, edges, per_part):
    monkeypatch.setattr(PT, "LANES_AT_ONCE", 7)
    got = as_map(IT.betweenness(graph(edges), normalized=False, hubs_per_part=per_part), "hub_id", "betweenness_centrality")
    want = exact_betweenness(edges)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_betweenness_in_waves(graph, monkeypatch):
    edges = random_lanes(50, 200, 5)
    monkeypatch.setattr(PT, "STATE_VALUES", 50 * 128 * 2)  # two blocks at a time
    got = as_map(IT.betweenness(graph(edges), normalized=False, hubs_per_part=9), "hub_id", "betweenness_centrality")
    assert got == pytest.approx(exact_betweenness(edges), abs=1e-9)


def test_backward_ties_between_a_long_and_a_short_lane(graph):
    # both lanes of a lie on shortest paths; their heads' distances differ by far more than the tie tolerance of the sum
    edges = [("s", "a", 20), ("a", "far", 1), ("a", "near", 110), ("near", "x", 90), ("far", "y", 50)]
    got = as_map(IT.betweenness(graph(edges), normalized=False), "hub_id", "betweenness_centrality")
    assert got == pytest.approx(exact_betweenness(edges), abs=1e-9)


def test_pivots_keep_their_error(graph):
    edges = random_lanes(120, 700, 8)
    n = len({h for u, v, _ in edges for h in (u, v)})
    want = {h: x / ((n - 1) * (n - 2)) for h, x in exact_betweenness(edges).items()}
    rows = PT.betweenness_by_pivots(graph(edges), error=0.9, first=32).collect()
    assert {r["hub_id"] for r in rows} == set(want) and 0 < rows[0]["pivots"] < n
    assert all(abs(r["betweenness_centrality"] - want[r["hub_id"]]) <= r["error_bound"] <= 0.9 for r in rows)
    every = PT.betweenness_by_pivots(graph(edges), error=0.0, first=100).collect()  # all sources: exact
    assert all(r["pivots"] == n and r["error_bound"] == 0 and r["betweenness_centrality"] == pytest.approx(want[r["hub_id"]], abs=1e-9) for r in every)


def test_closeness_of_any_parts(graph):
    edges = random_lanes(40, 90, 4)
    a, b = (as_map(IT.closeness(graph(edges), hubs_per_part=k), "hub_id", "closeness_centrality") for k in (5, 256))
    weight = defaultdict(int)
    for u, v, w in edges:
        weight[min(u, v), max(u, v)] += w
    hubs = sorted({h for e in weight for h in e})
    d = {(x, y): 0 if x == y else math.inf for x in hubs for y in hubs}
    for (x, y), w in weight.items():
        if x != y:
            d[x, y] = d[y, x] = min(d[x, y], w)
    for k in hubs:
        for x in hubs:
            for y in hubs:
                d[x, y] = min(d[x, y], d[x, k] + d[k, y])
    big = max(({y for y in hubs if d[x, y] < math.inf} for x in hubs), key=lambda c: (len(c), [-ord(ch) for ch in min(c)]))
    for x in hubs:
        want = (len(big) - 1) / sum(d[x, y] for y in big) if x in big else None
        assert a[x] == b[x] == (pytest.approx(want) if want is not None else None)
