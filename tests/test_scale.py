"""Steps that the larger tables broke: what is read again, what is shuffled, what memory holds."""

import inspect
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from hubflow import schema as S
from hubflow.operators import features as FE
from hubflow.operators import ml as ML
from hubflow.operators import preprocess as PP
from hubflow.operators.graph import communities as CM
from hubflow.operators.graph import iterative as IT
from hubflow.operators.graph import paths as PT
from hubflow.operators import joins as J
from hubflow.operators.joins import enrich_graph
from hubflow.plans import production, q_features, q_graph, q_ml, q_monitor
from hubflow.plans.common import clean_frame, round_doubles
from hubflow.sources import fixtures, store
from hubflow.functions.exprs import finite_or_null

SF0001 = "/root/testdata/sf0.001"


def test_hub_table_is_computed_once_and_broadcast(spark):
    hubs = fixtures.hub_table(spark, SF0001)
    assert not any("lineitem" in f for f in hubs.inputFiles())
    plan = enrich_graph(clean_frame(spark, SF0001), hubs)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin LeftOuter" not in plan


def test_split_keeps_only_what_training_reads(spark):
    train, _, art = q_ml.split_features(spark, SF0001)
    assert set(train.columns) == {*q_ml.KEEP, "split", *art.feature_columns}
    assert not any("lineitem" in f for f in train.inputFiles())
    assert q_ml.fitted(spark, SF0001)[0] == art


def test_rounding_and_folding_keep_their_values(spark):
    values = [0.0, -0.0, 1.0, -3.0, 1.23456789, -2.5e-7, 5e-7, 1e300, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    same = lambda a, b: str(a) == str(b)  # noqa: E731 (tells -0.0 from 0.0, and NaN is itself)
    got, want = round_doubles(df).collect(), df.select(F.round("x", 6).alias("x")).collect()
    assert all(same(a["x"], b["x"]) for a, b in zip(got, want))
    folded = [r["y"] for r in df.select(finite_or_null("x").alias("y")).collect()]
    assert all(same(y, x if x is not None and math.isfinite(x) else None) for x, y in zip(values, folded))


def test_segments_keep_their_plan(spark):
    """Line items are dealt out once whatever the size: no broadcast at small sizes, no sort at large ones, no join for the number of hubs."""
    plan = fixtures.segments(spark, SF0001)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ShuffledHashJoin") == 2
    assert not any(other in plan for other in ("SortMergeJoin", "BroadcastHashJoin", "BroadcastNestedLoopJoin"))


def test_rounding_leaves_decimal_arithmetic_to_ties(spark):
    rnd = random.Random(7)
    values = [rnd.uniform(-1, 1) * 10 ** rnd.randrange(-9, 18) for _ in range(4000)]
    values += [sign * (n + half) * 1e-6 for n in (0, 1, 2, 7, 12345, 999999, 10 ** 11) for half in (0.4989, 0.499, 0.4999999, 0.5, 0.5000001, 0.501) for sign in (1, -1)]
    values += [sign * x for x in (1e6, 999999.999999, 1000000.0000005, 1e15, 4.9e-324, 1.005, 2.675, 1.0000005, 0.0000015) for sign in (1, -1)]
    df = spark.createDataFrame([*enumerate(values)], "i int, x double")
    got, want = round_doubles(df).orderBy("i"), df.select("i", F.round("x", 6).alias("x")).orderBy("i")
    assert [str(r["x"]) for r in got.collect()] == [str(r["x"]) for r in want.collect()]
    assert "* 1000000.0" in round_doubles(df)._jdf.queryExecution().optimizedPlan().toString()
    kinds = dict(round_doubles(spark.createDataFrame([(1.5, 2.25)], "f float, d double")).dtypes)
    assert kinds == {"f": "double", "d": "double"}


def test_fits_read_a_written_table(spark, monkeypatch):
    """What reads its rows several times reads Parquet of its own, not the segments again."""
    read, fit, types, limits = [], ML.train_eta, FE.route_type_values, PP.fit_preprocessor
    note = lambda df: read.append(any("lineitem" in f for f in df.inputFiles()))
    monkeypatch.setattr(ML, "train_eta", lambda df, *a, **b: (note(df), fit(df, *a, **b))[1])
    monkeypatch.setattr(FE, "route_type_values", lambda df, *a: (note(df), types(df, *a))[1])
    monkeypatch.setattr(PP, "fit_preprocessor", lambda df, *a: (note(df), limits(df, *a))[1])
    q_ml.q_smoke_train(spark, SF0001).collect()
    q_features.q_sanitize_global(spark, SF0001).collect()
    production.train_production(spark, clean_frame(spark, SF0001), None, q_ml.standin_tables(spark, SF0001), max_iter=1, max_depth=2)
    assert read == [False] * 6


def test_path_state_waits_on_disk(graph, monkeypatch):
    levels, cut = [], PT.cut_lineage
    monkeypatch.setattr(PT, "cut_lineage", lambda df, *level: (levels.append((df.columns, level)), cut(df, *level))[1])
    PT.betweenness(graph([("a", "b", 1), ("b", "c", 1)])).collect()
    state = [level for columns, level in levels if "data" in columns]
    assert state and all(level == (StorageLevel.DISK_ONLY,) for level in state)


def test_path_state_is_never_written(graph, monkeypatch):
    """Betweenness and closeness write their lanes; the distances from every hub to every hub stay in the tasks."""
    n, sizes, cut = 400, [], PT.cut_lineage
    lanes = graph([(f"h{i:03d}", f"h{(i + d) % n:03d}", 1 + i % 3) for i in range(n) for d in (1, 2)])
    monkeypatch.setattr(PT, "cut_lineage", lambda df, *level: (out := cut(df, *level), sizes.append(
        out.agg(F.sum(F.octet_length("data"))).first()[0] or 0 if "data" in out.columns else 0))[0])
    IT.betweenness(lanes, hubs_per_part=100).collect()
    IT.closeness(lanes, hubs_per_part=100).collect()
    assert 0 < sum(sizes) < n * n  # 16 to 32 bytes for each lane, not 8 for each pair of hubs


def test_lanes_are_mapped_part_by_part(monkeypatch):
    """Parts without lanes or hubs, several targets a part, one source with more lanes than are taken at a time."""
    monkeypatch.setattr(PT, "LANES_AT_ONCE", 3)
    lanes = PT.Lanes([(0, 3), (2, 1), (5, 4)])  # part 1 has no hubs; 8 hubs
    raw = lambda s, t, w: (np.array([s, t], "<i4").tobytes(), np.array(w, "<f8").tobytes())
    lanes.add(0, 5, *raw([1, 0, 1], [3, 0, 1], [0.5, 1.0, 2.0]))
    lanes.add(0, 0, *raw([1, 0], [2, 1], [0.25, 1.0]))
    lanes.add(5, 2, *raw([3], [0], [4.0]))
    lanes.finish()
    assert lanes.degree.tolist() == [2, 3, 0, 0, 0, 0, 0, 1] and lanes.target.tolist() == [4, 1, 7, 5, 2, 3]
    dist = PT.distances(lanes, np.array([0, 7])).reshape(2, 8)
    assert dist[0].tolist() == [0, 1, 1.25, 5.5, 1, 3, math.inf, 1.5] and dist[1].tolist() == [math.inf] * 3 + [4] + [math.inf] * 3 + [0]
    assert PT.dependencies(lanes, np.array([0, 7])).tolist() == [[0, 4, 0, 0, 0, 0, 0, 1], [0] * 8]


def test_loops_over_small_tables_start_few_tasks(spark, graph):
    lanes = graph([("a", "b", 3), ("b", "c", 3), ("c", "a", 3), ("c", "d", 1), ("d", "e", 3), ("e", "f", 3), ("f", "d", 3), ("g", "g", 1)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        found, ranks = CM.louvain(lanes), IT.pagerank(lanes)
        adj, strength = CM._split(lanes.select(F.col("u").alias("a"), F.col("v").alias("b"), F.col("weight").cast("double").alias("w")), 100)
        tables = [found, ranks, adj, strength, CM.first_rounds(lanes, 1)]
        assert all(t.rdd.getNumPartitions() <= 8 for t in tables)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {tuple(r) for r in found.collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "d"), ("f", "d"), ("g", "g")}
    assert abs(ranks.agg(F.sum("pagerank")).first()[0] - 1) < 1e-9


def test_pivots_that_cannot_be_enough_are_taken_in_one_batch(graph, monkeypatch):
    lanes = graph([(f"h{i:03d}", f"h{(i + d) % 300:03d}", 1 + i % 3) for i in range(300) for d in (1, 2)])
    asked, sums = [], PT.dependency_sums
    monkeypatch.setattr(PT, "dependency_sums", lambda net, sources, *lanes: (asked.append((net, sources)), sums(net, sources, *lanes))[1])
    found = PT.betweenness_by_pivots(lanes, error=0.9, first=8, hubs_per_part=50).collect()
    sizes = [s.count() for _, s in asked]
    # ln(3 * 300 * 7 / 0.05) * 3 / k is above 0.9 for k = 8, 16 and 32
    assert sizes[0] == 64 and {r["pivots"] for r in found} == {sum(sizes)}
    net, sources = asked[0]
    blocks = net.numbered(sources, 32).groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.max("column").alias("last")).collect()
    assert sorted((r["block"], r["n"], r["last"]) for r in blocks) == [(0, 32, 31), (1, 32, 31)]


def test_jobs_that_read_the_segments_often_read_written_lanes(spark, monkeypatch):
    """Staleness and load-or-build run the segment scan once: coverage, hub tables and the rebuild read what it wrote."""
    read = []
    hubs = spark.createDataFrame([("H000000",)], "hub_id string")
    monkeypatch.setattr(store, "load_or_build_graph", lambda spark, seg, **k: (read.append(seg), ({"pagerank": hubs}, "built"))[1])
    monkeypatch.setattr(q_ml, "standin_tables", lambda spark, sf, hubs=None: {k: spark.createDataFrame([], ", ".join(f"{c} string" for c in v)) for k, v in store.HUB_TABLES.items()})
    shown = q_ml.q_load_or_build_graph(spark, SF0001)
    q_monitor.q_graph_staleness(spark, SF0001)
    assert len(read) == 5 and not any("lineitem" in f for df in [*read, shown] for f in df.inputFiles())


def test_coverage_reads_its_rows_once(spark):
    rows = spark.createDataFrame([("a", "b"), ("b", None), (None, "c"), ("c", "c")], "source_center string, destination_center string")
    known = spark.createDataFrame([("a",), ("b",), ("b",), ("z",)], "hub_id string")
    found = J.hub_coverage(rows, known)
    assert found.first()["coverage"] == 0.5  # of a, b, c and the unnamed hub
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2


def test_pivots_query_takes_the_operators_error(spark, monkeypatch):
    """All hubs of a small network, as an error of 0.05 asks; with 0.7 some hundred pivots were enough for any."""
    lanes = spark.createDataFrame([(f"h{i:03d}", f"h{(i + 1) % 160:03d}", 1) for i in range(160)], "u string, v string, weight long")
    monkeypatch.setattr(q_graph, "graph_edges", lambda spark, sf: lanes.withColumn("dist", F.lit(1.0)))
    rows = q_graph.q_betweenness_pivots(spark, SF0001).collect()
    assert {(r["pivots"], r["error_bound"]) for r in rows} == {(160, 0.0)} and {r["betweenness_centrality"] for r in rows} == {0.5}


@pytest.mark.parametrize("run, fit, whole", [
    (q_ml.q_train_eta, "train_eta", dict(max_iter=S.GBT_PARAMS["maxIter"], max_depth=S.GBT_PARAMS["maxDepth"], step_size=S.GBT_PARAMS["stepSize"], subsample=S.GBT_PARAMS["subsamplingRate"])),
    (q_ml.q_model_forest, "model_forest", dict(num_trees=200, max_depth=14, min_leaf=5))])
def test_fits_have_the_operators_own_settings(spark, monkeypatch, run, fit, whole):
    """The queries fit as many and as deep trees as production does; the test then fits less."""
    real, asked = getattr(ML, fit), []

    def small(train, features, label=S.TARGET, **given):
        call = inspect.signature(real).bind(train, features, label, **given)
        call.apply_defaults()
        asked.append({k: call.arguments[k] for k in whole})
        return ML.model_linear(train, features, label)
    monkeypatch.setattr(ML, fit, small)
    assert run(spark, SF0001).count() == 1 and asked == [whole]
