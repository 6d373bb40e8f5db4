"""Published hub tables, the stream on them, the training path and explanations."""

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from hubflow.operators import explain as EX
from hubflow.operators import ml as ML
from hubflow.plans import production
from hubflow.sources import files, store
from hubflow.streaming import scoring as ST

SF = "/root/testdata/sf0.001"


def hub_tables(spark, n):
    h = spark.range(n).select(F.concat(F.lit("h"), F.col("id")).alias("hub_id"), (F.col("id") * 1.0).alias("x"), F.lit(1).alias("one"))
    return {"pagerank": h.select("hub_id", F.col("x").alias("pagerank")), "degree": h.select("hub_id", F.col("x").alias("degree_centrality")),
            "bottleneck": h.select("hub_id", F.col("x").alias("bottleneck_score"), F.col("x").alias("betweenness_centrality"), F.col("one").cast("long").alias("traffic_volume")),
            "communities": h.select("hub_id", F.col("one").alias("community_id"), F.col("one").alias("community_size"))}


def test_versions_commit_last(spark):
    path = files.scratch_path(spark, "test-hubs")
    with pytest.raises(FileNotFoundError):
        store.load_graph_tables(spark, path)
    assert store.publish_graph_tables(spark, hub_tables(spark, 3), path) == 1
    pinned = store.load_graph_tables(spark, path, 1)
    broken = hub_tables(spark, 5)
    broken["communities"] = broken["communities"].withColumn("community_id", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        store.publish_graph_tables(spark, broken, path)  # three tables were written, the fourth was not
    assert [m["version"] for m in store.graph_versions(spark, path)] == [1]
    assert store.load_graph_tables(spark, path)["pagerank"].count() == 3
    assert store.publish_graph_tables(spark, hub_tables(spark, 4), path) == 2
    assert store.load_graph_tables(spark, path)["pagerank"].count() == 4 and pinned["pagerank"].count() == 3
    with pytest.raises(FileNotFoundError):
        store.load_graph_tables(spark, path, 9)


def test_two_writers_of_one_version(spark, monkeypatch):
    path = files.scratch_path(spark, "test-race")
    store.publish_graph_tables(spark, hub_tables(spark, 2), path)
    seen = store.graph_versions(spark, path)
    answers = [[], seen]  # the first look is older than the other writer's commit
    monkeypatch.setattr(store, "graph_versions", lambda s, p: answers.pop(0))
    assert store.publish_graph_tables(spark, hub_tables(spark, 3), path) == 2
    monkeypatch.undo()
    assert [m["version"] for m in store.graph_versions(spark, path)] == [1, 2]


def test_stream_keeps_its_version_and_replays_batches(spark):
    from hubflow.plans.q_ml import split_features, standin_model, standin_tables
    from hubflow.plans.q_monitor import _request_files
    home, out, ck = (files.scratch_path(spark, f"test-{x}") for x in ("hubs", "out", "ck"))
    tables = standin_tables(spark, SF)
    store.publish_graph_tables(spark, tables, home)
    _, _, art = split_features(spark, SF)
    read = lambda: ST.read_requests(spark, _request_files(spark, SF))
    assert ST.run_scored(read(), standin_model(), art, home, out, ck, ["request_id", "predicted_eta"]) == 1
    first = sorted(map(tuple, files.load_parquet(spark, out).select("request_id", "predicted_eta").collect()))
    store.publish_graph_tables(spark, {k: v.limit(0) for k, v in tables.items()}, home)
    assert ST.pinned_version(spark, home, ck) == 1 and ST.pinned_version(spark, home, files.scratch_path(spark, "test-ck2")) == 2
    again = files.load_parquet(spark, out).filter("batch = 0").drop("batch").persist()
    assert again.count()
    ST.write_batch(again, out, 0)  # the batch is delivered a second time
    assert sorted(map(tuple, files.load_parquet(spark, out).select("request_id", "predicted_eta").collect())) == first


def test_test_trips_leave_the_training_graph_alone(spark, monkeypatch):
    """With graph_from='train' no change of a test trip reaches a hub feature; with 'all' it does."""
    from hubflow.plans.common import clean_frame
    from hubflow.operators.graph import edges as G
    monkeypatch.setattr(production, "graph_tables_for", lambda df: {"traffic": G.traffic_volume(G.lane_edges(df))})
    monkeypatch.setattr(production, "hub_feature_table", lambda t: t["traffic"].select(
        "hub_id", F.col("traffic_volume").cast("double").alias("pagerank"), F.lit(1.0).alias("degree_centrality"), F.lit(0.5).alias("bottleneck_score"), F.lit(1).alias("community_id")))
    seg = clean_frame(spark, SF).persist()
    held = ML.trip_split(seg).filter("split = 'test'").select("trip_uuid").distinct()
    extra = seg.join(held, "trip_uuid", "left_semi").select(seg.columns)
    more = seg.unionByName(extra)  # the test trips run twice
    features = lambda df, how: {tuple(r) for r in production.prepare_training(df, graph_from=how)[0].select("source_center", "source_pagerank").distinct().collect()}
    assert features(seg, "train") == features(more, "train")
    assert features(seg, "all") != features(more, "all")


def brute_shapley(x, nodes):
    """Contributions by the definition: all subsets of features."""
    from itertools import combinations
    from math import factorial
    by = {}
    for r in nodes:
        by.setdefault(r["tree"], {})[r["id"]] = r

    def value(tree, known, at=0):
        n = tree[at]
        if n["left"] < 0:
            return n["weight"] * n["value"]
        a, b = tree[n["left"]], tree[n["right"]]
        if n["feature"] in known:
            return value(tree, known, n["left"] if x[n["feature"]] <= n["bounds"][0] else n["right"])
        return (a["rows"] * value(tree, known, n["left"]) + b["rows"] * value(tree, known, n["right"])) / n["rows"]
    whole = lambda s: sum(value(t, s) for t in by.values())
    m = len(x)
    out = []
    for i in range(m):
        rest = [j for j in range(m) if j != i]
        out.append(sum(factorial(k) * factorial(m - k - 1) / factorial(m) * (whole({*s, i}) - whole(set(s))) for k in range(m) for s in combinations(rest, k)))
    return whole(set()), out


def test_contributions_equal_the_definition(spark):
    rng = np.random.default_rng(3)
    x = rng.random((400, 4))
    y = 3 * x[:, 0] + x[:, 1] * x[:, 2] * 5 + (x[:, 3] > 0.5)
    rows = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "key long, a double, b double, c double, d double, actual_time double")
    names = ["a", "b", "c", "d"]
    model = ML.train_generic(rows, names, GBTRegressor(featuresCol="features", labelCol="actual_time", maxIter=4, maxDepth=4, seed=1))
    nodes = EX.tree_nodes(model, spark).collect()
    got = {r["key"]: r for r in EX.explain_rows(model, rows, names, "key").collect()}
    predicted = {r["key"]: r["prediction"] for r in model.transform(rows).collect()}
    for key in (0, 7, 123):
        base, want = brute_shapley(x[key], nodes)
        assert got[key]["base"] == pytest.approx(base) and got[key]["contributions"] == pytest.approx(want, abs=1e-9)
    assert all(r["base"] + sum(r["contributions"]) == pytest.approx(predicted[k], abs=1e-9) for k, r in got.items())
    gains = EX.gain_importance(model, [*names[:3], "source_pagerank"], spark).collect()
    assert sum(r["importance"] for r in gains) == pytest.approx(1) and gains[0]["importance"] >= gains[-1]["importance"]
    assert {r["feature"]: r["is_graph_feature"] for r in gains}["source_pagerank"]


def test_permuted_columns_keep_their_values(spark):
    df = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2.0).alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    got = ML.permuted_columns(df, ["a", "b"], "k", buckets=3).collect()
    assert sorted(r["a_permuted"] for r in got) == sorted(r["a"] for r in got) and sum(r["a"] != r["a_permuted"] for r in got) > 40
    assert all(r["b_permuted"] == (r["a_permuted"] / 2) % 7 for r in got)
