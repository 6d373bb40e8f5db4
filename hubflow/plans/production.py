"""End-to-end compositions: processed build, training frame, production training, bundle scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hubflow import schema as S
from hubflow.operators import features as FE
from hubflow.operators import ml as ML
from hubflow.operators import preprocess as PP
from hubflow.operators.clean import add_trip_time_parts, clean_segments
from hubflow.operators.graph.bottleneck import hub_feature_table, lane_graph_tables
from hubflow.operators.graph.edges import lane_edges, with_flow_distance
from hubflow.operators.joins import enrich_graph
from hubflow.operators.score import predict_batch
from hubflow.session import written
from hubflow.sources import files, store


def build_processed(spark: SparkSession, raw_path: str, out_path: str) -> str:
    """Raw CSV -> cleaned, derived, projected Parquet (partitioned by route type)."""
    raw = files.load_csv(spark, raw_path)
    return files.write_processed(clean_segments(raw), out_path)


def graph_tables_for(processed: DataFrame, seed: int = S.SEED) -> dict:
    edges = written(with_flow_distance(lane_edges(processed)))
    return lane_graph_tables(edges, seed=seed)


def enriched_training(processed: DataFrame, tables: dict | None = None, graph_from: str = "all") -> tuple[DataFrame, dict]:
    """Calendar parts -> hub tables (built from all rows by default, or only training trips with
    ``graph_from='train'`` to keep test trips out of the graph features) -> enrich."""
    df = add_trip_time_parts(processed) if "trip_hour" not in processed.columns else processed
    if tables is None:
        src = ML.trip_split(df).filter(F.col("split") == "train") if graph_from == "train" else df
        tables = graph_tables_for(src)
    return enrich_graph(df, written(hub_feature_table(tables))), tables


def prepare_training(processed: DataFrame, tables: dict | None = None, graph_from: str = "all") -> tuple[DataFrame, dict]:
    """``enriched_training`` -> features."""
    df, tables = enriched_training(processed, tables, graph_from)
    return FE.build_ml_features(df, FE.route_type_values(processed)), tables


def train_production(spark: SparkSession, processed: DataFrame, bundle_path: str | None = None,
                     tables: dict | None = None, **gbt) -> dict:
    """Split by trip, fit the preprocessor on training rows, fit boosted trees, evaluate on the
    held-out trips, store the residual std in the artifact and (optionally) save the bundle."""
    df, tables = enriched_training(processed, tables)
    # written before the features: the route types, the fits and the evaluation read columns of this table, not the segments again
    read = {S.TARGET, "route_type", S.TRIP_ID, "split", *S.BASE_FEATURES, "trip_hour", "trip_dayofweek", *S.GRAPH_FEATURES}
    df = ML.trip_split(df)
    df = written(df.select(*[c for c in df.columns if c in read]))
    cats = FE.route_type_values(df)
    featured = FE.build_ml_features(df, cats)
    feats = FE.feature_list(cats)
    train = featured.filter(F.col("split") == "train")
    test = featured.filter(F.col("split") == "test")
    art = PP.fit_preprocessor(train, feats)
    keep = [S.TARGET, "route_type", S.TRIP_ID]
    model = ML.train_eta(PP.transform_features(train, art, keep), art.feature_columns, **gbt)
    pred = model.transform(PP.transform_features(test, art, keep))
    m = ML.regression_metrics(pred).first().asDict()
    art = art.with_scalars(residual_std=ML.residual_std(pred))
    metrics = {"MAE": m["MAE"], "RMSE": m["RMSE"], "R2": m["R2"], "train_rows": train.count(),
               "test_rows": m["n"], "n_features": len(art.feature_columns)}
    if bundle_path:
        store.save_bundle(spark, bundle_path, model, art, tables, metrics)
    return {"model": model, "preprocessor": art, "graph_tables": tables, "metrics": metrics}


def score_with_bundle(spark: SparkSession, requests: DataFrame, bundle: dict) -> DataFrame:
    hubs = hub_feature_table(bundle["graph_tables"])
    return predict_batch(requests, bundle["model"], bundle["preprocessor"], hubs)
