"""Registered queries: batch scoring path, training/evaluation jobs, stores and sources
(SURVEY §2.A, §2.H, §2.I)."""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from hubflow import schema as S
from hubflow.operators import explain as EX
from hubflow.operators import features as FE
from hubflow.operators import ml as ML
from hubflow.operators import preprocess as PP
from hubflow.operators import score as SC
from hubflow.operators.clean import add_trip_time_parts, coerce_datetime
from hubflow.operators.joins import enrich_graph
from hubflow.plans.common import clean_frame, lane_frame, query, round_doubles
from hubflow.plans.oracle import HUBS, oracle
from hubflow.plans.q_eda import TIMES_SQL, shown_times
from hubflow.plans.q_features import ENR, FEAT
from hubflow.session import cut_lineage, written
from hubflow.sources import files, fixtures, store

CATS = ["Carting", "FTL"]
# small boosted-tree settings for the registered checks; production defaults live in schema.GBT_PARAMS
CHECK_GBT = dict(max_iter=20, max_depth=5)


def standin_model():
    """Closed-form stand-in regressor as a Spark ML transformer (serializable, no Python)."""
    return SQLTransformer(statement="SELECT *, osrm_time * 1.1 + segment_osrm_time AS prediction FROM __THIS__")


def standin_tables(spark, sf, hubs=None) -> dict:
    h = fixtures.hub_table(spark, sf) if hubs is None else hubs
    sizes = h.groupBy("community_id").agg(F.count(F.lit(1)).cast("int").alias("community_size"))
    return {"pagerank": h.select("hub_id", "pagerank"), "degree": h.select("hub_id", "degree_centrality"),
            "bottleneck": h.select("hub_id", "bottleneck_score", F.lit(0.0).alias("betweenness_centrality"),
                                   F.lit(0).cast("bigint").alias("traffic_volume")),
            "communities": h.select("hub_id", "community_id").join(sizes, "community_id")}


KEEP = [S.TARGET, "route_type", "segment_key", "trip_uuid"]


def _split_frame(spark, sf, hubs):
    df = add_trip_time_parts(clean_frame(spark, sf))
    feat = ML.trip_split(FE.build_ml_features(enrich_graph(df, hubs), CATS))
    return feat.select(*KEEP, "split", *FE.feature_list(CATS))


def split_features(spark, sf):
    """(train, test, artifact) on featured segments with the stand-in hub table."""
    feat = written(_split_frame(spark, sf, fixtures.hub_table(spark, sf)))
    train, test = feat.filter(F.col("split") == "train"), feat.filter(F.col("split") == "test")
    return train, test, PP.fit_preprocessor(train, FE.feature_list(CATS))


def fitted(spark, sf):
    """(artifact, stand-in hub table) for scoring: the training rows are read once, so they are not written."""
    hubs = fixtures.hub_table(spark, sf)
    train = _split_frame(spark, sf, hubs).filter(F.col("split") == "train")
    return PP.fit_preprocessor(train, FE.feature_list(CATS)), hubs


def matrices(spark, sf):
    train, test, art = split_features(spark, sf)
    keep = KEEP
    return PP.transform_features(train, art, keep), PP.transform_features(test, art, keep), art


# ---- scoring path with the stand-in model (exact oracle) --------------------------------------

def _scored_requests(spark, sf):
    art, hubs = fitted(spark, sf)
    return SC.predict_batch(fixtures.requests(spark, sf), standin_model(), art, hubs)


@query("predict_batch")
def q_predict_batch(spark, sf):
    out = _scored_requests(spark, sf)
    return round_doubles(out.select("request_id", "osrm_time", "predicted_eta", "eta_vs_osrm_ratio", "risk_level",
                                    "bottleneck_warning", "route_insights", "source_bottleneck_score",
                                    "destination_bottleneck_score", "confidence_low", "confidence_high"))


_FEAT_TR = """feat AS (SELECT e.*, s.bottleneck_score AS sb FROM (SELECT c.*, d.bottleneck_score AS db FROM clean c
  LEFT JOIN hubs d ON d.hub_id = c.destination_center) e LEFT JOIN hubs s ON s.hub_id = e.source_center),
tr AS (SELECT * FROM feat WHERE CAST('0x' || substr(md5(trip_uuid || '|42'), 1, 8) AS BIGINT) % 100 >= 20),
par AS (SELECT median(osrm_time / nullif(osrm_distance, 0)) AS mpk, median(osrm_time) AS m_ot,
  quantile_cont(osrm_time, 0.99) AS p_ot, median(segment_osrm_time) AS m_st, quantile_cont(segment_osrm_time, 0.99) AS p_st FROM tr),
req AS (SELECT event_id AS request_id, 'H' || lpad(CAST(user_id % n AS STRING), 6, '0') AS source_center,
  'H' || lpad(CAST((user_id + 1 + event_id % 5) % n AS STRING), 6, '0') AS destination_center, value AS osrm_distance
  FROM events CROSS JOIN (SELECT count(*) AS n FROM supplier) WHERE event_type = 'purchase'),
x AS (SELECT r.request_id, r.osrm_distance * par.mpk AS osrm_time,
  least(coalesce(r.osrm_distance * par.mpk, m_ot), p_ot) * 1.1 + least(coalesce(r.osrm_distance * par.mpk, m_st), p_st) AS predicted_eta,
  s.bottleneck_score AS source_bottleneck_score, d.bottleneck_score AS destination_bottleneck_score
  FROM req r CROSS JOIN par LEFT JOIN hubs s ON s.hub_id = r.source_center LEFT JOIN hubs d ON d.hub_id = r.destination_center),
y AS (SELECT *, greatest(coalesce(source_bottleneck_score, 0), coalesce(destination_bottleneck_score, 0)) AS mbn,
  coalesce(predicted_eta / nullif(osrm_time, 0), 1.0) AS ratio FROM x),
z AS (SELECT *, (CASE WHEN mbn >= 0.75 THEN 3 WHEN mbn >= 0.55 THEN 2 WHEN mbn >= 0.35 THEN 1 ELSE 0 END)
  + (CASE WHEN ratio >= 1.8 THEN 2 WHEN ratio >= 1.4 THEN 1 ELSE 0 END) AS pts FROM y)"""

oracle("predict_batch", """SELECT request_id, round(osrm_time, 6) AS osrm_time, round(predicted_eta, 6) AS predicted_eta,
  round(ratio, 6) AS eta_vs_osrm_ratio,
  CASE WHEN pts >= 4 THEN 'CRITICAL' WHEN pts >= 3 THEN 'HIGH' WHEN pts >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  mbn >= 0.35 AS bottleneck_warning,
  CASE WHEN mbn >= 0.35 AND ratio >= 1.5
       THEN 'Touches high-bottleneck hub; expect elevated dwell risk. Predicted ETA materially above OSRM baseline.'
       WHEN mbn >= 0.35 THEN 'Touches high-bottleneck hub; expect elevated dwell risk.'
       WHEN ratio >= 1.5 THEN 'Predicted ETA materially above OSRM baseline.'
       ELSE 'Within normal network operating envelope.' END AS route_insights,
  round(source_bottleneck_score, 6) AS source_bottleneck_score, round(destination_bottleneck_score, 6) AS destination_bottleneck_score,
  round(predicted_eta - 1.28 * 30.0, 6) AS confidence_low, round(predicted_eta + 1.28 * 30.0, 6) AS confidence_high FROM z""",
       HUBS, _FEAT_TR)


@query("score_requests")
def q_score_requests(spark, sf):
    art, hubs = fitted(spark, sf)
    res = SC.score_requests(fixtures.requests(spark, sf), standin_model(), art, hubs)
    return round_doubles(res.select("request_id", "result.predicted_eta", "result.risk_level",
                                    F.col("result.confidence_band.low").alias("band_low"),
                                    F.col("result.confidence_band.high").alias("band_high"),
                                    "result.osrm_baseline", "result.route_lane"))


oracle("score_requests", """SELECT request_id, round(predicted_eta, 6) AS predicted_eta,
  CASE WHEN pts >= 4 THEN 'CRITICAL' WHEN pts >= 3 THEN 'HIGH' WHEN pts >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  round(predicted_eta - 1.28 * 30.0, 6) AS band_low, round(predicted_eta + 1.28 * 30.0, 6) AS band_high,
  round(osrm_time, 6) AS osrm_baseline,
  r.source_center || ' → ' || r.destination_center AS route_lane FROM z JOIN req r USING (request_id)""", HUBS, _FEAT_TR)


# ---- training and evaluation: trees have no SQL equivalent, so their metrics stand beside exact counts and baselines ----

def _fit_report(tr, te, model, name):
    """One row: the split's sizes and the error of the training mean (exact), and whether the fit's metrics beat it."""
    mean = tr.agg(F.avg(S.TARGET).alias("_m"), F.count(F.lit(1)).alias("train_rows"))
    base = te.crossJoin(F.broadcast(mean)).agg(F.first("train_rows").alias("train_rows"), F.count(F.lit(1)).alias("test_rows"),
                                               F.avg(F.abs(F.col(S.TARGET) - F.col("_m"))).alias("baseline_mae"))
    m = ML.metrics_frame(name, ML.regression_metrics(model.transform(te)))
    return m.crossJoin(base).select(F.col("Model").alias("model"), "train_rows", "test_rows", F.round("baseline_mae", 6).alias("baseline_mae"),
                                    (F.col("MAE") < F.col("baseline_mae")).alias("beats_mean"), (F.col("R2") > 0.5).alias("explains_half"),
                                    (F.col("RMSE") >= F.col("MAE")).alias("rmse_above_mae"))


_SPLIT = """sp AS (SELECT *, CAST('0x' || substr(md5(trip_uuid || '|42'), 1, 8) AS BIGINT) % 100 < 20 AS held FROM clean),
base AS (SELECT (SELECT count(*) FROM sp WHERE NOT held) AS train_rows, count(*) AS test_rows,
  avg(abs(actual_time - (SELECT avg(actual_time) FROM sp WHERE NOT held))) AS baseline_mae FROM sp WHERE held)"""


def _fit_sql(*names):
    return "SELECT t.m AS model, train_rows, test_rows, round(baseline_mae, 6) AS baseline_mae, true AS beats_mean, true AS explains_half, true AS rmse_above_mae " \
           f"FROM base, (VALUES {', '.join(f'({n!r})' for n in names)}) t(m)"


@query("train_eta")
def q_train_eta(spark, sf):
    """Boosted trees on the 24 features, with the production settings."""
    tr, te, art = matrices(spark, sf)
    return _fit_report(tr, te, ML.train_eta(tr, art.feature_columns), "GBT+graph")


oracle("train_eta", _fit_sql("GBT+graph"), _SPLIT)


@query("train_generic")
def q_train_generic(spark, sf):
    tr, te, art = matrices(spark, sf)
    return _fit_report(tr, te, ML.train_generic(tr, art.feature_columns, LinearRegression(featuresCol="features", labelCol=S.TARGET)), "any")


oracle("train_generic", _fit_sql("any"), _SPLIT)


@query("model_linear")
def q_model_linear(spark, sf):
    """A row per feature: least squares leaves residuals of the training rows that no feature is correlated with (collinear
    features make the normal equations singular and the solver iterate, hence 1e-3)."""
    tr, te, art = matrices(spark, sf)
    model = ML.model_linear(tr, art.feature_columns)
    left = F.col(S.TARGET) - F.col("prediction")
    left_over = model.transform(tr).select(left.alias("residual"), *art.feature_columns)
    sums = left_over.agg(*[(F.abs(F.avg(F.col("residual") * F.col(c)) - F.avg("residual") * F.avg(c))
                         / (1e-9 + F.stddev_pop("residual") * F.stddev_pop(c))).alias(c) for c in art.feature_columns]).first()
    report = _fit_report(tr, te, model, "LinearRegression")
    rows = spark.createDataFrame([(c, bool(v is None or v < 1e-3)) for c, v in sums.asDict().items()], "feature string, orthogonal boolean")
    return rows.crossJoin(F.broadcast(report))


oracle("model_linear", "SELECT f AS feature, true AS orthogonal, x.* FROM (" + _fit_sql("LinearRegression") + ") x, (VALUES "
       + ", ".join(f"('{c}')" for c in FE.feature_list(CATS)) + ") v(f)", _SPLIT)


@query("model_forest")
def q_model_forest(spark, sf):
    """A forest with the operator's own settings: 200 trees of depth 14."""
    tr, te, art = matrices(spark, sf)
    return _fit_report(tr, te, ML.model_forest(tr, art.feature_columns), "RandomForest")


oracle("model_forest", _fit_sql("RandomForest"), _SPLIT)


@query("model_comparison")
def q_model_comparison(spark, sf):
    """A row per model: the split's sizes and baseline, metrics that beat it, the one of least error marked."""
    tr, te, art = matrices(spark, sf)
    feats = art.feature_columns
    models = {"LinearRegression": ML.model_linear(tr, feats), "RandomForest": ML.model_forest(tr, feats, num_trees=20, max_depth=8),
              "GBT+graph": ML.train_eta(tr, feats, **CHECK_GBT)}
    rows = cut_lineage(ML.model_comparison(te, models))
    least = rows.agg(F.min("MAE").alias("least"))
    marked = rows.crossJoin(F.broadcast(least)).select(F.col("Model").alias("model"), (F.col("is_best") == (F.col("MAE") == F.col("least"))).alias("marked_right"))
    reports = None
    for name, m in models.items():
        r = _fit_report(tr, te, m, name)
        reports = r if reports is None else reports.unionByName(r)
    return reports.join(marked, "model")


oracle("model_comparison", "SELECT *, true AS marked_right FROM (" + _fit_sql("LinearRegression", "RandomForest", "GBT+graph") + ")", _SPLIT)


@query("graph_ablation")
def q_graph_ablation(spark, sf):
    """A row per fit with its test rows; both learn, and the gain is the difference of their errors."""
    tr, te, art = matrices(spark, sf)
    base = [c for c in art.feature_columns if c not in S.GRAPH_FEATURES]
    rows = cut_lineage(ML.graph_ablation(tr, te, base, art.feature_columns, **CHECK_GBT))
    d = rows.agg((F.max(F.when(F.col("Model").contains("no graph"), F.col("MAE"))) - F.max(F.when(F.col("Model").contains("+ graph"), F.col("MAE")))).alias("d"))
    n = te.agg(F.count(F.lit(1)).alias("test_rows"))
    return rows.crossJoin(F.broadcast(d)).crossJoin(F.broadcast(n)).select(
        F.col("Model").alias("model"), "test_rows", (F.col("R2") > 0.5).alias("explains_half"), (F.abs(F.col("mae_gain") - F.col("d")) < 1e-6).alias("gain_is_difference"))


oracle("graph_ablation", """SELECT m AS model, test_rows, true AS explains_half, true AS gain_is_difference
  FROM base, (VALUES ('GBT (no graph)'), ('GBT (+ graph)')) t(m)""", _SPLIT)


@query("feature_importance")
def q_feature_importance(spark, sf):
    """A row per feature: mean gain of its splits, as shares of one in falling order; graph features marked."""
    tr, _, art = matrices(spark, sf)
    rows = cut_lineage(EX.gain_importance(ML.train_eta(tr, art.feature_columns, **CHECK_GBT), art.feature_columns, spark))
    total = rows.agg((F.abs(F.sum("importance") - 1) < 1e-9).alias("shares_of_one"))
    return rows.crossJoin(F.broadcast(total)).select("feature", "is_graph_feature", ((F.col("importance") > 0) == (F.col("splits") > 0)).alias("gain_only_if_split"),
                                                     "shares_of_one")


oracle("feature_importance", "SELECT f AS feature, g AS is_graph_feature, true AS gain_only_if_split, true AS shares_of_one FROM (VALUES "
       + ", ".join(f"('{c}', {str(c in S.GRAPH_FEATURES).lower()})" for c in FE.feature_list(CATS)) + ") v(f, g)")


@query("explainability")
def q_explainability(spark, sf):
    """A row per held-out segment: its contributions and the base add up to the model's prediction for it."""
    tr, te, art = matrices(spark, sf)
    model = ML.train_eta(tr, art.feature_columns, **CHECK_GBT)
    te = written(te)
    shown = EX.explain_rows(model, te, art.feature_columns, "segment_key")
    both = shown.join(model.transform(te).select("segment_key", "prediction"), "segment_key")
    total = F.aggregate("contributions", F.col("base"), lambda s, x: s + x)
    return both.select("segment_key", F.size("contributions").alias("features"),
                       (F.abs(total - F.col("prediction")) <= 1e-9 * (1 + F.abs("prediction"))).alias("adds_up"))


oracle("explainability", f"SELECT segment_key, {len(FE.feature_list(CATS))} AS features, true AS adds_up FROM sp WHERE held", _SPLIT)


@query("permutation_importance")
def q_permutation_importance(spark, sf):
    """A row per feature; one that no split uses does not change the error, and some feature does."""
    tr, te, art = matrices(spark, sf)
    model = ML.train_eta(tr, art.feature_columns, max_iter=5, max_depth=4)
    rows = cut_lineage(ML.permutation_importance(model, te, art.feature_columns))
    used = EX.gain_importance(model, art.feature_columns, spark).select("feature", "splits")
    some = rows.agg((F.max("mae_increase") > 0).alias("some_matters"))
    return rows.join(used, "feature").crossJoin(F.broadcast(some)).select(
        "feature", ((F.col("splits") > 0) | (F.abs("mae_increase") < 1e-9)).alias("unused_are_neutral"), "some_matters")


oracle("permutation_importance", "SELECT f AS feature, true AS unused_are_neutral, true AS some_matters FROM (VALUES "
       + ", ".join(f"('{c}')" for c in FE.feature_list(CATS)) + ") v(f)")


@query("smoke_train")
def q_smoke_train(spark, sf):
    df = FE.build_ml_features(enrich_graph(add_trip_time_parts(clean_frame(spark, sf)), fixtures.hub_table(spark, sf)), CATS)
    feats = ["osrm_time", "osrm_distance", "segment_osrm_time", "segment_osrm_distance", "trip_hour_sin",
             "trip_hour_cos", "source_bottleneck_score", "destination_bottleneck_score", "same_community"]
    return ML.smoke_train(df, feats, trees=10, depth=5).select(F.col("n").cast("bigint").alias("test_rows"), (F.col("R2") > 0.5).alias("explains_half"))


oracle("smoke_train", "SELECT test_rows, true AS explains_half FROM base", _SPLIT)


@query("prepare_training")
def q_prepare_training(spark, sf):
    """Time parts -> hub tables -> enrich -> features (stand-in hub tables keep it SQL-free here;
    the graph build itself is the ``lane_graph_tables`` query)."""
    from hubflow.plans.production import prepare_training
    feat, _ = prepare_training(clean_frame(spark, sf), standin_tables(spark, sf))
    return round_doubles(feat.select("segment_key", *FE.feature_list(CATS)))


oracle("prepare_training", "SELECT segment_key, " + ", ".join(f"round({c}, 6) AS {c}" for c in FE.feature_list(CATS)) + " FROM feat", HUBS, ENR, FEAT)


# ---- stores and sources ---------------------------------------------------------------------

def _trained_bundle(spark, sf):
    """The production path on the segments: split, preprocessing, a few boosted trees, evaluation, saved bundle."""
    from hubflow.plans.production import train_production
    path = files.scratch_path(spark, "bundle")
    return path, train_production(spark, clean_frame(spark, sf), path, standin_tables(spark, sf), **CHECK_GBT)


@query("bundle_io")
def q_bundle_io(spark, sf):
    """Train, save, load: the loaded bundle scores every request as the fitted model does."""
    from hubflow.plans.production import score_with_bundle
    path, trained = _trained_bundle(spark, sf)
    b = store.load_bundle(spark, path)
    same = b["preprocessor"] == trained["preprocessor"]
    req = fixtures.requests(spark, sf)
    mine = score_with_bundle(spark, req, trained).select("request_id", F.col("predicted_eta").alias("p"), F.col("risk_level").alias("r"))
    both = score_with_bundle(spark, req, b).join(mine, "request_id")
    return round_doubles(both.select("request_id", "osrm_time", (F.col("predicted_eta") == F.col("p")).alias("same_prediction"),
                                     F.col("risk_level").eqNullSafe(F.col("r")).alias("same_risk"), F.lit(same).alias("same_preprocessor")))


oracle("bundle_io", """SELECT request_id, round(osrm_time, 6) AS osrm_time, true AS same_prediction, true AS same_risk, true AS same_preprocessor FROM z""",
       HUBS, _FEAT_TR)


@query("metadata_json")
def q_metadata_json(spark, sf):
    """What the trained bundle's metadata says: model type, number of features, the split's sizes, metrics, date."""
    path, trained = _trained_bundle(spark, sf)
    m = F.col("metrics")
    return store.metadata_frame(spark, path).select(
        "model_type", F.size("feature_columns").alias("features"), m["train_rows"].alias("train_rows"), m["test_rows"].alias("test_rows"),
        (m["R2"] > 0.5).alias("explains_half"), (m["MAE"] == trained["metrics"]["MAE"]).alias("same_mae"), F.col("trained_at").isNotNull().alias("dated"))


oracle("metadata_json", f"""SELECT 'GBTRegressor' AS model_type, CAST({len(FE.feature_list(CATS))} AS INT) AS features,
  CAST(train_rows AS DOUBLE) AS train_rows, CAST(test_rows AS DOUBLE) AS test_rows, true AS explains_half, true AS same_mae, true AS dated FROM base""", _SPLIT)


@query("graph_tables_io")
def q_graph_tables_io(spark, sf):
    """A reader that pins a version keeps it when a newer one is published."""
    path = files.scratch_path(spark, "hubs")
    tables = standin_tables(spark, sf)
    version = store.publish_graph_tables(spark, tables, path)
    store.publish_graph_tables(spark, {k: v.limit(0) for k, v in tables.items()}, path)
    back = store.load_graph_tables(spark, path, version)
    return round_doubles(back["pagerank"].join(back["bottleneck"].select("hub_id", "bottleneck_score"), "hub_id"))


oracle("graph_tables_io", "SELECT hub_id, round(pagerank, 6) AS pagerank, round(bottleneck_score, 6) AS bottleneck_score FROM hubs",
       HUBS)


@query("load_or_build_graph")
def q_load_or_build_graph(spark, sf):
    """Where the hub tables come from (fresh store, exports, a rebuild of the segments' network) and how many hubs they cover."""
    from hubflow.operators.joins import hub_coverage
    seg = lane_frame(spark, sf)
    tables = standin_tables(spark, sf, fixtures.hub_table(spark, sf, seg))
    home, exports = files.scratch_path(spark, "hubs"), files.scratch_path(spark, "exports")
    store.persist_graph_tables(spark, tables, home)
    store.save_graph_exports(tables, exports)
    out = None
    for wanted, given in (("store", {"store": home, "exports": exports}), ("exports", {"exports": exports}), ("built", {})):
        found, origin = store.load_or_build_graph(spark, seg, **given)
        row = hub_coverage(seg, found["pagerank"]).select(F.lit(wanted).alias("wanted"), F.lit(origin).alias("origin"), "coverage",
                                                          F.lit(found["pagerank"].count()).alias("hubs"))
        out = row if out is None else out.unionByName(row)
    return out


oracle("load_or_build_graph", """SELECT w AS wanted, w AS origin,
  (SELECT count(*) FILTER (WHERE h IN (SELECT hub_id FROM hubs)) / count(*) FROM (SELECT source_center AS h FROM clean UNION SELECT destination_center FROM clean)) AS coverage,
  (SELECT count(*) FROM hubs) AS hubs FROM (VALUES ('store'), ('exports'), ('built')) t(w)""", HUBS)


@query("write_processed")
def q_write_processed(spark, sf):
    path = files.scratch_path(spark, "processed")
    files.write_processed(clean_frame(spark, sf), path)
    return round_doubles(shown_times(files.load_parquet(spark, path)))


oracle("write_processed", """SELECT data, trip_uuid, route_schedule_uuid, route_type, source_center, destination_center,
  source_name, destination_name, actual_time, osrm_time, segment_actual_time, segment_osrm_time,
  round(delay_ratio, 6) AS delay_ratio, round(segment_delay_ratio, 6) AS segment_delay_ratio, route_lane,
  round(actual_distance_to_destination, 6) AS actual_distance_to_destination, osrm_distance, segment_osrm_distance,
  round(factor, 6) AS factor, round(segment_factor, 6) AS segment_factor, is_cutoff, segment_key, """ + TIMES_SQL + " FROM clean")


def _raw_csv(spark, sf):
    """The raw segment table exported as header CSV with text timestamps (the reference's input)."""
    seg = fixtures.segments(spark, sf)
    cols = [F.col(c).cast("string").alias(c) if c in S.DATETIME_COLS else F.col(c) for c in seg.columns
            if c != "segment_key"]
    path = files.scratch_path(spark, "raw") + ".csv"
    files.save_table(seg.select(*cols), path)
    return path


_CSV_SQL = """SELECT route_type, count(*) AS n_rows, count(trip_creation_time) AS parsed_times,
  sum(segment_actual_time) AS seg_actual, count(source_center) AS with_source FROM segments GROUP BY route_type"""


def _csv_summary(df):
    return df.groupBy("route_type").agg(F.count(F.lit(1)).alias("n_rows"), F.count("trip_creation_time").alias("parsed_times"),
                                        F.sum("segment_actual_time").alias("seg_actual"),
                                        F.count("source_center").alias("with_source"))


@query("load_csv")
def q_load_csv(spark, sf):
    path = _raw_csv(spark, sf)
    return _csv_summary(coerce_datetime(files.load_csv(spark, path)))


oracle("load_csv", _CSV_SQL)


@query("resolve_source")
def q_resolve_source(spark, sf):
    base = _raw_csv(spark, sf)[:-4]
    return _csv_summary(coerce_datetime(files.resolve_source(spark, base)))


oracle("resolve_source", _CSV_SQL)


@query("load_parquet")
def q_load_parquet(spark, sf):
    li = files.load_parquet(spark, f"{sf}/lineitem.parquet")
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))


oracle("load_parquet", "SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS qty FROM lineitem GROUP BY 1")


@query("save_table")
def q_save_table(spark, sf):
    from hubflow.operators.profile import top_delayed_lanes
    path = files.scratch_path(spark, "table")
    files.save_table(round_doubles(top_delayed_lanes(clean_frame(spark, sf))), path)
    return files.load_csv(spark, path, schema="route_lane string, n_segments bigint, median_segment_delay double, "
                                             "mean_segment_actual double, mean_segment_osrm double")


oracle("save_table", """SELECT route_lane, count(segment_actual_time) AS n_segments,
  round(median(segment_delay_ratio), 6) AS median_segment_delay, round(avg(segment_actual_time), 6) AS mean_segment_actual,
  round(avg(segment_osrm_time), 6) AS mean_segment_osrm FROM clean GROUP BY route_lane
  HAVING count(segment_actual_time) >= 50 ORDER BY median(segment_delay_ratio) DESC, route_lane LIMIT 15""")


@query("save_predictions")
def q_save_predictions(spark, sf):
    path = files.scratch_path(spark, "pred")
    files.save_predictions(round_doubles(_scored_requests(spark, sf).select(
        "request_id", "predicted_eta", "risk_level", "confidence_band")), path)
    return round_doubles(files.load_csv(spark, path, schema="request_id bigint, predicted_eta double, risk_level string, "
                                                            "confidence_low double, confidence_high double"))


oracle("save_predictions", """SELECT request_id, round(predicted_eta, 6) AS predicted_eta,
  CASE WHEN pts >= 4 THEN 'CRITICAL' WHEN pts >= 3 THEN 'HIGH' WHEN pts >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  round(predicted_eta - 1.28 * 30.0, 6) AS confidence_low, round(predicted_eta + 1.28 * 30.0, 6) AS confidence_high
  FROM z""", HUBS, _FEAT_TR)


@query("require_columns")
def q_require_columns(spark, sf):
    """The check passes on the processed table, whose required columns are then counted, and names what is missing."""
    df = clean_frame(spark, sf)
    need = ["source_center", "destination_center", "route_lane", "segment_delay_ratio"]
    S.require_columns(df, need)
    try:
        S.require_columns(df, ["trip_hour", "route_lane"])
        missing = ""
    except KeyError as e:
        missing = str(e.args[0])
    return df.agg(*[F.count(c).alias(c) for c in need]).withColumn("missing", F.lit(missing))


oracle("require_columns", """SELECT count(source_center) AS source_center, count(destination_center) AS destination_center,
  count(route_lane) AS route_lane, count(segment_delay_ratio) AS segment_delay_ratio,
  'Missing required columns: [''trip_hour'']' AS missing FROM clean""")
