"""Persisted hub feature store and model bundle.

Hub tables are published as versions: four Parquet tables in a folder of their own under ``data``, then, last, one
manifest under ``log`` that names the version, its folder and its time.  A version exists once its manifest does: a
write that breaks before leaves nothing that a reader would find, no version is ever changed, and readers that
pin a version keep it while newer ones appear.  Two writers of one version number cannot both commit; the later one takes the next number.

The bundle is a Spark ML ``PipelineModel`` directory next to its preprocessing artifact and metrics as one-row JSON.
Everything is written with Spark writers, so the same code targets local disks or object stores.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hubflow import schema as S
from hubflow.operators.preprocess import Artifact
from hubflow.sources.files import _fs_exists, load_csv, save_table

# ---- fixed values: names of the analyst exports and their columns ----
EXPORT_SCHEMA = ("hub_id string, pagerank double, degree_centrality double, bottleneck_score double, "
                 "community_id int, community_size int")
HUB_TABLES = {
    "pagerank": ["hub_id", "pagerank"],
    "degree": ["hub_id", "degree_centrality"],
    "bottleneck": ["hub_id", "bottleneck_score", "betweenness_centrality", "traffic_volume"],
    "communities": ["hub_id", "community_id", "community_size"],
}
EXPORT_FILES = {"bottleneck": "03_bottleneck_hubs", "pagerank": "03_hub_rankings_pagerank",
                "degree": "03_hub_rankings_degree", "communities": "03_hub_communities"}
EXPORT_COLUMNS = {"pagerank": ["hub_id", "pagerank"], "degree": ["hub_id", "degree_centrality"],
                  "bottleneck": ["hub_id", "bottleneck_score"],
                  "communities": ["hub_id", "community_id", "community_size"]}


def _write_json_row(spark: SparkSession, path: str, payload: dict, mode: str = "overwrite") -> None:
    spark.createDataFrame([(json.dumps(payload, sort_keys=True),)], "value string").coalesce(1) \
         .write.mode(mode).text(path)


def _read_json_row(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def graph_versions(spark: SparkSession, path: str) -> list[dict]:
    """Manifests of the committed versions, oldest first (one small row for each publication)."""
    if not _fs_exists(spark, f"{path}/log"):
        return []
    rows = spark.read.option("recursiveFileLookup", "true").text(f"{path}/log").collect()
    return sorted((json.loads(r["value"]) for r in rows), key=lambda m: m["version"])


def graph_version(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """Manifest of a version, by default of the newest."""
    found = [m for m in graph_versions(spark, path) if version is None or m["version"] == version]
    if not found:
        raise FileNotFoundError(f"no hub tables {'' if version is None else f'of version {version} '}under {path}")
    return found[-1]


def publish_graph_tables(spark: SparkSession, tables: dict, path: str, built_at: datetime | None = None, attempts: int = 5) -> int:
    """Writes the tables and commits them as the next version, which is returned."""
    folder = f"data/{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{path}/{folder}/{name}")
    ts = (built_at or datetime.now(timezone.utc)).isoformat()
    for _ in range(attempts):
        version = max((m["version"] for m in graph_versions(spark, path)), default=0) + 1
        try:
            _write_json_row(spark, f"{path}/log/{version:08d}", {"version": version, "folder": folder, "built_at": ts, "tables": sorted(tables)}, "errorifexists")
            return version
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
    raise RuntimeError(f"could not commit a version under {path} in {attempts} attempts")


def persist_graph_tables(spark: SparkSession, tables: dict, path: str, built_at: datetime | None = None) -> str:
    publish_graph_tables(spark, tables, path, built_at)
    return path


def load_graph_tables(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """The tables of a version (default: the newest); later publications do not change them."""
    folder = graph_version(spark, path, version)["folder"]
    return {name: spark.read.parquet(f"{path}/{folder}/{name}") for name in HUB_TABLES}


def graph_snapshot_age_days(spark: SparkSession, path: str, now: datetime | None = None, version: int | None = None) -> float:
    built = datetime.fromisoformat(graph_version(spark, path, version)["built_at"])
    return ((now or datetime.now(timezone.utc)) - built).total_seconds() / 86400


def save_graph_exports(tables: dict, tables_dir: str) -> str:
    """The hub tables as the analyst CSV exports that ``load_graph_tables_from_exports`` reads."""
    for name, stem in EXPORT_FILES.items():
        save_table(tables[name].select(*EXPORT_COLUMNS[name]), f"{tables_dir}/{stem}.csv")
    return tables_dir


def load_graph_tables_from_exports(spark: SparkSession, tables_dir: str) -> dict:
    """Analyst CSV exports, keeping only the feature-store columns."""
    out = {}
    for name, stem in EXPORT_FILES.items():
        df = load_csv(spark, f"{tables_dir}/{stem}.csv", schema=EXPORT_SCHEMA)
        out[name] = df.select(*EXPORT_COLUMNS[name])
    return out


def load_or_build_graph(spark: SparkSession, segments: DataFrame, store: str | None = None,
                        exports: str | None = None, max_age_days: float = 7.0, build=None) -> tuple[dict, str]:
    """Persisted store (if fresh and covering) -> analyst exports (if covering) -> rebuild.

    Returns (tables, origin); rebuilt tables are published as the store's next version.  Unlike the reference, a stored snapshot must also pass the age
    and coverage checks.
    """
    from hubflow.operators.joins import hub_coverage

    def covers(tables):
        cov = hub_coverage(segments, tables["pagerank"]).first()["coverage"]
        return cov >= S.GRAPH_COVERAGE_THRESHOLD

    if store and (known := graph_versions(spark, store)):
        newest = known[-1]["version"]
        tables = load_graph_tables(spark, store, newest)
        if graph_snapshot_age_days(spark, store, version=newest) <= max_age_days and covers(tables):
            return tables, "store"
    if exports and all(_fs_exists(spark, f"{exports}/{f}.csv") for f in EXPORT_FILES.values()):
        tables = load_graph_tables_from_exports(spark, exports)
        if covers(tables):
            return tables, "exports"
    if build is None:
        from hubflow.operators.clean import clean_segments
        from hubflow.operators.graph.bottleneck import lane_graph_tables
        from hubflow.operators.graph.edges import lane_edges, with_flow_distance
        from hubflow.session import written
        seg = segments if "route_lane" in segments.columns else clean_segments(segments)
        edges = written(with_flow_distance(lane_edges(seg)))
        tables = lane_graph_tables(edges)
    else:
        tables = build(segments)
    if store:
        tables = load_graph_tables(spark, store, publish_graph_tables(spark, tables, store))
    return tables, "built"


def save_bundle(spark: SparkSession, path: str, model: PipelineModel, artifact: Artifact, tables: dict,
                metrics: dict, model_type: str = "GBTRegressor") -> str:
    """Model + preprocessing artifact + hub tables + metrics + training timestamp."""
    trained_at = datetime.now(timezone.utc).isoformat()
    model.write().overwrite().save(f"{path}/model")
    persist_graph_tables(spark, tables, f"{path}/graph_tables")
    _write_json_row(spark, f"{path}/preprocessor", json.loads(artifact.to_json()))
    _write_json_row(spark, f"{path}/metadata", {
        "model_type": model_type, "feature_columns": artifact.feature_columns,
        "preprocessing": json.loads(artifact.to_json()), "metrics": metrics, "trained_at": trained_at,
        "target": S.TARGET})
    return path


def load_bundle(spark: SparkSession, path: str) -> dict:
    if not _fs_exists(spark, f"{path}/model"):
        raise FileNotFoundError(f"no model bundle under {path}")
    meta = _read_json_row(spark, f"{path}/metadata")
    return {"model": PipelineModel.load(f"{path}/model"),
            "preprocessor": Artifact.restore(_read_json_row(spark, f"{path}/preprocessor")),
            "graph_tables": load_graph_tables(spark, f"{path}/graph_tables"),
            "metrics": meta["metrics"], "trained_at": meta["trained_at"], "target": meta["target"],
            "metadata": meta}


def metadata_frame(spark: SparkSession, path: str) -> DataFrame:
    """The bundle metadata as a one-row DataFrame (model type, features, metrics, timestamp)."""
    schema = "model_type string, feature_columns array<string>, metrics map<string,double>, trained_at string"
    return spark.read.text(f"{path}/metadata").select(F.from_json("value", schema).alias("m")).select("m.*")
