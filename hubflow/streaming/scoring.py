"""Structured Streaming: score trip requests as they arrive and raise windowed risk alerts.

The request stream is deduplicated per request inside the watermark.  ``run_scored`` scores each micro-batch against one
pinned version of the published hub tables, which the query's checkpoint remembers over restarts, and writes every
batch to a folder of its own number: a batch that is replayed after a failure replaces itself.  ``stream_score`` is
the same as a lazy plan over any hub table, for sinks that Spark commits itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hubflow import schema as S
from hubflow.operators.graph.bottleneck import hub_feature_table
from hubflow.operators.score import predict_batch
from hubflow.sources import store


def read_requests(spark: SparkSession, path: str, schema=S.REQUEST_SCHEMA, files_per_batch: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(path)


def stream_score(requests: DataFrame, model, artifact, hubs: DataFrame, ts: str = "ts",
                 delay: str = "1 hour", key: str = "request_id") -> DataFrame:
    """Streaming scored requests: watermark, per-request dedup within the watermark, scoring."""
    dedup = requests.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
    return predict_batch(dedup, model, artifact, hubs)


def stream_risk_windows(scored: DataFrame, ts: str = "ts", size: str = "1 hour", delay: str | None = None) -> DataFrame:
    """Tumbling-window trip counts per risk level; append mode emits a window once the watermark
    passes its end (rows later than the watermark delay are dropped).  ``delay`` defines the
    watermark when the input stream does not carry one already (``stream_score`` sets it)."""
    src = scored.withWatermark(ts, delay) if delay else scored
    return (src
                  .groupBy(F.window(ts, size).alias("w"), "risk_level")
                  .agg(F.count(F.lit(1)).alias("trips"))
                  .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                          "risk_level", "trips"))


def run_to_parquet(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Drain everything available now into a Parquet sink (exactly-once via the checkpoint)."""
    q = (stream.writeStream.format("parquet").outputMode(mode).option("path", out)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def pinned_version(spark: SparkSession, store_path: str, checkpoint: str) -> int:
    """The hub tables' version that a query scores with: the newest at its first start, the same one at every restart."""
    note = f"{checkpoint}/hub-version"
    if not store._fs_exists(spark, f"{note}/_SUCCESS"):
        store._write_json_row(spark, note, {"version": store.graph_version(spark, store_path)["version"]})
    return store._read_json_row(spark, note)["version"]


def run_scored(requests: DataFrame, model, artifact, store_path: str, out: str, checkpoint: str, columns: list[str],
               ts: str = "ts", delay: str = "1 hour", key: str = "request_id") -> int:
    """Drains what is available, scores it batch by batch, returns the version of the hub tables that was used."""
    spark = requests.sparkSession
    version = pinned_version(spark, store_path, checkpoint)
    hubs = hub_feature_table(store.load_graph_tables(spark, store_path, version)).persist()
    dedup = requests.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
    q = (dedup.writeStream.foreachBatch(lambda batch, n: write_batch(predict_batch(batch, model, artifact, hubs).select(*columns), out, n))
         .option("checkpointLocation", f"{checkpoint}/query").trigger(availableNow=True).start())
    q.awaitTermination()
    hubs.unpersist()
    return version


def write_batch(scored: DataFrame, out: str, batch: int) -> None:
    """One folder per batch number; writing a number again replaces its folder."""
    scored.write.mode("overwrite").parquet(f"{out}/batch={batch}")
