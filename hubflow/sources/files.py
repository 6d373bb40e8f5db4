"""File readers and writers.  Paths may be any Hadoop-compatible URI (local, HDFS, S3A, ABFS);
existence probes go through the session's Hadoop FileSystem, never the local disk."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hubflow import schema as S
from hubflow.session import checkpoint_dir


def _fs_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir (visible to every executor)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = S.RAW_SEGMENT_SCHEMA,
             **options) -> DataFrame:
    """Header CSV read as text, then each declared column ``try_cast`` by NAME to its type.

    No inference pass over the data, column order in the file does not matter, malformed values
    become null (PERMISSIVE), and undeclared columns stay strings.
    """
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    for k, v in options.items():
        r = r.option(k, v)
    df = r.csv(path)
    if schema is None:
        return df
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    types = {f.name: f.dataType for f in schema.fields}
    cols = [F.col(c).try_cast(types[c]).alias(c) if c in types and types[c] != T.StringType() else F.col(c)
            for c in df.columns]
    return df.select(*cols)


def load_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def resolve_source(spark: SparkSession, base: str, schema: T.StructType | None = S.RAW_SEGMENT_SCHEMA) -> DataFrame:
    """Prefer ``base.parquet``, else ``base.csv``, else fail (a path with a suffix is read as is)."""
    if base.endswith(".parquet"):
        return load_parquet(spark, base)
    if base.endswith(".csv"):
        return load_csv(spark, base, schema)
    if _fs_exists(spark, base + ".parquet"):
        return load_parquet(spark, base + ".parquet")
    if _fs_exists(spark, base + ".csv"):
        return load_csv(spark, base + ".csv", schema)
    raise FileNotFoundError(f"Neither {base}.parquet nor {base}.csv exists")


def write_processed(df: DataFrame, path: str, partition_by: str | None = "route_type") -> str:
    """Processed Parquet sink (overwrite), optionally partitioned so readers can prune by route type."""
    w = df.write.mode("overwrite")
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return path


def save_table(df: DataFrame, path: str) -> str:
    """Header CSV export of a (small, report-sized) table; one task per partition writes."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def save_predictions(scored: DataFrame, path: str) -> str:
    """Scored batch export; the struct band is flattened because CSV has no nested types."""
    cols = [F.col(c) for c in scored.columns if c != "confidence_band"]
    if "confidence_band" in scored.columns:
        cols += [F.col(f"confidence_band.{end}").alias(f"confidence_{end}") for end in ("low", "high")
                 if f"confidence_{end}" not in scored.columns]
    return save_table(scored.select(*cols), path)
