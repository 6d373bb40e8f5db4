"""Small helpers shared by the operators: tables, written intermediates, files, gapless ranks."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hubflow.session import checkpoint_dir

#: Rows that one window group of a gapless ranking holds on average.
ROWS_PER_BUCKET = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared checkpoint folder; every executor sees it."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: computed once, lineage cut."""
    path = work_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def parallelism(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a local path or a URI such as file:, hdfs:, s3:, gs:."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class CommittedFile:
    """A file that appears under its name only when complete, so that a retried task replaces it."""

    def __init__(self, uri: str):
        self.fs, self.path = filesystem(uri)
        self.temporary = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.stream = self.fs.open_output_stream(self.temporary, compression=None)

    def __enter__(self):
        return self

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def __exit__(self, kind, value, trace):
        self.stream.close()
        if kind is None:
            self.fs.move(self.temporary, self.path)
        else:
            self.fs.delete_file(self.temporary)


def file_list(manifest: DataFrame, *columns: str) -> DataFrame:
    """One row per written file, dealt evenly; ``manifest`` is a written table of a row per file."""
    files = manifest.select(*columns).orderBy(columns[0]).collect()
    spark = manifest.sparkSession
    df = spark.createDataFrame(files, manifest.select(*columns).schema)
    return df.repartition(max(1, len(files)))


def slices(column, max_bytes: int = 2 << 20):
    """(first position, values) of an Arrow string or binary column in runs of at most ``max_bytes`` (or of one value)."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < len(sizes):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        yield at, column.slice(at, stop - at).to_pylist()
        at = stop


def gapless_rank(df: DataFrame, groups: list[str], order: list[str], name: str,
                 rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Adds ``name``: 0, 1, 2 ... without gaps within each group, in no promised order.

    A group may hold any share of the rows: rows are dealt over buckets by a hash of ``order`` and of
    the row's place in the scan, numbered within (group, bucket), and shifted by the counts of the
    group's earlier buckets.  ``df`` should be a written table, as it is read three times.
    """
    total = df.count()
    buckets = max(1, -(-total // rows_per_bucket))
    rows = df.withColumn("_bucket", F.pmod(F.xxhash64(*order, F.monotonically_increasing_id()), F.lit(buckets)).cast("long"))
    keys = [*groups, "_bucket"]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    numbered = rows.withColumn("_r", F.row_number().over(inside) - 1)
    a, b = numbered.alias("a"), shifts.alias("b")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return a.join(b, same).select(*[F.col(f"a.{c}").alias(c) for c in df.columns],
                                  (F.col("a._r") + F.col("b._shift")).cast("long").alias(name))
