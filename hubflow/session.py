"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "hubflow") -> SparkSession:
    """Session with the settings every operator assumes (UTC, AQE, no UI).

    On a cluster pass ``master=None`` and let the launcher decide; locally pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the whole cluster
            b = b.config("spark.driver.memory", "16g")
    b = (b.config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    compiled_methods(spark)
    checkpoint_dir(spark)
    return spark


def compiled_methods(spark: SparkSession) -> None:
    """Lets Spark split the generated code of wide projections.

    HotSpot never compiles a method above 8,000 bytes of bytecode, so one fused stage over two dozen features would run in
    the JVM's interpreter; beyond this limit Spark generates smaller methods per operator instead.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


class NoConvergence(RuntimeError):
    """An iterative job reached its bound on rounds; a half-converged result is never returned."""


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names it; we only pick our own when it is unset *and* the master is local
    (tests, laptops).  On a cluster without the setting we refuse rather than write
    lineage cuts to a machine-local folder that a lost executor would take with it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset; point it at a shared folder (HDFS/S3/ABFS)")
    local = tempfile.mkdtemp(prefix="hubflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Reliable checkpoint (written to the shared checkpoint dir, survives executor loss).

    The input is persisted first so the checkpoint write reads the cached partitions instead of
    recomputing the whole plan a second time; the cache is dropped once the files exist.  With ``DISK_ONLY`` large rows
    wait on disk between the two, so the executors' memory holds none of them.
    """
    checkpoint_dir(df.sparkSession)
    held = df.persist(level)
    out = held.checkpoint(eager=True)
    held.unpersist()
    return out


#: Rows that a partition of a loop's cached table holds on average.
ROWS_PER_PARTITION = 25_000


def fitting(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by its keys to as many partitions as its rows ask for, at most ``spark.sql.shuffle.partitions``: a loop
    over a small table does not start hundreds of empty tasks a round."""
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-df.count() // ROWS_PER_PARTITION)
    return df.repartition(*keys) if wanted >= most else df.repartition(max(1, wanted), *keys)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in a fresh folder under the shared checkpoint dir, read back.

    For wide frames and hub tables: computed once, read by column, and of a size that the planner knows (a small table is
    broadcast at once, before the other side of its join is shuffled).
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/scratch/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
