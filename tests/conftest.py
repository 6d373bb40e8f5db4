import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "8g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hubflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def graph(spark):
    """Build an edge table from (u, v, weight) tuples."""
    from hubflow.operators.graph.edges import with_flow_distance

    def make(edges):
        df = spark.createDataFrame(edges, "u string, v string, weight bigint").withColumn("avg_delay", F.lit(1.0))
        return with_flow_distance(df)
    return make
