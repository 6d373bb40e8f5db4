"""The distributed quantiles equal numpy's linear interpolation."""

import random

import numpy as np
import pytest

from hubflow.operators.quantiles import column_quantiles, grouped_quantiles, wide_quantiles

PS = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]


def test_grouped_quantiles(spark):
    rnd = random.Random(4)
    rows = [("hot", float(rnd.randrange(500))) for _ in range(3000)] + [(f"g{i % 7}", rnd.gauss(0, 9)) for i in range(300)]
    rows += [("one", 4.5), ("none", None), ("nan", float("nan")), ("nan", 2.0), ("inf", float("inf")), (None, 1.0), (None, 2.0), ("same", 3.0), ("same", 3.0)]
    got = {r["g"]: r["q"] for r in grouped_quantiles(spark.createDataFrame(rows, "g string, x double").repartition(5), ["g"], "x", PS).collect()}
    values = {}
    for g, x in rows:
        if x is not None and np.isfinite(x):
            values.setdefault(g, []).append(x)
    assert set(got) == set(values)
    for g, v in values.items():
        assert got[g] == pytest.approx(np.quantile(v, PS).tolist(), rel=1e-12)


def test_columns_without_keys(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, None, None), (5, 4.0, None)], "a int, b double, c double")
    row = wide_quantiles(df, ["a", "b", "c"], [0.5]).first()
    assert (row["q_a"], row["q_b"], row["q_c"]) == ([2.0], [3.0], None)
    assert wide_quantiles(df.limit(0), ["a"], [0.5]).first()["q_a"] is None
    assert column_quantiles(df, ["a", "c"], [1.0]).count() == 1
