"""Every registered query with an oracle matches DuckDB at sf0.001 (same compare as the driver:
row count, column names, order-insensitive values)."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from hubflow.plans.catalog import all_queries

SF = "/root/testdata/sf0.001"
#: Queries of optional parts have their tests beside them.
OWN = [k for k in sorted(E.queries()) if k in all_queries()]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if v is None or isinstance(v, (int, str, bool)):
        return v
    return str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in ["supplier", "orders", "lineitem", "events", "customer", "part", "nation", "region"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert not set(OWN) - set(E.oracle_sql())


@pytest.mark.parametrize("key", OWN)
def test_matches_duckdb(spark, con, key):
    df = E.queries()[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _bag(df.columns, srows) == _bag(dcols, drows)


def test_entry(spark):
    out = E.entry(spark)
    rows = out.collect()
    assert 0 < len(rows) <= 15
    assert out.columns == ["route_lane", "n_segments", "median_segment_delay", "mean_segment_actual", "mean_segment_osrm"]
