"""The driver contract, and every registered query against its SQL oracle on sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from stayflow.plans import catalog
from stayflow.sources.tables import TABLES

SMOKE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")


def _canon(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    return str(v)


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["listing_id", "listing_name", "neighborhood", "longest_possible_stay_nights",
                          "longest_availability_window", "owner_max_nights", "availability_windows"]


def test_every_query_has_an_oracle():
    assert set(catalog.spark_queries()) == set(catalog.oracle_queries())
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(catalog.spark_queries()) >= 80


@pytest.mark.parametrize("name", sorted(catalog.spark_queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SMOKE)
    res = con.execute(E.oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(o_cols)
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(o_cols, res.fetchall())
