"""Exact percentiles of groups against Spark's own percentile (which buffers a group) and against numpy."""

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayflow.operators.selection import exact_percentile


def both(df, fraction, limit):
    want = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", fraction).alias("p")).collect()}
    got = {r.g: r.p for r in exact_percentile(df, ["g"], "v", fraction, "p", limit).collect()}
    assert got.keys() == want.keys()
    for g in want:
        assert (got[g] is None) == (want[g] is None) and (want[g] is None or got[g] == pytest.approx(want[g], rel=1e-12)), (g, fraction)


@pytest.mark.parametrize("fraction", [0.0, 0.5, 0.37, 1.0])
def test_groups_of_all_kinds(spark, fraction):
    rng = random.Random(4)
    rows = [("even", float(i)) for i in range(4000)] + [("odd", float(i * i)) for i in range(3001)]
    rows += [("ties", 7.0)] * 3000 + [("ties", 8.0)] * 3000 + [("tails", 10.0 ** rng.uniform(-200, 200)) for _ in range(3000)]
    rows += [("signs", rng.choice([-1, 1]) * rng.expovariate(1)) for _ in range(3000)] + [(None, float(i)) for i in range(2000)]
    rows += [("one", 5.0), ("two", 1.0), ("two", 2.0), ("none", None), ("gaps", None), ("gaps", 3.0)]
    rng.shuffle(rows)
    both(spark.createDataFrame(rows, "g string, v double"), fraction, 50)


def test_decimals_integers_and_dates(spark):
    base = spark.range(5000).selectExpr("id % 3 as g", "cast(pmod(id * 7919, 5000) as decimal(28,2)) / 7 as v")
    both(base.selectExpr("g", "cast(v as decimal(30,6)) as v"), 0.5, 40)
    both(spark.range(6000).selectExpr("id % 2 as g", "cast(pmod(id * 104729, 400) as int) as v"), 0.5, 40)
    rows = [(1, Decimal(10**17) * 10**9 + i) for i in range(300)]  # equal as doubles: gathered after the sketch stops splitting
    got = exact_percentile(spark.createDataFrame(rows, "g int, v decimal(38,0)"), ["g"], "v", 0.5, "p", 20).collect()
    assert got[0].p == float(rows[149][1])


def test_two_groups_of_a_million_values(spark):
    df = spark.range(2_000_000).selectExpr("id % 2 as g", "pmod(id * 48271, 2147483647) / 3.0D as v")
    seen = {}
    frame = df.toPandas()
    want = {g: float(np.median(x)) for g, x in frame.groupby("g")["v"]}
    limit = 5000
    out = exact_percentile(df, ["g"], "v", 0.5, "p", limit)
    for r in out.collect():
        seen[r.g] = r.p
    assert seen.keys() == want.keys() and all(seen[g] == pytest.approx(want[g], rel=1e-15) for g in want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "median" not in plan


def test_no_keys_no_rows_and_clashing_names(spark):
    df = spark.range(101).selectExpr("cast(id as int) as n", "id as lo", "id * 2 as inside", "id % 4 as cell")
    assert exact_percentile(df, [], "inside", 0.5, "w", 10).collect()[0].w == 100.0
    got = {(r.cell, r.n): r.n for r in exact_percentile(df, ["cell"], "lo", 0.5, "n", 3).collect()}
    assert got == {(c, m): m for c, m in ((0, 50.0), (1, 49.0), (2, 50.0), (3, 51.0))}
    assert exact_percentile(df.limit(0), ["cell"], "lo").count() == 0
    assert exact_percentile(df.limit(0), [], "lo").collect()[0][0] is None
    with pytest.raises(ValueError):
        exact_percentile(df, [], "lo", 1.5)


def test_metric_models_use_it(spark):
    from stayflow.plans import models
    from stayflow.plans.warehouse import Warehouse

    wh = Warehouse.for_dir(spark, "/root/testdata/sf0.001")
    got = models.host_performance(wh).query(["host.median_revenue_per_listing", "host.hosts"], ["host.is_multi_listing_host"])
    want = wh.dim_hosts().groupBy("is_multi_listing_host").agg(F.median("revenue_per_listing").alias("median_revenue_per_listing"), F.count("*").alias("hosts"))
    order = lambda df: sorted(map(tuple, df.select("is_multi_listing_host", "median_revenue_per_listing", "hosts").collect()))
    assert order(got) == order(want)
    alone = models.host_performance(wh).query(["host.median_revenue_per_listing"]).collect()
    assert alone[0][0] == wh.dim_hosts().agg(F.median("revenue_per_listing")).collect()[0][0]
