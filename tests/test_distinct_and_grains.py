"""Mergeable distinct counts and several grains from one scan, against one query at a time."""

import random

import pytest
from pyspark.sql import functions as F

from stayflow.operators import dense_ids, distinct_counts, distinct_state, merge_states
from stayflow.plans import models
from stayflow.plans.semantic import SemanticError
from stayflow.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


def test_dense_ids_number_every_value_once(spark):
    df = spark.range(5000).selectExpr("if(id % 7 = 0, null, pmod(id * 7919, 3000) * 1000000007) as k", "id as p")
    got = dense_ids(df, "k", "n").orderBy("n").collect()
    want = sorted(r.k for r in df.where("k IS NOT NULL").select("k").distinct().collect())
    assert [(r.k, r.n) for r in got] == list(zip(want, range(len(want))))
    assert dense_ids(df.limit(0), "k").count() == 0


def test_states_roll_up_and_merge(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["jan", "feb", None]), rng.choice(["n", "s"]), rng.choice([None, rng.randrange(70_000)]), rng.randrange(40)) for _ in range(6000)]
    rows += [("jan", "n", i, 0) for i in (0, 32767, 32768, 65535, 65536)]
    df = spark.createDataFrame(rows, "m string, r string, a long, b long")
    whole = distinct_state(df, ["m", "r"], {"as": "a", "bs": "b"})
    merged = merge_states(distinct_state(df.where("m = 'jan'"), ["m", "r"], {"as": "a", "bs": "b"}),
                          distinct_state(df.where("m IS NULL OR m = 'feb'"), ["m", "r"], {"as": "a", "bs": "b"}))
    for state in (whole, merged):
        for dims in (["m", "r"], ["m"], ["r"], []):
            want = (df.groupBy(*dims) if dims else df).agg(F.count_distinct("a").alias("as"), F.count_distinct("b").alias("bs"))
            assert sorted(map(str, distinct_counts(state, dims, ["as", "bs"]).collect())) == sorted(map(str, want.collect()))
    # one bitmap per group and range of ids, whatever the rows
    assert whole.count() <= 6 * (3 + 1) and whole.agg(F.max(F.length("bits"))).first()[0] == 4096
    empty = distinct_state(df.limit(0), ["m"], {"as": "a"})
    assert distinct_counts(empty, ["m"], ["as"]).count() == 0 and distinct_counts(empty, [], ["as"]).first()[0] == 0


def test_grains_equal_single_queries(spark):
    wh = Warehouse.for_dir(spark, SF)
    cases = [
        (models.listing_daily(wh), ["daily.total_revenue", "daily.occupancy_rate", "daily.listings"],
         [["daily.month_start_date"], ["daily.month_start_date", "listing.neighborhood"], ["listing.neighborhood"], []], lambda c: ~c("daily.is_deleted")),
        (models.listing_performance(wh), ["listing.listings", "listing.median_revenue_per_listing"], [["listing.neighborhood"], ["listing.room_type", "listing.neighborhood"]], None),
    ]
    for model, metrics, grains, where in cases:
        out = model.query_grains(metrics, grains, where=where)
        names = [m.split(".")[1] for m in metrics]
        for grain in grains:
            dims = [d.split(".")[1] for d in grain]
            got = out.where(F.col("grain") == ",".join(dims)).select(*dims, *names)
            want = model.query(metrics, grain, where=where).select(*dims, *names)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), grain
        assert out.count() == sum(model.query(metrics, g, where=where).count() for g in grains)
    plan = cases[0][0].query_grains(["daily.total_revenue"], cases[0][2])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" in plan


def test_grains_that_could_drop_rows_are_an_error(spark):
    model = models.listing_performance(Warehouse.for_dir(spark, SF))
    with pytest.raises(SemanticError, match="different parents"):
        model.query_grains(["listing.listings"], [["listing.room_type"], ["host.host_location"]])
    with pytest.raises(SemanticError, match="twice"):
        model.query_grains(["listing.listings"], [["listing.room_type"], ["listing.room_type"]])
    with pytest.raises(SemanticError):
        model.query_grains([], [["listing.room_type"]])
    kept = model.query_grains(["listing.listings"], [["listing.room_type"], ["host.host_location"]], keep_unmatched=True)
    want = model.query(["listing.listings"], ["host.host_location"], keep_unmatched=True)
    assert kept.where("grain = 'host_location'").count() == want.count()
