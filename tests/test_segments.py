"""Segmented scans and validity intervals against the plain per-entity window and the as-of join."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stayflow.operators import asof_join, day_segment, interval_join, islands, validity, with_next

D0 = dt.date(2020, 1, 1)


def plain_islands(df):
    w = Window.partitionBy("k").orderBy("d")
    start = F.col("open") & ~F.coalesce(F.lag("open").over(w), F.lit(False))
    return df.withColumn("s", start).withColumn("n", F.sum(F.when(F.col("s"), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def table(df):
    return sorted(map(str, map(tuple, df.collect())))


@pytest.mark.parametrize("days", [1, 3, 64, 10_000])
def test_segmented_islands_equal_one_window(spark, days):
    rng = random.Random(days)
    data = []
    for k in [None, *range(12)]:
        share = rng.random()
        for i in range(200):
            if rng.random() < 0.8:  # holes in the calendar: a run goes on over a missing day, as by rows
                data.append((k, D0 + dt.timedelta(days=i), None if rng.random() < 0.05 else rng.random() < share, i))
    data += [(99, D0 + dt.timedelta(days=i), True, 0) for i in range(150)] + [(98, D0 + dt.timedelta(days=i), False, 0) for i in range(150)]
    df = spark.createDataFrame(data, "k long, d date, open boolean, _runs int")
    got = islands(df, "k", "d", "open", "s", "n", segment=day_segment(F.col("d"), days))
    assert table(got) == table(plain_islands(df))
    assert islands(df.limit(0), "k", "d", "open").count() == 0


def test_an_entity_with_a_third_of_all_rows_is_spread(spark):
    """Segments by number; the rows of the hot entity lie in many partitions after the scan, none with more than its share."""
    n = 60_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000 + 1).alias("k"), F.col("id").alias("d"),
                               (F.pmod(F.xxhash64("id"), F.lit(5)) < 3).alias("open"))
    got = islands(df, "k", "d", "open", "s", "n", segment=F.floor(F.col("d") / 600))
    assert table(got.where("k < 40")) == table(plain_islands(df).where("k < 40"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window " in line]
    assert windows and any("_segment" in line for line in windows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = got.where("k = 0").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(hot) >= 6 and max(r["count"] for r in hot) < n / 3 / 2


def test_next_row_across_segments(spark):
    rng = random.Random(1)
    data = [(k, D0 + dt.timedelta(days=i)) for k in (None, 1, 2) for i in sorted(rng.sample(range(900), 60))]
    df = spark.createDataFrame(data, "k long, d date")
    want = df.withColumn("n", F.lead("d").over(Window.partitionBy("k").orderBy("d")))
    for days in (1, 7, 64):
        assert table(with_next(df, ["k"], "d", "n", segment=day_segment(F.col("d"), days))) == table(want)


@pytest.mark.parametrize("bucket", [1, 5, 64, 1000])
def test_interval_join_equals_asof(spark, bucket):
    rng = random.Random(bucket)
    day = lambda i: dt.datetime(2020, 1, 1) + dt.timedelta(days=i, hours=rng.randrange(24))
    changes = [(k, day(rng.randrange(-300, 500)), rng.choice(["a", "b", "c"]), rng.randrange(9)) for k in (1, 2, 3) for _ in range(rng.randrange(1, 40))]
    changes += [(7, day(i % 400), f"h{i}", i) for i in range(3000)] + [(4, None, "never", 1), (5, day(9999), "late", 1), (None, day(1), "x", 1)]
    chg = spark.createDataFrame(changes, "k long, at timestamp, what string, id long")
    rows = [(k, D0 + dt.timedelta(days=i), k) for k in (1, 2, 3, 4, 5, 6, 7, None) for i in range(0, 420, 3)] + [(1, None, 0), (1, D0, 9), (1, D0, 9)]
    left = spark.createDataFrame(rows, "k long, d date, v0 long")
    got = interval_join(left, validity(chg, "k", "at", ["what"], ["id"]), "k", "d", ["at", "what"], bucket_days=bucket)
    want = asof_join(left, chg.where("at IS NOT NULL AND k IS NOT NULL"), "k", "d", "at", ["what"], ["id"], matched_col="at")
    dated = lambda df: table(df.where("d IS NOT NULL").select("k", "d", "v0", "at", "what"))
    assert dated(got) == dated(want)
    assert got.where("d IS NULL").select("what").collect() == [(None,)]
    assert interval_join(left.limit(0), validity(chg, "k", "at", ["what"]), "k", "d", ["what"]).count() == 0
    assert interval_join(left, validity(chg.limit(0), "k", "at", ["what"]), "k", "d", ["what"]).where("what IS NOT NULL").count() == 0


def test_intervals_of_a_key_tile_its_days(spark):
    chg = spark.createDataFrame([(1, dt.datetime(2020, 1, 5, 9), "a"), (1, dt.datetime(2020, 1, 5, 18), "b"), (1, dt.datetime(2020, 3, 1), "c")], "k long, at timestamp, what string")
    got = [tuple(r) for r in validity(chg, "k", "at", ["what"]).orderBy("valid_from").collect()]
    assert got == [(1, dt.date(2020, 1, 5), dt.date(2020, 3, 1), dt.datetime(2020, 1, 5, 18), "b"), (1, dt.date(2020, 3, 1), None, dt.datetime(2020, 3, 1), "c")]


def test_daily_fact_with_amenities_in_force(spark):
    from dataclasses import replace

    from fixtures import CONFIG, raw_frames
    from stayflow.plans.warehouse import Warehouse

    raw = raw_frames(spark)
    late = spark.createDataFrame([(1, dt.datetime(2021, 7, 15, 12), '["Kitchen"]'), (3, dt.datetime(2021, 7, 20), "oops")], raw["amenities_changelog"].schema)
    raw["amenities_changelog"] = raw["amenities_changelog"].union(late)
    wh = Warehouse(spark, "fixture", cfg=replace(CONFIG, amenity_history="in_force"), materialize=False, raw=raw)
    got = {(r.listing_id, r.calendar_date.day): (r.amenity_count, r.has_wifi) for r in wh.fct_listing_daily().collect()}
    assert got[1, 14] == (3, True) and got[1, 15] == (1, False) == got[1, 21]
    assert got[3, 19] == (2, False) and got[3, 20] == (None, None)


def test_whole_windows_give_the_runs_of_segments(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 2, 3]), d, rng.choice([True, True, False, None])) for d in sorted(rng.sample(range(2000), 400))]
    df = spark.createDataFrame([(k, dt.date(2020, 1, 1) + dt.timedelta(days=d), f) for k, d, f in rows], "k long, d date, open boolean")
    seen = lambda got: sorted(map(repr, got.collect()))
    assert seen(islands(df, "k", "d", "open", "s", "n", whole=True)) == seen(islands(df, "k", "d", "open", "s", "n"))
    plan = islands(df, "k", "d", "open", whole=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_asof_rows_travel_with_key_and_date_once(spark):
    left = spark.createDataFrame([(7, dt.date(2024, 1, 2), 1), (7, None, 2), (None, dt.date(2024, 1, 3), 3)], "x long, d date, k long")
    chg = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 5), "a"), (3, dt.datetime(2024, 1, 4), "b")], "k long, at timestamp, what string")
    got = asof_join(left, chg, "k", "d", "at", ["what"])
    assert got.columns == ["x", "d", "k", "asof_time", "what"]
    assert sorted((r.k, r.x, r.d, r.what) for r in got.collect()) == [(1, 7, dt.date(2024, 1, 2), "a"), (2, 7, None, None), (3, None, dt.date(2024, 1, 3), None)]
    times = asof_join(left.withColumn("d", F.col("d").cast("timestamp")), chg, "k", "d", "at", ["what"])
    assert dict(times.dtypes)["d"] == "timestamp" and times.where("what = 'a'").count() == 1
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "struct(x, " in plan and "struct(x, x#" in plan and ", k, k#" not in plan and ", d, d#" not in plan
