import datetime as dt
import random
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

from stayflow.operators import (
    censor_flags, daily_grid, dedupe, entity_universe, events_to_spans, flag_branches, flatten_json_array,
    islands, latest_per_key, orphans, rank_with_running_share, reconstruct_entity, share_of_partition,
    top_k_share, vocabulary_drift, vocabulary_pivot,
)

D = dt.date


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_dedupe_keeps_one_row_per_grain_deterministically(spark):
    data = [(1, D(2021, 7, 12), True, "NULL", "85"), (1, D(2021, 7, 12), True, "NULL", "85"),
            (1, D(2021, 7, 12), True, "NULL", "85"),  # a row present three times
            (2, D(2021, 7, 12), False, "R9", "90"), (2, D(2021, 7, 12), False, "R9", "80"),  # not identical
            (3, D(2021, 7, 13), None, None, None)]
    df = spark.createDataFrame(data, "listing_id long, date date, available boolean, reservation_id string, price string")
    out = dedupe(df, ["listing_id", "date"], order_by=["date"])
    assert out.count() == 3
    assert out.filter("listing_id = 2").first()["price"] == "80"   # smallest full row wins
    assert out.columns == df.columns


def test_latest_per_key_latest_wins_and_ties_are_broken(spark):
    t1, t2 = dt.datetime(2021, 1, 1), dt.datetime(2021, 6, 1)
    data = [(1, t1, "a", '["Wifi"]'), (1, t2, "b", '["Wifi","Kitchen"]'),
            (2, t2, "c", '["Heating"]'), (2, t2, "d", '["Lockbox"]')]  # equal timestamps
    df = spark.createDataFrame(data, "listing_id long, changed_at timestamp, change_id string, amenities string")
    out = latest_per_key(df, ["listing_id"], ["changed_at"], ["change_id"])
    assert rows(out, "listing_id", "change_id") == [(1, "b"), (2, "d")]


def test_flatten_json_array_edges(spark):
    data = [(1, '["Wifi","Wifi","Kitchen"]'), (2, "not json"), (3, "[]"), (4, '["Children’s books", 7]'),
            (5, None), (6, '{"k": 1}')]
    df = spark.createDataFrame(data, "listing_id long, amenities string")
    out = flatten_json_array(df, "amenities", ["listing_id"], "amenity_name")
    assert rows(out, "listing_id", "amenity_name") == [(1, "Kitchen"), (1, "Wifi"), (4, "7"), (4, "Children’s books")]


def test_vocabulary_pivot_and_drift(spark):
    bridge = spark.createDataFrame([(1, "Wifi"), (1, "Hair dryer"), (2, "Kitchen"), (2, "Sauna")],
                                   "listing_id long, amenity_name string")
    vocab = ["Air conditioning", "Hair dryer", "Kitchen", "Wifi"]
    out = vocabulary_pivot(bridge, "listing_id", "amenity_name", vocab, "has_", "amenity_count", "amenity_list")
    assert out.columns == ["listing_id", "amenity_count", "amenity_list", "has_air_conditioning", "has_hair_dryer",
                           "has_kitchen", "has_wifi"]
    r1 = out.filter("listing_id = 1").first()
    assert (r1.amenity_count, r1.has_wifi, r1.has_air_conditioning, r1.has_kitchen) == (2, True, False, False)
    r2 = out.filter("listing_id = 2").first()
    assert r2.amenity_count == 2 and r2.amenity_list == ["Kitchen", "Sauna"]   # outside vocabulary: count/list only
    vdf = spark.createDataFrame([(v,) for v in vocab], "amenity_name string")
    unknown, stale = vocabulary_drift(bridge, "amenity_name", vdf, "amenity_name")
    assert [r[0] for r in unknown.collect()] == ["Sauna"]
    assert [r[0] for r in stale.collect()] == ["Air conditioning"]


def test_islands_runs(spark):
    # open, open, booked, open (one-night run), booked, open, open, open
    flags = [True, True, False, True, False, True, True, True]
    data = [(1, D(2021, 7, 12) + dt.timedelta(days=i), f) for i, f in enumerate(flags)]
    data += [(2, D(2021, 7, 12), False), (2, D(2021, 7, 13), None), (2, D(2021, 7, 14), True)]
    df = spark.createDataFrame(data, "listing_id long, d date, is_available boolean")
    out = islands(df, "listing_id", "d", "is_available").orderBy("listing_id", "d")
    got = [(r.is_window_start, r.availability_window_seq) for r in out.filter("listing_id = 1").collect()]
    assert got == [(True, 1), (False, 1), (False, 1), (True, 2), (False, 2), (True, 3), (False, 3), (False, 3)]
    # run lengths of open nights add up to the open nights
    runs = out.filter("is_available").groupBy("listing_id", "availability_window_seq").count()
    assert runs.agg(F.sum("count")).first()[0] == out.filter("is_available").count()
    l2 = [(r.is_window_start, r.availability_window_seq) for r in out.filter("listing_id = 2").collect()]
    assert l2 == [(False, 0), (None, 0), (True, 1)]


def test_daily_grid_is_gap_free(spark):
    ents = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    g = daily_grid(ents, "k", F.lit(D(2024, 1, 30)), F.lit(D(2024, 2, 2)), "d")
    assert g.count() == 8 and g.select("k", "d").distinct().count() == 8


def test_spans_and_censoring(spark):
    nights = [(1, "R1", D(2021, 7, 12)), (1, "R1", D(2021, 7, 13)),      # touches the first day
              (2, "R1", D(2021, 8, 1)), (2, "R1", D(2021, 8, 3)),        # same id, other listing, with a hole
              (3, "R2", D(2022, 7, 11))]                                  # touches the last day
    df = spark.createDataFrame(nights, "listing_id long, reservation_id string, d date")
    spans = events_to_spans(df, ["listing_id", "reservation_id"], "d")
    flagged = censor_flags(spans, F.lit(D(2021, 7, 12)), F.lit(D(2022, 7, 11)))
    got = rows(flagged, "listing_id", "nights", "is_contiguous", "is_left_censored", "is_right_censored")
    assert got == [(1, 2, True, True, False), (2, 2, False, False, False), (3, 1, True, False, True)]


def test_entity_universe_orphans_reconstruct(spark):
    ids = spark.createDataFrame([(1,), (1,), (2,), (3,)], "listing_id long")
    parent = spark.createDataFrame([(1, "a"), (3, "c")], "listing_id long, name string")
    u = entity_universe(ids, "listing_id", parent)
    assert rows(u, "listing_id", "name", "is_deleted") == [(1, "a", False), (2, None, True), (3, "c", False)]
    assert [r[0] for r in orphans(ids, parent, "listing_id").distinct().collect()] == [2]
    child = spark.createDataFrame([(10, "2019-01-01", "x"), (10, "2018-05-05", "y"), (11, None, "z")],
                                  "host_id long, since string, loc string")
    r = reconstruct_entity(child, "host_id", ["since", "loc"], count_col="listing_count")
    assert rows(r, "host_id", "listing_count", "since", "loc") == [(10, 2, "2018-05-05", "x"), (11, 1, None, "z")]


def test_share_of_partition_zero_total_is_null(spark):
    df = spark.createDataFrame([("m1", 3.0), ("m1", 1.0), ("m2", 0.0)], "m string, v double")
    got = rows(share_of_partition(df, "v", ["m"], "s"), "m", "v", "s")
    assert got == [("m1", 1.0, 0.25), ("m1", 3.0, 0.75), ("m2", 0.0, None)]
    assert rows(share_of_partition(df, "v", ["m"], "s", method="window"), "m", "v", "s") == got


def test_rank_with_running_share_matches_brute_force(spark):
    rnd = random.Random(7)
    data = [(i, Decimal(rnd.choice([100, 250, 250, 999, 5, 0])) + Decimal(rnd.randint(0, 3)) / 4) for i in range(500)]
    df = spark.createDataFrame(data, "k long, v decimal(12,2)").repartition(13)
    out = rank_with_running_share(df, "v", ["k"], num_partitions=11).toPandas()
    pdf = pd.DataFrame(data, columns=["k", "v"]).sort_values(["v", "k"], ascending=[False, True]).reset_index(drop=True)
    pdf["rank"] = range(1, len(pdf) + 1)
    pdf["running_total"] = pdf["v"].cumsum()
    merged = out.merge(pdf, on="k", suffixes=("", "_bf"))
    assert (merged["rank"] == merged["rank_bf"]).all()
    assert (merged["running_total"] == merged["running_total_bf"]).all()


def test_rank_has_no_single_partition_exchange_over_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 17).cast("double").alias("v"))
    out = rank_with_running_share(df, "v", ["k"], num_partitions=4)
    out.collect()
    lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    singles = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert singles, "expected the per-partition offsets to be gathered"
    for i in singles:  # only the per-partition totals (one row per range partition) go to one task
        assert "HashAggregate(keys=[_pid" in lines[i + 1]


def test_top_k_share(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([5, 9, 1, 9, 3, 7, 2])], "k long, v double")
    r = top_k_share(df, "v", 3, ["k"]).first()
    assert (r.n, r.total, r.top_k) == (7, 36.0, 25.0)
    assert abs(r.top_k_pct - 100 * 25 / 36) < 1e-9


def test_flag_branches_one_scan_and_empty_flags(spark):
    df = spark.createDataFrame([(True, False, 10.0), (True, False, 20.0), (False, False, 5.0)],
                               "a boolean, b boolean, x double")
    out = flag_branches(df, ["a", "b"], "flag", {"n": lambda on: F.count(on(F.lit(1))), "total": lambda on: F.sum(on(F.col("x")))})
    assert rows(out, "flag", "n", "total") == [("a", 2, 30.0), ("b", 0, None)]


def test_asof_join_point_in_time(spark):
    from stayflow.operators import asof_join

    cal = spark.createDataFrame([(1, D(2021, 7, 12)), (1, D(2021, 7, 13)), (1, D(2021, 7, 14)), (2, D(2021, 7, 12))],
                                "listing_id long, calendar_date date")
    T = dt.datetime
    chg = spark.createDataFrame([
        (1, T(2020, 1, 1), "a", '["Wifi"]'),
        (1, T(2021, 7, 13, 9), "b", '["Wifi","Kitchen"]'),
        (1, T(2021, 7, 13, 18), "c", '["Kitchen"]'),        # later the same day: wins from that day on
        (2, T(2021, 8, 1), "d", '["Heating"]'),            # only after the night: nothing in force
    ], "listing_id long, changed_at timestamp, change_id string, amenities string")
    out = asof_join(cal, chg, "listing_id", "calendar_date", "changed_at", ["amenities"], tiebreak=["change_id"])
    got = rows(out, "listing_id", "calendar_date", "amenities")
    assert got == [(1, D(2021, 7, 12), '["Wifi"]'), (1, D(2021, 7, 13), '["Kitchen"]'),
                   (1, D(2021, 7, 14), '["Kitchen"]'), (2, D(2021, 7, 12), None)]


def test_asof_equals_latest_wins_when_changes_predate_the_window(spark):
    from stayflow.operators import asof_join

    cal = spark.createDataFrame([(k, D(2021, 7, 12) + dt.timedelta(days=i)) for k in (1, 2) for i in range(5)],
                                "listing_id long, calendar_date date")
    chg = spark.createDataFrame([(1, dt.datetime(2020, 1, 1), "x"), (1, dt.datetime(2021, 1, 1), "y"),
                                 (2, dt.datetime(2019, 1, 1), "z")], "listing_id long, changed_at timestamp, amenities string")
    asof = {(r.listing_id, r.amenities) for r in asof_join(cal, chg, "listing_id", "calendar_date", "changed_at",
                                                           ["amenities"]).collect()}
    latest = {(r.listing_id, r.amenities) for r in latest_per_key(chg, ["listing_id"], ["changed_at"]).collect()}
    assert asof == latest


def test_share_of_a_null_group_is_the_same_in_both_forms(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0)], "m string, v double")
    join, window = (sorted((r.v, r.s) for r in share_of_partition(df, "v", ["m"], "s", method=m).collect()) for m in ("join", "window"))
    assert join == window == [(1.0, 0.25), (2.0, 1.0), (3.0, 0.75)]


def test_running_share_beyond_64_bits_stays_exact_and_in_the_jvm(spark):
    from decimal import Decimal

    big = Decimal("9223372036854775807.25")
    df = spark.createDataFrame([(i, big) for i in range(6)], "k long, v decimal(30,2)")
    out = rank_with_running_share(df, "v", ["k"], num_partitions=3, total_col="t")
    assert "Python" not in out._jdf.queryExecution().toString() and "Pandas" not in out._jdf.queryExecution().toString()
    assert [(r.rank, r.running_total, r.t) for r in out.orderBy("rank").collect()] == [(i + 1, big * (i + 1), big * 6) for i in range(6)]
