from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayflow.plans import models, quality
from stayflow.plans.warehouse import Warehouse
from tests.fixtures import CONFIG, DAYS, raw_frames


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse(spark, "unused", cfg=CONFIG, materialize=False, raw=raw_frames(spark))


def by_key(df, key):
    return {r[key]: r for r in df.collect()}


def test_staging_listings(wh):
    s = by_key(wh.stg_listings(), "listing_id")
    assert set(s) == {1, 2, 3}                                   # NULL id rejected
    assert s[1].price == Decimal("1234.00") and s[3].price is None
    assert s[1].bathrooms == Decimal("2.5") and s[3].bathrooms is None
    assert s[2].is_shared_bathroom is True and s[1].is_shared_bathroom is False
    assert s[3].host_name_masked is None and len(s[1].host_name_masked) == 16
    assert s[2].first_review_date is None


def test_staging_calendar_dedupes_the_grain(wh):
    cal = wh.stg_calendar()
    assert cal.count() == 40
    assert cal.filter(F.col("reservation_id").isNull()).count() == cal.filter("is_available").count()


def test_universe_and_deleted_flag(wh):
    lst = by_key(wh.int_listings(), "listing_id")
    assert set(lst) == {1, 2, 3, 4, 5}
    assert {k for k, r in lst.items() if r.is_deleted} == {4, 5}
    assert lst[4].listing_name is None


def test_latest_amenities_and_pivot(wh):
    f = by_key(wh.listing_features(), "listing_id")
    assert f[1].has_first_aid_kit is True and f[1].amenity_count == 3
    assert f[2].amenity_count == 1                               # equal timestamps: exactly one event wins
    assert f[3].amenity_list == ["Kitchen", "Sauna"] and f[3].has_kitchen is True
    assert 5 not in f                                             # malformed array: no bridge rows


def test_daily_revenue_and_islands(wh):
    d = wh.int_listing_daily()
    assert d.filter("is_available and revenue is not null").count() == 0
    l1 = [(r.is_window_start, r.availability_window_seq)
          for r in d.filter("listing_id = 1").orderBy("calendar_date").collect()]
    assert [s for _, s in l1] == [1, 1, 1, 1, 2, 2, 2, 2, 2, 2]
    # run lengths sum to open nights
    runs = d.filter("is_available").groupBy("listing_id", "availability_window_seq").count()
    assert runs.agg(F.sum("count")).first()[0] == d.filter("is_available").count()


def test_reservations(wh):
    r = {(x.listing_id, x.reservation_id): x for x in wh.int_reservations().collect()}
    assert set(r) == {(1, "R1"), (1, "R2"), (2, "R1"), (4, "R7")}   # R1 on two listings: two reservations
    assert r[(1, "R1")].nights == 2 and r[(1, "R1")].is_contiguous
    assert r[(1, "R2")].is_right_censored and not r[(1, "R2")].is_left_censored
    assert r[(2, "R1")].is_left_censored and r[(2, "R1")].is_right_censored and r[(2, "R1")].nights == 10
    assert r[(4, "R7")].is_deleted and r[(4, "R7")].is_left_censored
    assert r[(1, "R1")].reservation_key != r[(2, "R1")].reservation_key
    booked = wh.int_listing_daily().filter("not is_available").count()
    assert sum(x.nights for x in r.values()) == booked


def test_marts(wh):
    dl = by_key(wh.dim_listings(), "listing_id")
    assert dl[1].as_of_date == DAYS[-1]
    assert (dl[1].calendar_days, dl[1].booked_nights, dl[1].available_nights) == (10, 3, 7)
    assert dl[3].total_revenue == 0 and dl[3].occupancy_rate == 0.0
    assert dl[5].calendar_days is None and dl[5].amenity_count is None
    assert dl[4].is_deleted and dl[4].total_revenue == Decimal("210.00")
    dh = by_key(wh.dim_hosts(), "host_id")
    assert dh[100].listing_count == 2 and dh[100].is_multi_listing_host
    assert str(dh[100].host_since) == "2014-05-05"                # rebuilt with min()
    assert dh[100].verification_count == 3                        # min() of the two arrays' text, flattened
    assert dh[100].is_verified_government_id is True
    assert dh[200].verification_count is None                      # NULL, not 0, without bridge rows
    assert dh[100].host_tenure_years == 7
    # exact stay mean: complete stays only (R1 on listing 1; listing 2's stay is censored)
    assert dh[100].avg_nights_per_stay == 2.0
    fr = wh.fct_reservations()
    assert fr.filter("is_censored").count() == 3
    daily_rev = wh.fct_listing_daily().agg(F.sum("revenue")).first()[0]
    assert fr.agg(F.sum("reservation_revenue")).first()[0] == daily_rev
    # host totals miss only the deleted listing's revenue
    assert dh[100].total_revenue + dh[200].total_revenue == daily_rev - dl[4].total_revenue


def test_literal_host_stay_mean_variant(spark):
    from dataclasses import replace
    w = Warehouse(spark, "unused", cfg=replace(CONFIG, host_stay_mean="literal"), materialize=False,
                  raw=raw_frames(spark))
    dh = by_key(w.dim_hosts(), "host_id")
    # reservation-weighted mean of per-listing means: (2.0 * 2 + NULL * 1) / 3 -> div0 on a NULL product sum
    assert dh[100].avg_nights_per_stay == pytest.approx(4.0 / 3)


def test_quality_checks_on_fixture(wh):
    res = {r.check_name: r.failing_rows for r in quality.run_checks(wh).collect()}
    assert res["unique_stg_calendar_grain"] == 0
    assert res["availability_matches_reservation"] == 0
    assert res["stay_cap_binds"] == 0                         # listing 1's five-night run exceeds its cap of 3
    assert res["relationship_calendar_to_listings"] == 10      # the deleted listing's nights (warn)
    assert res["host_attributes_consistent"] == 1
    assert res["amenity_values_outside_vocabulary"] == 1       # Sauna
    assert res["accepted_range_price"] == 0
    assert res["deleted_listing_count"] == 0


def test_quality_checks_go_red_on_seeded_defects(spark):
    import dataclasses

    raw = raw_frames(spark)
    raw["listings"] = raw["listings"].filter("id <> 1")                       # a load that lost a listing
    raw["calendar"] = raw["calendar"].withColumn("price", F.when(F.col("listing_id") != 2, F.col("price")))
    wh = Warehouse(spark, "unused", cfg=CONFIG, materialize=False, raw=raw)
    res = {r.check_name: (r.failing_rows > 0, r.status) for r in quality.run_checks(wh, [
        "deleted_listing_count", "not_null_stg_calendar", "relationship_calendar_to_listings", "unique_dim_hosts_host_id"]).collect()}
    assert res["deleted_listing_count"] == (True, "warn") and res["not_null_stg_calendar"] == (True, "fail")
    assert res["relationship_calendar_to_listings"] == (True, "warn") and res["unique_dim_hosts_host_id"] == (False, "pass")
    with pytest.raises(quality.QualityError, match="not_null_stg_calendar"):
        wh.build_all(enforce=True)
    none_pinned = dataclasses.replace(CONFIG, expected_deleted_listings=None, max_deleted_share=0.9)
    ok = Warehouse(spark, "unused", cfg=none_pinned, materialize=False, raw=raw)
    assert quality.run_checks(ok, ["deleted_listing_count"]).first().failing_rows == 0


def test_answers_do_not_depend_on_the_named_member_when_the_change_log_lacks_a_listing(spark):
    raw = raw_frames(spark)
    raw["amenities_changelog"] = raw["amenities_changelog"].filter("listing_id <> 2")
    wh = Warehouse(spark, "unused", cfg=CONFIG, materialize=False, raw=raw)
    model = models.listing_daily(wh)
    assert model.validate() == []
    by = {d: sum(r.calendar_nights for r in model.query(["daily.calendar_nights"], [d]).collect())
          for d in ("listing.neighborhood", "listing.listing_name", "daily.listing_id")}
    assert len(set(by.values())) == 1, by


def test_metric_layer_null_keys_drop_out_unless_kept(wh):
    d = models.listing_daily(wh)
    total = d.query(["daily.total_revenue"]).first()[0]
    by_host = d.query(["daily.total_revenue"], ["host.is_multi_listing_host"])
    kept = d.query(["daily.total_revenue"], ["host.is_multi_listing_host"], keep_unmatched=True)
    s = lambda df: sum(r.total_revenue for r in df.collect() if r.total_revenue is not None)
    assert s(by_host) == total - Decimal("210.00")
    assert s(kept) == total


def test_metric_layer_windows_and_clamp(wh):
    w = models.listing_daily(wh).query(["daily.calendar_nights", "daily.max_maximum_nights"],
                                       ["daily.listing_id", "daily.availability_window_seq"],
                                       where=lambda m: m("daily.is_available"))
    got = sorted((r.listing_id, r.availability_window_seq, r.calendar_nights, r.max_maximum_nights) for r in w.collect())
    assert got == [(1, 1, 2, 3), (1, 2, 5, 3), (3, 1, 10, 20), (4, 1, 7, 5)]


def test_views_and_presentation_order(wh, spark):
    from stayflow.plans import questions

    wh.register_views(("dim_listings",))
    assert spark.sql("SELECT count(*) FROM dim_listings").first()[0] == 5
    df = spark.createDataFrame([("Sun", 1.0), ("Mon", None), ("Wed", 2.0)], "day_of_week string, avg_review_score double")
    days = [r[0] for r in questions.present("q10_by_day", df).collect()]
    assert days == ["Mon", "Wed", "Sun"]
    scores = [r[1] for r in questions.present("q11_per_listing", df).collect()]
    assert scores == [2.0, 1.0, None]              # desc nulls last where the block asks for it
