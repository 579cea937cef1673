"""The business questions as metric-layer queries plus wrappers.

Each function takes a ``Warehouse`` and returns a DataFrame. The ``order by``
of the original blocks is presentation only and is kept through ``orderBy``
where it is cheap; results are compared order-insensitively.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayflow.functions.ratios import avg_exact, band, div0, least_strict, round_half_up
from stayflow.operators.ranking import rank_with_running_share, share_of_partition, top_k_share
from stayflow.operators.union import flag_branches
from stayflow.plans import models
from stayflow.plans.warehouse import Warehouse


def finalize(df: DataFrame, places: int = 4) -> DataFrame:
    """Integers -> bigint, decimals and doubles -> double rounded to ``places``."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = round_half_up(c, places)
        elif isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _m(wh: Warehouse):
    return models.all_models(wh)


NOT_DELETED_D = lambda m: ~m("daily.is_deleted")
NOT_DELETED_P = lambda m: ~m("listing.is_deleted")


# q01 ---------------------------------------------------------------------
def q01_by_month(wh):
    flag = wh.cfg.roles["primary"]
    monthly = _m(wh)["D"].query(["daily.total_revenue", "daily.booked_nights", "daily.listings"],
                                ["daily.month_start_date", f"daily.{flag}"])
    # rows per month are bounded by the flag's two values: a window over the aggregate reads it once
    shared = share_of_partition(monthly, "total_revenue", ["month_start_date"], "_share", method="window")
    return shared.select("month_start_date", flag, "listings", "booked_nights", "total_revenue",
                         round_half_up(F.lit(100) * F.col("_share").cast("double"), 1).alias("pct_of_month_revenue"))


def q01_full_year(wh):
    flag = wh.cfg.roles["primary"]
    return _m(wh)["D"].query(["daily.total_revenue", "daily.booked_nights", "daily.occupancy_rate",
                              "daily.achieved_nightly_rate", "daily.listings"], [f"daily.{flag}"])


# q02 ---------------------------------------------------------------------
def q02_price_change(wh):
    d = _m(wh)["D"]
    fct = wh.fct_listing_daily()
    bounds = fct.select(F.struct(F.min("calendar_date").alias("lo"), F.max("calendar_date").alias("hi"))).scalar()
    first_day, last_day = bounds.getField("lo"), bounds.getField("hi")
    # the months of both days, so that only their partitions of the daily table are read
    months = F.trunc(first_day, "month"), F.trunc(last_day, "month")
    endpoints = d.query(["daily.avg_nightly_price"], ["daily.listing_id", "listing.neighborhood", "daily.calendar_date"],
                        where=lambda m: m("daily.month_start_date").isin(*months) & m("daily.calendar_date").isin(first_day, last_day)
                        & ~m("daily.is_deleted"))
    per_listing = endpoints.groupBy("listing_id", "neighborhood").agg(
        F.max(F.when(F.col("calendar_date") == first_day, F.col("avg_nightly_price"))).alias("start_price"),
        F.max(F.when(F.col("calendar_date") == last_day, F.col("avg_nightly_price"))).alias("end_price"),
    )
    return per_listing.groupBy("neighborhood").agg(
        F.count(F.lit(1)).alias("listings"),
        round_half_up(avg_exact(F.col("end_price") - F.col("start_price")).cast("double"), 2).alias("avg_price_increase"),
        round_half_up(avg_exact("start_price").cast("double"), 2).alias("avg_start_price"),
        round_half_up(avg_exact("end_price").cast("double"), 2).alias("avg_end_price"),
    )


def q02_monthly_trend(wh):
    return _m(wh)["D"].query(["daily.avg_nightly_price", "daily.achieved_nightly_rate", "daily.listings"],
                             ["listing.neighborhood", "daily.month_start_date"], where=NOT_DELETED_D)


# q03 ---------------------------------------------------------------------
def q03_picky_renter(wh):
    first, second = wh.cfg.roles["first"], wh.cfg.roles["second"]
    windows = _m(wh)["D"].query(
        ["daily.calendar_nights", "daily.max_maximum_nights"],
        ["daily.listing_id", "listing.listing_name", "listing.neighborhood", "daily.availability_window_seq"],
        where=lambda m: m("daily.is_available") & m(f"daily.{first}") & m(f"daily.{second}"))
    clamped = windows.withColumn("longest", least_strict("calendar_nights", "max_maximum_nights"))
    return clamped.groupBy("listing_id", "listing_name", "neighborhood").agg(
        F.max("longest").alias("longest_possible_stay_nights"),
        F.max("calendar_nights").alias("longest_availability_window"),
        F.max("max_maximum_nights").alias("owner_max_nights"),
        F.count(F.lit(1)).alias("availability_windows"),
    )


def q03_all_windows(wh):
    windows = _m(wh)["D"].query(
        ["daily.calendar_nights", "daily.max_maximum_nights", "daily.max_minimum_nights"],
        ["daily.listing_id", "listing.listing_name", "daily.availability_window_seq"],
        where=lambda m: m("daily.is_available"))
    return windows.select(
        "listing_id", "listing_name", "availability_window_seq",
        F.col("calendar_nights").alias("window_length_nights"),
        F.col("max_minimum_nights").alias("minimum_nights"),
        F.col("max_maximum_nights").alias("owner_max_nights"),
        least_strict("calendar_nights", "max_maximum_nights").alias("longest_possible_stay_nights"),
        (F.col("calendar_nights") > F.col("max_maximum_nights")).alias("is_cap_bound"),
    )


# q04 / q05 / q08 / q12 / q13 / q26: listing-performance slices -------------------
_OCC4 = ["listing.listings", "listing.avg_occupancy_rate", "listing.total_booked_nights",
         "listing.total_available_nights"]


def q04_by_neighborhood(wh):
    return _m(wh)["P"].query(_OCC4, ["listing.neighborhood"], where=NOT_DELETED_P)


def q04_by_room_type(wh):
    return _m(wh)["P"].query(_OCC4, ["listing.room_type"], where=NOT_DELETED_P)


def q04_by_both(wh):
    return _m(wh)["P"].query(["listing.listings", "listing.avg_occupancy_rate", "listing.avg_achieved_rate"],
                             ["listing.neighborhood", "listing.room_type"], where=NOT_DELETED_P)


def q05_detail(wh):
    return _m(wh)["P"].query(
        ["listing.total_available_nights", "listing.avg_list_price", "listing.avg_review_score", "listing.total_reviews"],
        ["listing.listing_id", "listing.listing_name", "listing.neighborhood", "listing.room_type"],
        where=lambda m: m("listing.was_never_booked"))


def q05_count(wh):
    return _m(wh)["P"].query(["listing.listings", "listing.never_booked_listings", "listing.portfolio_revenue"])


def q05_by_neighborhood(wh):
    return _m(wh)["P"].query(["listing.listings", "listing.never_booked_listings", "listing.avg_occupancy_rate"],
                             ["listing.neighborhood"], where=NOT_DELETED_P)


# q06 ---------------------------------------------------------------------
def q06_by_month(wh):
    return _m(wh)["D"].query(["daily.total_revenue", "daily.calendar_nights", "daily.booked_nights",
                              "daily.occupancy_rate", "daily.achieved_nightly_rate", "daily.avg_nightly_price",
                              "daily.listings"], ["daily.month_start_date"])


def q06_by_month_and_neighborhood(wh):
    return _m(wh)["D"].query(["daily.total_revenue", "daily.occupancy_rate", "daily.achieved_nightly_rate",
                              "daily.listings"], ["daily.month_start_date", "listing.neighborhood"],
                             where=NOT_DELETED_D)


# q07 ---------------------------------------------------------------------
def q07_concentration(wh):
    rev = _m(wh)["P"].query(["listing.portfolio_revenue"], ["listing.listing_id", "listing.listing_name"])
    ranked = rank_with_running_share(rev, "portfolio_revenue", ["listing_id"], rank_col="revenue_rank",
                                     running_col="_running", total_col="_total")
    total = F.col("_total")
    return ranked.select(
        "listing_id", "listing_name",
        round_half_up(F.col("portfolio_revenue").cast("double"), 2).alias("revenue"),
        "revenue_rank",
        round_half_up((F.lit(100) * F.col("portfolio_revenue") / F.nullif(total, F.lit(0))).cast("double"), 2)
        .alias("pct_of_total"),
        round_half_up((F.lit(100) * F.col("_running") / F.nullif(total, F.lit(0))).cast("double"), 2)
        .alias("running_pct_of_total"),
    )


def q07_top_five_share(wh):
    rev = _m(wh)["P"].query(["listing.portfolio_revenue"], ["listing.listing_id"])
    s = top_k_share(rev, "portfolio_revenue", 5, ["listing_id"], count_col="listings", total_col="total_revenue",
                    top_col="top_5_revenue", pct_col="top_5_pct_of_total")
    return s.select(
        "listings",
        round_half_up(F.col("total_revenue").cast("double"), 2).alias("total_revenue"),
        round_half_up(F.col("top_5_revenue").cast("double"), 2).alias("top_5_revenue"),
        round_half_up(F.col("top_5_pct_of_total").cast("double"), 2).alias("top_5_pct_of_total"),
    )


# q08 ---------------------------------------------------------------------
_RATE = ["listing.avg_list_price", "listing.avg_achieved_rate", "listing.avg_discount_to_list"]


def q08_overall(wh):
    return _m(wh)["P"].query(["listing.listings", *_RATE])


def q08_by_listing(wh):
    return _m(wh)["P"].query([*_RATE, "listing.avg_occupancy_rate"],
                             ["listing.listing_id", "listing.listing_name", "listing.neighborhood"], where=NOT_DELETED_P)


def q08_by_segment(wh):
    return _m(wh)["P"].query(["listing.listings", *_RATE], ["listing.neighborhood", "listing.room_type"],
                             where=NOT_DELETED_P)


# q09 ---------------------------------------------------------------------
PRICE_BANDS = [(75, "1. under 75"), (150, "2. 75 to 149"), (250, "3. 150 to 249"), (400, "4. 250 to 399")]


def q09_price_band(wh):
    facts = _m(wh)["P"].query(facts=["listing.list_price", "listing.occupancy_rate", "listing.total_revenue",
                                     "listing.achieved_nightly_rate"], dimensions=["listing.listing_id"])
    banded = facts.filter(F.col("list_price").isNotNull()).withColumn(
        "list_price_band", band("list_price", PRICE_BANDS, "5. 400 and over"))
    return banded.groupBy("list_price_band").agg(
        F.count(F.lit(1)).alias("listings"),
        round_half_up(avg_exact("list_price").cast("double"), 2).alias("avg_list_price"),
        round_half_up(avg_exact("occupancy_rate"), 4).alias("avg_occupancy_rate"),
        round_half_up(avg_exact("total_revenue").cast("double"), 2).alias("avg_revenue"),
        round_half_up(avg_exact("achieved_nightly_rate").cast("double"), 2).alias("avg_achieved_rate"),
    )


def q09_scatter(wh):
    return _m(wh)["P"].query(["listing.avg_list_price", "listing.avg_achieved_rate", "listing.avg_occupancy_rate",
                              "listing.portfolio_revenue"],
                             ["listing.listing_id", "listing.listing_name", "listing.room_type"], where=NOT_DELETED_P)


# q10 ---------------------------------------------------------------------
_DAY6 = ["daily.calendar_nights", "daily.booked_nights", "daily.occupancy_rate", "daily.avg_nightly_price",
         "daily.achieved_nightly_rate", "daily.total_revenue"]


def q10_by_day(wh):
    return _m(wh)["D"].query(_DAY6, ["daily.day_of_week"])


def q10_weekend_premium(wh):
    return _m(wh)["D"].query(_DAY6, ["daily.is_weekend"])


def q10_by_day_and_room_type(wh):
    return _m(wh)["D"].query(["daily.occupancy_rate", "daily.avg_nightly_price", "daily.achieved_nightly_rate"],
                             ["daily.day_of_week", "listing.room_type"], where=NOT_DELETED_D)


# q11 ---------------------------------------------------------------------
def q11_by_score_band(wh):
    facts = _m(wh)["P"].query(facts=["listing.review_scores_rating", "listing.number_of_reviews",
                                     "listing.occupancy_rate", "listing.achieved_nightly_rate",
                                     "listing.total_revenue"], dimensions=["listing.listing_id"])
    bands = [(4.0, "1. under 4.0"), (4.5, "2. 4.0 to 4.49"), (4.8, "3. 4.5 to 4.79")]
    b = facts.withColumn("review_score_band", band("review_scores_rating", bands, "4. 4.8 and over",
                                                   null_label="0. never reviewed"))
    return b.groupBy("review_score_band").agg(
        F.count(F.lit(1)).alias("listings"),
        round_half_up(avg_exact("number_of_reviews"), 1).alias("avg_reviews"),
        round_half_up(avg_exact("occupancy_rate"), 4).alias("avg_occupancy_rate"),
        round_half_up(avg_exact("achieved_nightly_rate").cast("double"), 2).alias("avg_achieved_rate"),
        round_half_up(avg_exact("total_revenue").cast("double"), 2).alias("avg_revenue"),
    )


def q11_by_review_volume(wh):
    facts = _m(wh)["P"].query(facts=["listing.number_of_reviews", "listing.occupancy_rate",
                                     "listing.achieved_nightly_rate"], dimensions=["listing.listing_id"])
    n = F.col("number_of_reviews")
    label = (F.when(n == 0, "0. none").when(n < 10, "1. 1 to 9").when(n < 50, "2. 10 to 49")
             .when(n < 100, "3. 50 to 99").otherwise("4. 100 and over"))
    return facts.withColumn("review_count_band", label).groupBy("review_count_band").agg(
        F.count(F.lit(1)).alias("listings"),
        round_half_up(avg_exact("occupancy_rate"), 4).alias("avg_occupancy_rate"),
        round_half_up(avg_exact("achieved_nightly_rate").cast("double"), 2).alias("avg_achieved_rate"),
    )


def q11_per_listing(wh):
    return _m(wh)["P"].query(["listing.avg_review_score", "listing.total_reviews", "listing.avg_occupancy_rate",
                              "listing.avg_achieved_rate"],
                             ["listing.listing_id", "listing.listing_name", "listing.has_reviews"], where=NOT_DELETED_P)


# q12 ---------------------------------------------------------------------
def q12_by_capacity(wh):
    return _m(wh)["P"].query(["listing.listings", "listing.avg_revenue_per_guest", "listing.avg_revenue_per_listing",
                              "listing.avg_occupancy_rate", "listing.avg_achieved_rate"],
                             ["listing.accommodates"], where=NOT_DELETED_P)


def q12_by_listing(wh):
    return _m(wh)["P"].query(["listing.avg_revenue_per_guest", "listing.portfolio_revenue",
                              "listing.avg_occupancy_rate"],
                             ["listing.listing_id", "listing.listing_name", "listing.accommodates",
                              "listing.room_type"], where=NOT_DELETED_P)


def q12_by_room_type(wh):
    return _m(wh)["P"].query(["listing.listings", "listing.avg_revenue_per_guest", "listing.avg_revenue_per_listing"],
                             ["listing.room_type"], where=NOT_DELETED_P)


# q13 ---------------------------------------------------------------------
def q13_split(wh):
    return _m(wh)["P"].query(["listing.listings", "listing.avg_list_price", "listing.avg_achieved_rate",
                              "listing.avg_occupancy_rate", "listing.avg_revenue_per_listing",
                              "listing.avg_review_score"], ["listing.is_shared_bathroom"], where=NOT_DELETED_P)


def q13_by_room_type(wh):
    return _m(wh)["P"].query(["listing.listings", "listing.avg_list_price", "listing.avg_achieved_rate",
                              "listing.avg_occupancy_rate"], ["listing.room_type", "listing.is_shared_bathroom"],
                             where=NOT_DELETED_P)


# q14 ---------------------------------------------------------------------
def q14_by_amenity(wh):
    """One aggregate per amenity flag, in one scan (instead of a union of scans)."""
    dim = wh.dim_listings().filter(~F.col("is_deleted"))
    achieved = F.col("total_revenue") / F.nullif(F.col("booked_nights"), F.lit(0))
    return flag_branches(dim, wh.cfg.listing_flags, "amenity", {
        "listings": lambda on: F.count(on(F.lit(1))),
        "avg_achieved_rate": lambda on: avg_exact(on(achieved)),
        "avg_list_price": lambda on: avg_exact(on(F.col("list_price"))),
        "avg_occupancy_rate": lambda on: avg_exact(on(F.col("occupancy_rate"))),
        "avg_revenue_per_listing": lambda on: avg_exact(on(F.col("total_revenue"))),
    })


def q14_primary_split(wh):
    flag = wh.cfg.roles["primary"]
    return _m(wh)["P"].query(["listing.listings", "listing.avg_achieved_rate", "listing.avg_list_price",
                              "listing.avg_occupancy_rate", "listing.avg_revenue_per_listing"],
                             [f"listing.{flag}"], where=NOT_DELETED_P)


AMENITY_COUNT_BANDS = [(15, "1. under 15"), (25, "2. 15 to 24"), (35, "3. 25 to 34")]


def q14_by_amenity_count(wh):
    facts = _m(wh)["P"].query(facts=["listing.amenity_count", "listing.achieved_nightly_rate",
                                     "listing.occupancy_rate", "listing.total_revenue"],
                              dimensions=["listing.listing_id", "listing.is_deleted"])
    b = facts.filter(~F.col("is_deleted")).withColumn(
        "amenity_count_band", band("amenity_count", AMENITY_COUNT_BANDS, "4. 35 and over"))
    return b.groupBy("amenity_count_band").agg(
        F.count(F.lit(1)).alias("listings"),
        round_half_up(avg_exact("amenity_count"), 1).alias("avg_amenity_count"),
        round_half_up(avg_exact("achieved_nightly_rate").cast("double"), 2).alias("avg_achieved_rate"),
        round_half_up(avg_exact("occupancy_rate"), 4).alias("avg_occupancy_rate"),
        round_half_up(avg_exact("total_revenue").cast("double"), 2).alias("avg_revenue"),
    )


# q15 ---------------------------------------------------------------------
def q15_by_listing(wh):
    return _m(wh)["D"].query(["daily.distinct_prices", "daily.min_nightly_price", "daily.max_nightly_price",
                              "daily.avg_nightly_price", "daily.achieved_nightly_rate", "daily.occupancy_rate"],
                             ["daily.listing_id", "listing.listing_name"])


PRICING_BANDS = [(1, "1. never changed"), (5, "2. 2 to 5 rates"), (20, "3. 6 to 20 rates")]


def q15_banded(wh):
    per = _m(wh)["D"].query(["daily.distinct_prices", "daily.min_nightly_price", "daily.max_nightly_price",
                             "daily.occupancy_rate", "daily.total_revenue"], ["daily.listing_id"])
    b = per.withColumn("pricing_style", band("distinct_prices", PRICING_BANDS, "4. over 20 rates", inclusive=True))
    return b.groupBy("pricing_style").agg(
        F.count(F.lit(1)).alias("listings"),
        round_half_up(avg_exact("distinct_prices"), 1).alias("avg_distinct_prices"),
        round_half_up(avg_exact(F.col("max_nightly_price") - F.col("min_nightly_price")).cast("double"), 2)
        .alias("avg_price_spread"),
        round_half_up(avg_exact("occupancy_rate"), 4).alias("avg_occupancy_rate"),
        round_half_up(avg_exact("total_revenue").cast("double"), 2).alias("avg_revenue"),
    )


def q15_static_pricers(wh):
    per = _m(wh)["D"].query(["daily.distinct_prices", "daily.avg_nightly_price", "daily.occupancy_rate",
                             "daily.total_revenue"], ["daily.listing_id", "listing.listing_name", "listing.room_type"],
                            where=NOT_DELETED_D)
    return per.filter(F.col("distinct_prices") == 1)


# q16 ---------------------------------------------------------------------
MIN_NIGHT_BANDS = [(1, "1. one night"), (3, "2. 2 to 3 nights"), (7, "3. 4 to 7 nights"), (30, "4. 8 to 30 nights")]


def q16_by_night(wh):
    nights = _m(wh)["D"].query(facts=["daily.minimum_nights", "daily.price", "daily.revenue"],
                               dimensions=["daily.listing_id", "daily.calendar_date", "daily.is_available"])
    b = nights.withColumn("minimum_nights_band", band("minimum_nights", MIN_NIGHT_BANDS, "5. over 30 nights",
                                                      inclusive=True))
    return b.groupBy("minimum_nights_band").agg(
        F.count_distinct("listing_id").alias("listings"),
        F.count(F.lit(1)).alias("calendar_nights"),
        F.count_if(~F.col("is_available")).alias("booked_nights"),
        round_half_up(div0(F.count_if(~F.col("is_available")), F.count(F.lit(1))), 4).alias("occupancy_rate"),
        round_half_up(avg_exact("price").cast("double"), 2).alias("avg_nightly_price"),
        round_half_up(avg_exact("revenue").cast("double"), 2).alias("achieved_nightly_rate"),
        round_half_up(F.sum("revenue").cast("double"), 2).alias("total_revenue"),
    )


def q16_by_listing(wh):
    per = _m(wh)["D"].query(["daily.avg_minimum_nights", "daily.max_minimum_nights", "daily.occupancy_rate",
                             "daily.avg_nightly_price", "daily.achieved_nightly_rate", "daily.total_revenue"],
                            ["daily.listing_id"])
    b = per.withColumn("minimum_nights_band", band("avg_minimum_nights", MIN_NIGHT_BANDS, "5. over 30 nights",
                                                   inclusive=True))
    return b.groupBy("minimum_nights_band").agg(
        F.count(F.lit(1)).alias("listings"),
        round_half_up(avg_exact("avg_minimum_nights"), 2).alias("avg_minimum_nights"),
        round_half_up(avg_exact("occupancy_rate"), 4).alias("avg_occupancy_rate"),
        round_half_up(avg_exact("avg_nightly_price").cast("double"), 2).alias("avg_nightly_price"),
        round_half_up(avg_exact("achieved_nightly_rate").cast("double"), 2).alias("avg_achieved_rate"),
        round_half_up(avg_exact("total_revenue").cast("double"), 2).alias("avg_revenue"),
    )


def q16_scatter(wh):
    return _m(wh)["D"].query(["daily.avg_minimum_nights", "daily.max_minimum_nights", "daily.occupancy_rate",
                              "daily.avg_nightly_price", "daily.total_revenue"],
                             ["daily.listing_id", "listing.listing_name", "listing.room_type"], where=NOT_DELETED_D)


# q17 ---------------------------------------------------------------------
def q17_summary(wh):
    return _m(wh)["R"].query(["reservations", "booked_nights", "total_revenue", "avg_length_of_stay",
                              "avg_booking_value", "avg_nightly_rate", "censored_reservations"])


def q17_by_month(wh):
    return _m(wh)["R"].query(["reservations", "booked_nights", "avg_length_of_stay", "avg_booking_value"],
                             ["check_in_month"])


def q17_censoring(wh):
    return _m(wh)["R"].query(["reservations", "censored_reservations", "avg_length_of_stay", "avg_length_of_stay_all"])


# q18 / q19 / q20: hosts ----------------------------------------------------
def q18_leaderboard(wh):
    return _m(wh)["H"].query(["avg_revenue_per_listing", "avg_occupancy_rate", "listings", "total_reservations",
                              "avg_length_of_stay"], ["host_id", "host_name_masked", "is_multi_listing_host"])


def q18_top_ten(wh):
    q = _m(wh)["H"].query(["avg_revenue_per_listing", "avg_occupancy_rate", "listings", "total_reservations"],
                          ["host_id", "host_name_masked"])
    return q.orderBy(F.col("avg_revenue_per_listing").desc(), F.col("host_id").asc()).limit(10)


def q18_portfolio_total(wh):
    return _m(wh)["H"].query(["hosts", "listings", "portfolio_revenue", "avg_revenue_per_listing",
                              "occupancy_rate_weighted", "avg_listings_per_host", "max_listings_per_host"])


def q19_segments(wh):
    return _m(wh)["H"].query(["hosts", "listings", "avg_revenue_per_listing", "median_revenue_per_listing",
                              "avg_occupancy_rate", "avg_length_of_stay", "avg_listings_per_host"],
                             ["is_multi_listing_host"])


def q20_by_tenure(wh):
    facts = _m(wh)["H"].query(facts=["host_tenure_years", "revenue_per_listing", "occupancy_rate", "listing_count"],
                              dimensions=["host_id"])
    return facts.groupBy("host_tenure_years").agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("listing_count").alias("listings"),
        round_half_up(avg_exact("revenue_per_listing").cast("double"), 2).alias("avg_revenue_per_listing"),
        round_half_up(avg_exact("occupancy_rate"), 4).alias("avg_occupancy_rate"),
    )


def q20_by_host_since(wh):
    return _m(wh)["H"].query(["hosts", "listings", "avg_tenure_years", "avg_revenue_per_listing",
                              "avg_occupancy_rate"], ["host_since"])


# q21 ---------------------------------------------------------------------
_PPX = ["daily.avg_nightly_price", "daily.avg_price_per_bedroom", "daily.avg_price_per_bed", "daily.avg_price_per_guest"]


def q21_by_room_type(wh):
    per = _m(wh)["D"].query(_PPX, ["daily.listing_id", "listing.room_type", "listing.bedrooms", "listing.beds"],
                            where=NOT_DELETED_D)
    r2 = lambda c: round_half_up(avg_exact(c).cast("double"), 2)
    return per.groupBy("room_type").agg(
        F.count(F.lit(1)).alias("listings"),
        r2("avg_nightly_price").alias("avg_nightly_price"),
        r2("avg_price_per_bedroom").alias("avg_price_per_bedroom"),
        r2("avg_price_per_bed").alias("avg_price_per_bed"),
        r2("avg_price_per_guest").alias("avg_price_per_guest"),
        F.count_if(F.col("bedrooms").isNull()).alias("listings_missing_bedrooms"),
        F.count_if(F.col("beds") == 0).alias("listings_zero_beds"),
    )


def q21_by_listing(wh):
    return _m(wh)["D"].query([*_PPX, "daily.occupancy_rate"],
                             ["daily.listing_id", "listing.listing_name", "listing.room_type", "listing.bedrooms",
                              "listing.beds", "listing.accommodates"], where=NOT_DELETED_D)


def q21_by_neighborhood(wh):
    return _m(wh)["D"].query(["daily.listings", *_PPX], ["listing.neighborhood"], where=NOT_DELETED_D)


# q22 ---------------------------------------------------------------------
def q22_count(wh):
    return _m(wh)["R"].query(["reservations", "month_boundary_reservations", "total_revenue"])


def q22_by_month(wh):
    return _m(wh)["R"].query(["reservations", "month_boundary_reservations", "total_revenue"], ["check_in_month"])


def q22_detail(wh):
    return _m(wh)["R"].query(["reservations", "booked_nights", "total_revenue"],
                             ["reservation_key", "listing_id", "check_in_date", "last_night_date", "check_in_month"],
                             where=lambda m: m("spans_month_boundary"))


# q23 ---------------------------------------------------------------------
_STAY = ["reservations", "booked_nights", "avg_length_of_stay", "median_length_of_stay", "max_length_of_stay",
         "censored_reservations"]


def q23_by_neighborhood(wh):
    return _m(wh)["R"].query(_STAY, ["neighborhood"], where=lambda m: ~m("is_deleted"))


def q23_by_room_type(wh):
    return _m(wh)["R"].query(_STAY, ["room_type"], where=lambda m: ~m("is_deleted"))


def q23_by_neighborhood_room_type(wh):
    return _m(wh)["R"].query(["reservations", "avg_length_of_stay", "median_length_of_stay", "censored_reservations"],
                             ["neighborhood", "room_type"], where=lambda m: ~m("is_deleted"))


# q24 ---------------------------------------------------------------------
def q24_stalest(wh):
    return _m(wh)["P"].query(["listing.avg_days_since_last_review", "listing.total_reviews",
                              "listing.avg_occupancy_rate", "listing.portfolio_revenue"],
                             ["listing.listing_id", "listing.listing_name", "listing.neighborhood",
                              "listing.last_review_date", "listing.has_reviews"],
                             where=lambda m: m("listing.has_reviews") & ~m("listing.is_deleted"))


def q24_never_reviewed(wh):
    return _m(wh)["P"].query(["listing.listings", "listing.avg_days_since_last_review",
                              "listing.stalest_days_since_review", "listing.total_reviews",
                              "listing.avg_occupancy_rate"], ["listing.has_reviews"], where=NOT_DELETED_P)


STALENESS_BANDS = [(3, "1. within 3 months"), (12, "2. 4 to 12 months"), (36, "3. 1 to 3 years")]


def q24_by_staleness_band(wh):
    facts = _m(wh)["P"].query(facts=["listing.months_since_last_review", "listing.number_of_reviews",
                                     "listing.occupancy_rate", "listing.total_revenue"],
                              dimensions=["listing.listing_id", "listing.is_deleted"])
    b = facts.filter(~F.col("is_deleted")).withColumn(
        "staleness_band", band("months_since_last_review", STALENESS_BANDS, "4. over 3 years",
                               null_label="0. never reviewed", inclusive=True))
    return b.groupBy("staleness_band").agg(
        F.count(F.lit(1)).alias("listings"),
        round_half_up(avg_exact("number_of_reviews"), 1).alias("avg_reviews"),
        round_half_up(avg_exact("occupancy_rate"), 4).alias("avg_occupancy_rate"),
        round_half_up(avg_exact("total_revenue").cast("double"), 2).alias("avg_revenue"),
    )


# q25 ---------------------------------------------------------------------
def _q25_classified(wh):
    """Runs of open nights, what their nights ask for together, and whether a stay of the minimum length fits in."""
    runs = wh.fct_listing_daily().filter("is_available").groupBy("listing_id", "availability_window_seq").agg(
        F.count(F.lit(1)).alias("window_length_nights"), F.max("minimum_nights").alias("minimum_nights"),
        F.sum("price").cast("double").alias("window_asking_value"))
    return runs.join(wh.dim_listings().select("listing_id", "listing_name"), "listing_id").withColumn(
        "is_unbookable", F.col("window_length_nights") < F.col("minimum_nights"))


def q25_portfolio(wh):
    c = _q25_classified(wh)
    unb = F.col("is_unbookable")
    return c.agg(
        F.count(F.lit(1)).alias("availability_windows"),
        F.count_if(unb).alias("unbookable_windows"),
        F.sum(F.when(unb, F.col("window_length_nights"))).alias("unbookable_nights"),
        round_half_up(F.sum(F.when(unb, F.col("window_asking_value"))), 2).alias("unbookable_asking_value"),
        F.sum("window_length_nights").alias("all_available_nights"),
        round_half_up(F.sum("window_asking_value"), 2).alias("all_available_asking_value"),
        round_half_up(F.lit(100) * F.sum(F.when(unb, F.col("window_asking_value")))
                / F.nullif(F.sum("window_asking_value"), F.lit(0)), 2).alias("pct_of_open_inventory_unbookable"),
    )


def q25_by_listing(wh):
    c = _q25_classified(wh)
    unb = F.col("is_unbookable")
    g = c.groupBy("listing_id", "listing_name").agg(
        F.count(F.lit(1)).alias("availability_windows"),
        F.count_if(unb).alias("unbookable_windows"),
        F.max("minimum_nights").alias("strictest_minimum_nights"),
        F.sum(F.when(unb, F.col("window_length_nights"))).alias("unbookable_nights"),
        round_half_up(F.sum(F.when(unb, F.col("window_asking_value"))), 2).alias("unbookable_asking_value"),
    )
    return g.filter(F.col("unbookable_windows") > 0)


def q25_detail(wh):
    c = _q25_classified(wh)
    return c.filter("is_unbookable").select(
        "listing_id", "listing_name", "availability_window_seq", "window_length_nights", "minimum_nights",
        round_half_up("window_asking_value", 2).alias("window_asking_value"))


# q26 ---------------------------------------------------------------------
def q26_density(wh):
    return _m(wh)["P"].query(["listing.listings", "listing.avg_achieved_rate", "listing.avg_list_price",
                              "listing.avg_occupancy_rate", "listing.portfolio_revenue",
                              "listing.avg_revenue_per_listing"], ["listing.neighborhood"], where=NOT_DELETED_P)


def q26_density_by_room_type(wh):
    return _m(wh)["P"].query(["listing.listings", "listing.avg_achieved_rate", "listing.avg_occupancy_rate"],
                             ["listing.neighborhood", "listing.room_type"], where=NOT_DELETED_P)


QUESTIONS = {name: fn for name, fn in globals().items() if name[:1] == "q" and name[1:3].isdigit() and callable(fn)
             and not name.startswith("_")}


# Presentation order of each block. "x" = ascending (NULLs last), "-x" = descending
# (NULLs first), "-x!" = descending with NULLs last, "@weekday:x" = Monday..Sunday.
ORDER = {
    "q01_by_month": ["month_start_date", "@primary"], "q01_full_year": ["@primary"],
    "q02_price_change": ["-avg_price_increase"], "q02_monthly_trend": ["neighborhood", "month_start_date"],
    "q03_picky_renter": ["-longest_possible_stay_nights"], "q03_all_windows": ["-longest_possible_stay_nights"],
    "q04_by_neighborhood": ["-avg_occupancy_rate"], "q04_by_room_type": ["-avg_occupancy_rate"],
    "q04_by_both": ["neighborhood", "room_type"],
    "q05_detail": ["listing_id"], "q05_by_neighborhood": ["-never_booked_listings"],
    "q06_by_month": ["month_start_date"], "q06_by_month_and_neighborhood": ["neighborhood", "month_start_date"],
    "q07_concentration": ["revenue_rank"],
    "q08_by_listing": ["-avg_discount_to_list"], "q08_by_segment": ["-avg_discount_to_list"],
    "q09_price_band": ["list_price_band"], "q09_scatter": ["-portfolio_revenue"],
    "q10_by_day": ["@weekday:day_of_week"], "q10_weekend_premium": ["is_weekend"],
    "q10_by_day_and_room_type": ["room_type", "@weekday:day_of_week"],
    "q11_by_score_band": ["review_score_band"], "q11_by_review_volume": ["review_count_band"],
    "q11_per_listing": ["-avg_review_score!"],
    "q12_by_capacity": ["accommodates"], "q12_by_listing": ["-avg_revenue_per_guest"],
    "q12_by_room_type": ["-avg_revenue_per_guest"],
    "q13_split": ["is_shared_bathroom"], "q13_by_room_type": ["room_type", "is_shared_bathroom"],
    "q14_by_amenity": ["-avg_achieved_rate"], "q14_primary_split": ["-@primary"],
    "q14_by_amenity_count": ["amenity_count_band"],
    "q15_by_listing": ["-distinct_prices"], "q15_banded": ["pricing_style"], "q15_static_pricers": ["-total_revenue"],
    "q16_by_night": ["minimum_nights_band"], "q16_by_listing": ["minimum_nights_band"],
    "q16_scatter": ["-avg_minimum_nights"],
    "q17_by_month": ["check_in_month"],
    "q18_leaderboard": ["-avg_revenue_per_listing"], "q18_top_ten": ["-avg_revenue_per_listing", "host_id"],
    "q19_segments": ["-is_multi_listing_host"],
    "q20_by_tenure": ["host_tenure_years"], "q20_by_host_since": ["host_since"],
    "q21_by_room_type": ["-avg_nightly_price"], "q21_by_listing": ["-avg_price_per_bedroom!"],
    "q21_by_neighborhood": ["-avg_price_per_bedroom!"],
    "q22_by_month": ["check_in_month"], "q22_detail": ["check_in_date"],
    "q23_by_neighborhood": ["-avg_length_of_stay"], "q23_by_room_type": ["-avg_length_of_stay"],
    "q23_by_neighborhood_room_type": ["neighborhood", "room_type"],
    "q24_stalest": ["-avg_days_since_last_review!"], "q24_never_reviewed": ["-has_reviews"],
    "q24_by_staleness_band": ["staleness_band"],
    "q25_by_listing": ["-unbookable_asking_value"], "q25_detail": ["-window_asking_value"],
    "q26_density": ["-listings"], "q26_density_by_room_type": ["neighborhood", "-listings"],
}

_WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def present(name: str, df: DataFrame, cfg=None) -> DataFrame:
    """Apply the block's presentation order (a sort of its, usually small, result)."""
    spec = ORDER.get(name)
    if not spec:
        return df
    primary = (cfg.roles["primary"] if cfg is not None else "has_signup")
    keys = []
    for item in spec:
        desc = item.startswith("-")
        item = item.lstrip("-")
        nulls_last_desc = item.endswith("!")
        item = item.rstrip("!").replace("@primary", primary)
        if item.startswith("@weekday:"):
            c = item.split(":", 1)[1]
            col = F.array_position(F.array(*[F.lit(d) for d in _WEEKDAYS]), F.col(c))
        else:
            col = F.col(item)
        if desc:
            keys.append(col.desc_nulls_last() if nulls_last_desc else col.desc_nulls_first())
        else:
            keys.append(col.asc_nulls_last())
    return df.orderBy(*keys)
