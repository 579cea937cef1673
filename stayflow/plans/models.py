"""The four semantic models over the marts.

Metric definitions follow the reference's semantic views; flag dimensions are
whatever the build configuration carries (``BuildConfig.fact_flags`` on the
daily and reservation facts, ``listing_flags`` on the listing dimension, the
verification vocabulary on hosts).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stayflow.functions.dates import day_name, is_weekend, month_start, months_between_boundaries
from stayflow.functions.ratios import avg_exact, div0, safe_div
from stayflow.operators.selection import median
from stayflow.plans.semantic import Model, Relationship, Table
from stayflow.plans.warehouse import Warehouse


def _plain(table: str, cols) -> dict[str, str]:
    return {f"{table}.{c}": c for c in cols}


def listing_daily(wh: Warehouse) -> Model:
    cfg = wh.cfg
    daily = Table("daily", wh.fct_listing_daily, "calendar_id", grain=("listing_id", "calendar_date"), derived={
        "price_per_bedroom": lambda c: safe_div(c("price"), c("bedrooms")),
        "price_per_bed": lambda c: safe_div(c("price"), c("beds")),
        "price_per_guest": lambda c: safe_div(c("price"), c("accommodates")),
        "day_of_week": lambda c: day_name(c("calendar_date")),
        "is_weekend": lambda c: is_weekend(c("calendar_date")),
    })
    listing = Table("listing", wh.dim_listings, "listing_id")
    host = Table("host", wh.dim_hosts, "host_id")
    facts = _plain("daily", ["price", "revenue", "minimum_nights", "maximum_nights", "price_per_bedroom",
                             "price_per_bed", "price_per_guest"])
    dims = {
        **_plain("daily", ["listing_id", "calendar_date", "month_start_date", "day_of_week", "is_weekend",
                           "is_available", "reservation_id", "availability_window_seq", "is_deleted",
                           *cfg.fact_flags, "amenity_count"]),
        **_plain("listing", ["listing_name", "neighborhood", "property_type", "room_type", "accommodates",
                             "bedrooms", "beds", "is_shared_bathroom", "list_price", "review_scores_rating"]),
        **_plain("host", ["host_tenure_years", "is_multi_listing_host"]),
    }
    booked = lambda c: ~c("is_available")
    metrics = {
        "daily.total_revenue": lambda c: F.sum(c("revenue")),
        "daily.calendar_nights": lambda c: F.count(F.lit(1)),
        "daily.booked_nights": lambda c: F.count_if(booked(c)),
        "daily.available_nights": lambda c: F.count_if(c("is_available")),
        "daily.occupancy_rate": lambda c: div0(F.count_if(booked(c)), F.count(F.lit(1))),
        "daily.avg_nightly_price": lambda c: avg_exact(c("price")),
        "daily.achieved_nightly_rate": lambda c: avg_exact(c("revenue")),
        "daily.min_nightly_price": lambda c: F.min(c("price")),
        "daily.max_nightly_price": lambda c: F.max(c("price")),
        "daily.distinct_prices": lambda c: F.count_distinct(c("price")),
        "daily.listings": lambda c: F.count_distinct(c("listing_id")),
        "daily.hosts": lambda c: F.count_distinct(c("host_id")),
        "daily.avg_price_per_bedroom": lambda c: avg_exact(c("price_per_bedroom")),
        "daily.avg_price_per_bed": lambda c: avg_exact(c("price_per_bed")),
        "daily.avg_price_per_guest": lambda c: avg_exact(c("price_per_guest")),
        "daily.avg_minimum_nights": lambda c: avg_exact(c("minimum_nights")),
        "daily.max_maximum_nights": lambda c: F.max(c("maximum_nights")),
        "daily.max_minimum_nights": lambda c: F.max(c("minimum_nights")),
    }
    # the daily fact carries these listing attributes (same values as the listing dimension)
    denorm = {f"listing.{c}": c for c in ("neighborhood", "property_type", "room_type", "accommodates",
                                          "bedrooms", "beds")}
    return Model("sem_listing_daily", "daily", {"daily": daily, "listing": listing, "host": host},
                 [Relationship("daily", "listing_id", "listing", "listing_id", complete=True),
                  Relationship("listing", "host_id", "host", "host_id")],
                 facts, dims, metrics, denorm)


def listing_performance(wh: Warehouse) -> Model:
    cfg = wh.cfg
    achieved = lambda c: safe_div(c("total_revenue"), c("booked_nights"))
    listing = Table("listing", wh.dim_listings, "listing_id", derived={
        "revenue_per_guest": lambda c: safe_div(c("total_revenue"), c("accommodates")),
        "achieved_nightly_rate": achieved,
        "discount_to_list": lambda c: c("list_price").cast("double") - achieved(c),
        "days_since_last_review": lambda c: F.date_diff(c("as_of_date"), c("last_review_date")),
        "months_since_last_review": lambda c: months_between_boundaries(c("last_review_date"), c("as_of_date")),
        "was_never_booked": lambda c: c("total_revenue") == 0,
        "has_reviews": lambda c: c("number_of_reviews") > 0,
    })
    host = Table("host", wh.dim_hosts, "host_id")
    facts = _plain("listing", ["total_revenue", "occupancy_rate", "avg_nightly_price", "list_price",
                               "booked_nights", "available_nights", "calendar_days", "number_of_reviews",
                               "review_scores_rating", "revenue_per_guest", "achieved_nightly_rate",
                               "discount_to_list", "days_since_last_review", "months_since_last_review",
                               "amenity_count"])
    dims = {
        **_plain("listing", ["listing_id", "listing_name", "neighborhood", "property_type", "room_type",
                             "accommodates", "bedrooms", "beds", "bathrooms", "is_shared_bathroom",
                             "first_review_date", "last_review_date", "as_of_date", "was_never_booked",
                             "has_reviews", "is_deleted", *cfg.listing_flags, "amenity_count"]),
        **_plain("host", ["host_id", "host_name_masked", "host_location", "host_tenure_years",
                          "is_multi_listing_host", "verification_count"]),
    }
    metrics = {
        "listing.listings": lambda c: F.count(F.lit(1)),
        "listing.portfolio_revenue": lambda c: F.sum(c("total_revenue")),
        "listing.avg_revenue_per_listing": lambda c: avg_exact(c("total_revenue")),
        "listing.median_revenue_per_listing": lambda c: median(c("total_revenue")),
        "listing.max_revenue": lambda c: F.max(c("total_revenue")),
        "listing.avg_occupancy_rate": lambda c: avg_exact(c("occupancy_rate")),
        "listing.occupancy_rate_weighted": lambda c: div0(F.sum(c("booked_nights")), F.sum(c("calendar_days"))),
        "listing.total_booked_nights": lambda c: F.sum(c("booked_nights")),
        "listing.total_available_nights": lambda c: F.sum(c("available_nights")),
        "listing.avg_list_price": lambda c: avg_exact(c("list_price")),
        "listing.avg_achieved_rate": lambda c: avg_exact(c("achieved_nightly_rate")),
        "listing.avg_discount_to_list": lambda c: avg_exact(c("discount_to_list")),
        "listing.avg_revenue_per_guest": lambda c: avg_exact(c("revenue_per_guest")),
        "listing.avg_review_score": lambda c: avg_exact(c("review_scores_rating")),
        "listing.total_reviews": lambda c: F.sum(c("number_of_reviews")),
        "listing.never_booked_listings": lambda c: F.count_if(c("total_revenue") == 0),
        "listing.avg_amenity_count": lambda c: avg_exact(c("amenity_count")),
        "listing.avg_days_since_last_review": lambda c: avg_exact(c("days_since_last_review")),
        "listing.stalest_days_since_review": lambda c: F.max(c("days_since_last_review")),
        "listing.hosts": lambda c: F.count_distinct(c("host_id")),
    }
    return Model("sem_listing_performance", "listing", {"listing": listing, "host": host},
                 [Relationship("listing", "host_id", "host", "host_id")], facts, dims, metrics)


def reservations(wh: Warehouse) -> Model:
    cfg = wh.cfg
    res = Table("reservation", wh.fct_reservations, "reservation_key", derived={
        "spans_month_boundary": lambda c: month_start(c("last_night_date")) != c("check_in_month"),
    })
    listing = Table("listing", wh.dim_listings, "listing_id")
    host = Table("host", wh.dim_hosts, "host_id")
    facts = _plain("reservation", ["nights", "reservation_revenue", "avg_nightly_price"])
    dims = {
        **_plain("reservation", ["reservation_key", "listing_id", "listing_name", "check_in_date",
                                 "last_night_date", "check_out_date", "check_in_month", "spans_month_boundary",
                                 "is_censored", "is_left_censored", "is_right_censored", "is_contiguous",
                                 "is_deleted", *cfg.fact_flags, "amenity_count"]),
        **_plain("listing", ["neighborhood", "property_type", "room_type", "accommodates",
                             "is_shared_bathroom", "review_scores_rating"]),
        **_plain("host", ["is_multi_listing_host", "host_tenure_years"]),
    }
    complete = lambda c: F.when(~c("is_censored"), c("nights"))
    metrics = {
        "reservation.reservations": lambda c: F.count(F.lit(1)),
        "reservation.booked_nights": lambda c: F.sum(c("nights")),
        "reservation.total_revenue": lambda c: F.sum(c("reservation_revenue")),
        "reservation.avg_length_of_stay": lambda c: avg_exact(complete(c)),
        "reservation.avg_length_of_stay_all": lambda c: avg_exact(c("nights")),
        "reservation.median_length_of_stay": lambda c: median(complete(c)),
        "reservation.max_length_of_stay": lambda c: F.max(complete(c)),
        "reservation.avg_booking_value": lambda c: avg_exact(c("reservation_revenue")),
        "reservation.avg_nightly_rate": lambda c: avg_exact(c("avg_nightly_price")),
        "reservation.censored_reservations": lambda c: F.count_if(c("is_censored")),
        "reservation.month_boundary_reservations": lambda c: F.count_if(c("spans_month_boundary")),
        "reservation.listings": lambda c: F.count_distinct(c("listing_id")),
        "reservation.hosts": lambda c: F.count_distinct(c("host_id")),
    }
    denorm = {f"listing.{c}": c for c in ("neighborhood", "property_type", "room_type", "accommodates")}
    return Model("sem_reservations", "reservation", {"reservation": res, "listing": listing, "host": host},
                 [Relationship("reservation", "listing_id", "listing", "listing_id", complete=True),
                  Relationship("listing", "host_id", "host", "host_id")], facts, dims, metrics, denorm)


def host_performance(wh: Warehouse) -> Model:
    cfg = wh.cfg
    host = Table("host", wh.dim_hosts, "host_id", derived={
        "is_single_listing_host": lambda c: c("listing_count") == 1,
        "has_bookings": lambda c: c("reservations") > 0,
    })
    facts = _plain("host", ["total_revenue", "revenue_per_listing", "occupancy_rate", "listing_count",
                            "booked_nights", "calendar_days", "reservations", "avg_nights_per_stay",
                            "avg_list_price", "host_tenure_years", "verification_count", "total_reviews",
                            "avg_review_score"])
    dims = _plain("host", ["host_id", "host_name_masked", "host_since", "as_of_date", "host_location",
                           "is_multi_listing_host", "is_single_listing_host", "has_bookings",
                           "verification_list", *cfg.verification_columns])
    metrics = {
        "host.hosts": lambda c: F.count(F.lit(1)),
        "host.listings": lambda c: F.sum(c("listing_count")),
        "host.portfolio_revenue": lambda c: F.sum(c("total_revenue")),
        "host.avg_revenue_per_listing": lambda c: avg_exact(c("revenue_per_listing")),
        "host.avg_revenue_per_host": lambda c: avg_exact(c("total_revenue")),
        "host.median_revenue_per_listing": lambda c: median(c("revenue_per_listing")),
        "host.avg_occupancy_rate": lambda c: avg_exact(c("occupancy_rate")),
        "host.occupancy_rate_weighted": lambda c: div0(F.sum(c("booked_nights")), F.sum(c("calendar_days"))),
        "host.avg_listings_per_host": lambda c: avg_exact(c("listing_count")),
        "host.max_listings_per_host": lambda c: F.max(c("listing_count")),
        "host.total_reservations": lambda c: F.sum(c("reservations")),
        "host.avg_length_of_stay": lambda c: avg_exact(c("avg_nights_per_stay")),
        "host.avg_tenure_years": lambda c: avg_exact(c("host_tenure_years")),
        "host.avg_verification_count": lambda c: avg_exact(c("verification_count")),
        "host.portfolio_avg_review_score": lambda c: avg_exact(c("avg_review_score")),
        "host.portfolio_total_reviews": lambda c: F.sum(c("total_reviews")),
        "host.portfolio_avg_list_price": lambda c: avg_exact(c("avg_list_price")),
        "host.multi_listing_hosts": lambda c: F.count_if(c("listing_count") > 1),
    }
    return Model("sem_host_performance", "host", {"host": host}, [], facts, dims, metrics)


def all_models(wh: Warehouse) -> dict[str, Model]:
    return {"D": listing_daily(wh), "P": listing_performance(wh), "R": reservations(wh), "H": host_performance(wh)}
