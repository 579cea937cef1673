"""The layered build: staging -> intermediate -> marts.

Every function takes DataFrames and returns a lazy DataFrame; ``Warehouse``
(warehouse.py) decides which relations are written once and re-read.

Two deliberate differences from a literal reading of the reference:

* vocabulary flags are pivoted once at listing grain (``listing_features``)
  and joined where needed, instead of being carried on every daily row and
  reduced again;
* the listing universe is the set of ids in the change log *before*
  flattening, so a listing whose latest amenity array is empty or malformed
  keeps its row (with no amenities) instead of disappearing.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions.dates import month_start, years_between_boundaries
from stayflow.functions.ratios import avg_exact, div0
from stayflow.functions.text import (
    contains_ci, flag_names, leading_number, mask_pii, money_to_decimal, sentinel_to_null, surrogate_key,
)
from stayflow.operators.dedupe import dedupe, latest_per_key
from stayflow.operators.flatten import flatten_json_array
from stayflow.operators.intervals import interval_join, validity
from stayflow.operators.spans import censor_flags, events_to_spans
from stayflow.operators.timeline import islands
from stayflow.operators.vocab import vocabulary_pivot
from stayflow.sources.seeds import vocabulary_values

AMENITY_PREFIX = "has_"
VERIFICATION_PREFIX = "is_verified_"


@dataclass(frozen=True)
class BuildConfig:
    """Build parameters. Flag names are ``flag_name(prefix, value)`` of
    vocabulary values; the defaults fit the driver-table binding."""

    # the salt of pseudonyms: STAYFLOW_PII_SALT of the environment; the default is for tests only
    pii_salt: str = field(default_factory=lambda: os.environ.get("STAYFLOW_PII_SALT", "stayflow-test-salt"))
    # listings without a listings row: the pinned number if known, and the share of all listings that is never exceeded
    expected_deleted_listings: int | None = None
    max_deleted_share: float = 0.05
    amenities: tuple[str, ...] = field(default_factory=lambda: tuple(vocabulary_values("amenity")))
    verifications: tuple[str, ...] = field(default_factory=lambda: tuple(vocabulary_values("verification")))
    # flags carried on the daily and reservation facts
    fact_flags: tuple[str, ...] = ("has_signup", "has_click", "has_view")
    # flags carried on the listing dimension
    listing_flags: tuple[str, ...] = ("has_signup", "has_click", "has_view", "has_error", "has_purchase")
    # "latest": the daily fact carries the flags of a listing's latest change; "in_force": those of the change in force that
    # night, for change logs that run on into the calendar (the check amenities_predate_calendar fails)
    amenity_history: str = "latest"
    # "exact": sum(complete nights) / count(complete stays); "literal": the
    # reservation-weighted mean of per-listing means (counts censored stays in the weight)
    host_stay_mean: str = "exact"
    roles: dict = field(default_factory=lambda: {
        "primary": "has_signup",   # the headline amenity split (q01, q14)
        "first": "has_click",      # the two amenities a picky renter needs (q03)
        "second": "has_view",
    })

    @property
    def amenity_columns(self) -> list[str]:
        return list(flag_names(AMENITY_PREFIX, self.amenities).values())

    @property
    def verification_columns(self) -> list[str]:
        return list(flag_names(VERIFICATION_PREFIX, self.verifications).values())


# ---------------------------------------------------------------- staging

def stg_listings(raw: DataFrame, cfg: BuildConfig) -> DataFrame:
    return raw.filter(F.col("id").isNotNull()).select(
        F.col("id").alias("listing_id"),
        F.col("name").alias("listing_name"),
        "host_id",
        mask_pii("host_name", cfg.pii_salt).alias("host_name_masked"),
        "host_since",
        "host_location",
        "host_verifications",
        "neighborhood",
        "property_type",
        "room_type",
        "accommodates",
        "bathrooms_text",
        leading_number("bathrooms_text").alias("bathrooms"),
        contains_ci("bathrooms_text", "shared").alias("is_shared_bathroom"),
        "bedrooms",
        "beds",
        "amenities",
        money_to_decimal("price").alias("price"),
        "number_of_reviews",
        F.col("first_review").try_cast("date").alias("first_review_date"),
        F.col("last_review").try_cast("date").alias("last_review_date"),
        "review_scores_rating",
    )


def stg_calendar(raw: DataFrame) -> DataFrame:
    deduped = dedupe(raw, ["listing_id", "date"], order_by=["date"])
    return deduped.select(
        surrogate_key("listing_id", "date").alias("calendar_id"),
        "listing_id",
        F.col("date").alias("calendar_date"),
        F.col("available").alias("is_available"),
        sentinel_to_null("reservation_id").alias("reservation_id"),
        F.col("price").try_cast("decimal(10,2)").alias("price"),
        "minimum_nights",
        "maximum_nights",
    )


def stg_amenities_changelog(raw: DataFrame) -> DataFrame:
    return raw.select(
        surrogate_key("listing_id", "change_at").alias("amenities_change_id"),
        "listing_id",
        F.col("change_at").alias("changed_at"),
        "amenities",
    )


# ----------------------------------------------------------- intermediate

def int_listing_amenities(changelog: DataFrame) -> DataFrame:
    latest = latest_per_key(changelog.select("listing_id", "changed_at", "amenities_change_id", "amenities"),
                            ["listing_id"], ["changed_at"], ["amenities_change_id"])
    return flatten_json_array(latest, "amenities", ["listing_id"], "amenity_name")


def int_host_verifications(listings: DataFrame) -> DataFrame:
    per_host = listings.groupBy("host_id").agg(F.min("host_verifications").alias("host_verifications"))
    return flatten_json_array(per_host, "host_verifications", ["host_id"], "verification_method")


def int_listings(changelog: DataFrame, listings: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Every listing that the change log or the calendar names, so that each daily row has its listing row."""
    named = changelog.select("listing_id")
    if calendar is not None:
        named = named.union(calendar.select("listing_id"))
    universe = named.distinct()
    attrs = listings.select(
        F.col("listing_id").alias("_lid"), "listing_name", "neighborhood", "property_type", "room_type",
        "accommodates", "bedrooms", "beds", "bathrooms", "is_shared_bathroom", "number_of_reviews",
        "review_scores_rating", "first_review_date", "last_review_date", "host_id", "host_name_masked",
        "host_since", "host_location", F.col("price").alias("list_price"),
    )
    joined = universe.join(attrs, F.col("listing_id") == F.col("_lid"), "left")
    return joined.withColumn("is_deleted", F.col("_lid").isNull()).drop("_lid")


def listing_features(bridge: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Amenity pivot at listing grain: count, sorted list, one flag per value."""
    return vocabulary_pivot(bridge, "listing_id", "amenity_name", cfg.amenities, AMENITY_PREFIX,
                            count_col="amenity_count", list_col="amenity_list")


def listing_feature_history(changelog: DataFrame, cfg: BuildConfig) -> DataFrame:
    """The features of ``listing_features`` through time: one row per change, with the days [valid_from, valid_to) it was in force.
    A change without (readable) amenities has no features, as in the latest-wins form."""
    names = F.array_distinct(F.from_json(F.col("amenities"), "array<string>"))
    history = validity(changelog, "listing_id", "changed_at", ["amenities"], tiebreak=["amenities_change_id"]).withColumn("_names", names)
    some = F.size("_names") > 0
    flags = {name: F.array_contains("_names", value) for value, name in flag_names(AMENITY_PREFIX, cfg.amenities).items()}
    return history.select("listing_id", "valid_from", "valid_to",
                          F.when(some, F.size(F.array_compact("_names"))).cast("long").alias("amenity_count"),
                          *(F.when(some, F.coalesce(has, F.lit(False))).alias(n) for n, has in flags.items()))


def night_revenue() -> Column:
    """What a night brings: its price, if it is booked."""
    return F.when(~F.col("is_available"), F.col("price"))


def check_out_date() -> Column:
    return F.date_add("last_night_date", 1)


def int_listing_daily(calendar: DataFrame, listings: DataFrame, features: DataFrame, cfg: BuildConfig) -> DataFrame:
    """``features``: ``listing_features``, or ``listing_feature_history`` with ``cfg.amenity_history = "in_force"``."""
    attrs = listings.select("listing_id", "listing_name", "neighborhood", "property_type", "room_type",
                            "accommodates", "bedrooms", "beds", "host_id", "is_deleted")
    # the calendar has one row per listing and day, so a window of a listing holds no more rows than the calendar has days; runs and both joins
    # go by listing, so nights are shuffled once, and not at all where the calendar's plan has them together by listing
    runs = islands(calendar, "listing_id", "calendar_date", "is_available", whole=True)
    joined = runs.join(attrs, "listing_id", "left")
    if cfg.amenity_history == "in_force":
        joined = interval_join(joined, features, "listing_id", "calendar_date", ["amenity_count", *cfg.fact_flags])
    else:
        joined = joined.join(features.select("listing_id", "amenity_count", *cfg.fact_flags), "listing_id", "left")
    joined = joined.withColumn("revenue", night_revenue())
    return joined.withColumn("month_start_date", month_start("calendar_date"))


def int_reservations(daily: DataFrame) -> DataFrame:
    booked = daily.filter(F.col("reservation_id").isNotNull())
    spans = events_to_spans(
        booked, ["listing_id", "reservation_id"], "calendar_date",
        extra_aggs=[
            F.sum("revenue").alias("reservation_revenue"),
            avg_exact("price").alias("avg_nightly_price"),
            F.bool_or("is_deleted").alias("is_deleted"),
        ],
        first_col="check_in_date", last_col="last_night_date", count_col="nights",
    )
    bounds = daily.select(F.struct(F.min("calendar_date").alias("lo"), F.max("calendar_date").alias("hi"))).scalar()
    flagged = censor_flags(spans, bounds.getField("lo"), bounds.getField("hi"), "check_in_date", "last_night_date")
    return flagged.select(
        surrogate_key("listing_id", "reservation_id").alias("reservation_key"),
        "reservation_id", "listing_id", "check_in_date", "last_night_date",
        check_out_date().alias("check_out_date"),
        "nights", "reservation_revenue", "avg_nightly_price", "is_deleted", "is_contiguous",
        "is_left_censored", "is_right_censored",
    )


def listing_rollup(daily: DataFrame) -> DataFrame:
    """Per-listing measures of the daily grain, computed once for both the
    listing dimension and the host roll-up (one pass over the daily table)."""
    return daily.groupBy("listing_id").agg(
        F.count(F.lit(1)).alias("calendar_days"),
        F.count_if(~F.col("is_available")).alias("booked_nights"),
        F.count_if(F.col("is_available")).alias("available_nights"),
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("total_revenue"),
        avg_exact("price").alias("avg_nightly_price"),
        F.min("price").alias("min_nightly_price"),
        F.max("price").alias("max_nightly_price"),
    )


def int_hosts(listings: DataFrame, rollup: DataFrame, reservations: DataFrame, verifications: DataFrame,
              cfg: BuildConfig) -> DataFrame:
    live = listings.filter(~F.col("is_deleted"))
    perf = rollup.select("listing_id", "calendar_days", "booked_nights", "total_revenue")
    complete = ~(F.col("is_left_censored") | F.col("is_right_censored"))
    stays = reservations.groupBy("listing_id").agg(
        F.count(F.lit(1)).alias("reservations"),
        avg_exact(F.when(complete, F.col("nights"))).alias("avg_nights_per_stay"),
        F.sum(F.when(complete, F.col("nights"))).alias("complete_nights"),
        F.count(F.when(complete, F.lit(1))).alias("complete_stays"),
    )
    per_listing = live.join(perf, "listing_id", "left").join(stays, "listing_id", "left").select(
        "host_id", "listing_id", "host_name_masked", "host_since", "host_location", "list_price",
        "number_of_reviews", "review_scores_rating",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in
          ("calendar_days", "booked_nights", "total_revenue", "reservations")],
        "avg_nights_per_stay", "complete_nights", "complete_stays",
    )
    if cfg.host_stay_mean == "literal":
        stay_mean = div0(F.sum(F.col("avg_nights_per_stay") * F.col("reservations")), F.sum("reservations"))
    else:
        stay_mean = F.sum("complete_nights") / F.nullif(F.sum("complete_stays"), F.lit(0))
    hosts = per_listing.groupBy("host_id").agg(
        F.count(F.lit(1)).alias("listing_count"),
        F.min("host_name_masked").alias("host_name_masked"),
        F.min("host_since").alias("host_since"),
        F.min("host_location").alias("host_location"),
        F.sum("calendar_days").alias("calendar_days"),
        F.sum("booked_nights").alias("booked_nights"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("reservations").alias("reservations"),
        div0(F.sum("booked_nights"), F.sum("calendar_days")).alias("occupancy_rate"),
        stay_mean.cast("double").alias("avg_nights_per_stay"),
        avg_exact("list_price").alias("avg_list_price"),
        F.sum("number_of_reviews").alias("total_reviews"),
        avg_exact("review_scores_rating").alias("avg_review_score"),
    )
    flags = vocabulary_pivot(verifications, "host_id", "verification_method", cfg.verifications,
                             VERIFICATION_PREFIX, count_col="verification_count",
                             list_col="verification_list", count_distinct=False)
    return hosts.join(flags, "host_id", "left")


# ------------------------------------------------------------------ marts

def as_of_date(daily: DataFrame) -> Column:
    """The run's anchor date, max(calendar_date), as a scalar subquery."""
    return daily.select(F.max("calendar_date")).scalar()


def fct_listing_daily(daily: DataFrame, cfg: BuildConfig) -> DataFrame:
    return daily.select(
        "calendar_id", "listing_id", "calendar_date", "month_start_date", "is_available", "reservation_id", "price", "revenue", "minimum_nights", "maximum_nights",
        "is_window_start", "availability_window_seq", "neighborhood", "property_type", "room_type",
        "accommodates", "bedrooms", "beds", "host_id", *cfg.fact_flags, "amenity_count", "is_deleted",
    )


def fct_reservations(reservations: DataFrame, listings: DataFrame, features: DataFrame,
                     cfg: BuildConfig) -> DataFrame:
    attrs = listings.select("listing_id", "listing_name", "neighborhood", "property_type", "room_type",
                            "accommodates", "host_id")
    feats = features.select("listing_id", *cfg.fact_flags, "amenity_count")
    r = reservations.join(attrs, "listing_id", "left").join(feats, "listing_id", "left")
    return r.select(
        "reservation_key", "reservation_id", "listing_id", "check_in_date", "last_night_date",
        "check_out_date", month_start("check_in_date").alias("check_in_month"), "nights",
        "reservation_revenue", "avg_nightly_price", "is_contiguous", "is_left_censored", "is_right_censored",
        (F.col("is_left_censored") | F.col("is_right_censored")).alias("is_censored"),
        "listing_name", "neighborhood", "property_type", "room_type", "accommodates", "host_id",
        *cfg.fact_flags, "amenity_count", "is_deleted",
    )


def dim_listings(listings: DataFrame, daily: DataFrame, rollup: DataFrame, features: DataFrame,
                 cfg: BuildConfig) -> DataFrame:
    feats = features.select("listing_id", F.col("amenity_count").alias("_amenity_count"),
                            *[F.col(f).alias(f"_{f}") for f in cfg.listing_flags])
    j = listings.join(rollup, "listing_id", "left").join(feats, "listing_id", "left")
    has_daily = F.col("calendar_days").isNotNull()  # listing-level values exist only through daily rows
    return j.select(
        "listing_id", "listing_name", "neighborhood", "property_type", "room_type", "accommodates",
        "bedrooms", "beds", "bathrooms", "is_shared_bathroom", "number_of_reviews", "review_scores_rating",
        "first_review_date", "last_review_date", as_of_date(daily).alias("as_of_date"), "host_id",
        "host_name_masked", "host_since", "host_location", "list_price",
        F.when(has_daily, F.col("_amenity_count")).alias("amenity_count"),
        *[F.when(has_daily, F.col(f"_{f}")).alias(f) for f in cfg.listing_flags],
        "calendar_days", "booked_nights", "available_nights", "total_revenue", "avg_nightly_price",
        "min_nightly_price", "max_nightly_price",
        div0("booked_nights", "calendar_days").alias("occupancy_rate"), "is_deleted",
    )


def dim_hosts(hosts: DataFrame, daily: DataFrame, cfg: BuildConfig) -> DataFrame:
    as_of = as_of_date(daily)
    return hosts.select(
        "host_id", "host_name_masked", "host_since", as_of.alias("as_of_date"),
        years_between_boundaries("host_since", as_of).alias("host_tenure_years"),
        "host_location", "verification_count", "verification_list", *cfg.verification_columns,
        "listing_count", (F.col("listing_count") > 1).alias("is_multi_listing_host"),
        "calendar_days", "booked_nights", "total_revenue", "reservations", "occupancy_rate",
        "avg_nights_per_stay", "avg_list_price",
        div0("total_revenue", "listing_count").alias("revenue_per_listing"),
        "total_reviews", "avg_review_score",
    )
