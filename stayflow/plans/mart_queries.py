"""The marts themselves and the point-in-time amenity view, as registered queries."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.operators.asof import asof_join
from stayflow.operators.distinct import dense_ids, distinct_counts, distinct_state
from stayflow.operators.intervals import interval_join, validity
from stayflow.plans import build
from stayflow.plans.oracle import FACT_FLAGS, LISTING_FLAGS, PRELUDE, VERIFICATIONS, _norm, _slug, sv
from stayflow.plans.questions import finalize
from stayflow.plans.warehouse import Warehouse
from stayflow.session import shared_dir
from stayflow.sources.sinks import commit_build, diff_builds, guarded_overwrite, read_build, write_build

R, I, O = "r", "i", "o"


def _mart(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finalize(Warehouse.for_dir(spark, sf_dir).relation(name))
    run.__name__ = f"mart_{name}"
    return run


def amenities_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each calendar night with the amenity array in force that night (as-of
    join on the change log), next to the latest array the build uses."""
    wh = Warehouse.for_dir(spark, sf_dir)
    cal = wh.stg_calendar().select("listing_id", "calendar_date")
    chg = wh.stg_amenities_changelog()
    asof = asof_join(cal, chg, "listing_id", "calendar_date", "changed_at", ["amenities"],
                     tiebreak=["amenities_change_id"], matched_col="amenities_changed_at")
    latest = wh.listing_features().select("listing_id", F.col("amenity_count").alias("latest_amenity_count"))
    parsed = F.from_json(F.col("amenities"), "array<string>")
    out = asof.join(latest, "listing_id", "left").select(
        "listing_id", "calendar_date", "amenities_changed_at",
        F.size(F.array_distinct(parsed)).alias("amenity_count_as_of"), "latest_amenity_count")
    return finalize(out.withColumn("amenity_count_as_of",
                                   F.when(F.col("amenities_changed_at").isNull(), F.lit(None))
                                   .otherwise(F.col("amenity_count_as_of"))))


def amenities_validity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nights of ``amenities_point_in_time`` through validity intervals and a join by time buckets."""
    wh = Warehouse.for_dir(spark, sf_dir)
    history = validity(wh.stg_amenities_changelog(), "listing_id", "changed_at", ["amenities"], tiebreak=["amenities_change_id"])
    nights = interval_join(wh.stg_calendar().select("listing_id", "calendar_date"), history, "listing_id", "calendar_date",
                           ["valid_from", "valid_to", "changed_at", "amenities"], bucket_days=14)
    names = F.from_json("amenities", "array<string>")
    return finalize(nights.select(
        "listing_id", "calendar_date", "valid_from", "valid_to", F.col("changed_at").alias("amenities_changed_at"),
        F.when(F.col("changed_at").isNotNull(), F.size(F.array_distinct(names))).alias("amenity_count_as_of")))


def daily_flags_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily fact with the amenities in force that night in place of the latest ones (build option ``amenity_history``)."""
    wh = Warehouse.for_dir(spark, sf_dir)
    cfg = replace(wh.cfg, amenity_history="in_force")
    daily = build.int_listing_daily(wh.calendar_by_listing(), wh.int_listings(), wh.listing_feature_history(), cfg)
    return finalize(daily.select("listing_id", "calendar_date", "is_window_start", "availability_window_seq", "amenity_count", *cfg.fact_flags))


def revenue_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total revenue through each of the four metric models. The daily, listing
    and reservation models agree; the host model misses exactly the revenue of
    listings that have no parent row (their host is unknown)."""
    from stayflow.plans import models

    wh = Warehouse.for_dir(spark, sf_dir)
    m = models.all_models(wh)
    daily = m["D"].query(["daily.total_revenue"]).select(F.col("total_revenue").alias("daily_model_revenue"))
    scalar = lambda df, c: df.select(F.col(c)).scalar()
    listing = scalar(m["P"].query(["listing.portfolio_revenue"]), "portfolio_revenue")
    reservation = scalar(m["R"].query(["reservation.total_revenue"]), "total_revenue")
    host = scalar(m["H"].query(["host.portfolio_revenue"]), "portfolio_revenue")
    deleted = scalar(m["P"].query(["listing.portfolio_revenue"], where=lambda c: c("listing.is_deleted")),
                     "portfolio_revenue")
    out = daily.select(
        "daily_model_revenue",
        listing.alias("listing_model_revenue"),
        reservation.alias("reservation_model_revenue"),
        host.alias("host_model_revenue"),
        F.coalesce(deleted, F.lit(0)).alias("deleted_listing_revenue"),
    )
    return finalize(out.withColumn(
        "host_gap_is_deleted_revenue",
        F.col("daily_model_revenue") - F.col("host_model_revenue") == F.col("deleted_listing_revenue")))


def listing_peak_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stayflow.plans import models

    return finalize(models.listing_performance(Warehouse.for_dir(spark, sf_dir)).query(
        ["listing.max_revenue", "listing.listings"], ["listing.neighborhood", "listing.room_type"]))


HOST_METRICS = ("hosts", "multi_listing_hosts", "avg_revenue_per_host", "avg_verification_count", "portfolio_avg_review_score",
                "portfolio_total_reviews", "portfolio_avg_list_price")


def host_portfolios(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stayflow.plans import models

    return finalize(models.host_performance(Warehouse.for_dir(spark, sf_dir)).query(
        [f"host.{m}" for m in HOST_METRICS], ["host.host_location", "host.has_bookings"]))


DISTINCT_GRAINS = (("month_start_date", "neighborhood"), ("month_start_date",), ("neighborhood",), ())


def listings_and_hosts_by_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings and hosts of the daily fact at four grains, all from one mergeable state at the finest."""
    wh = Warehouse.for_dir(spark, sf_dir)
    daily = wh.fct_listing_daily().select("month_start_date", "neighborhood", "listing_id", "host_id")
    listings, hosts = dense_ids(wh.dim_listings(), "listing_id", "listing_no"), dense_ids(wh.dim_hosts(), "host_id", "host_no")
    state = distinct_state(daily.join(listings, "listing_id").join(hosts, "host_id", "left"), DISTINCT_GRAINS[0], {"listings": "listing_no", "hosts": "host_no"})
    path = shared_dir(spark, "stayflow-builds", wh.build_id, "distinct_state")
    state.write.mode("overwrite").parquet(path)
    state = spark.read.schema(state.schema).parquet(path)
    parts = []
    for grain in DISTINCT_GRAINS:
        one = distinct_counts(state, grain, ["listings", "hosts"])
        parts.append(one.select(F.lit(",".join(grain)).alias("grain"), *((F.col(c) if c in grain else F.lit(None).cast(state.schema[c].dataType)).alias(c)
                                                                         for c in DISTINCT_GRAINS[0]), "listings", "hosts"))
    return finalize(reduce(DataFrame.unionByName, parts))


Q04_METRICS = ("listings", "avg_occupancy_rate", "avg_achieved_rate", "median_revenue_per_listing", "hosts")
Q04_GRAINS = (("neighborhood",), ("room_type",), ("neighborhood", "room_type"), ())


def q04_all_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blocks of q04 (and the total) from one scan of the listing model, with a median and a distinct count beside them."""
    from stayflow.plans import models

    model = models.listing_performance(Warehouse.for_dir(spark, sf_dir))
    return finalize(model.query_grains([f"listing.{m}" for m in Q04_METRICS], [[f"listing.{d}" for d in g] for g in Q04_GRAINS],
                                       where=lambda c: ~c("listing.is_deleted")))


def guarded_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The host mart written twice through the guarded sink: created, then overwritten from a frame that reads the table itself.
    The catalog entry goes again; its last version is what is read."""
    wh = Warehouse.for_dir(spark, sf_dir)
    table = f"guarded_dim_hosts_{wh.build_id}"
    place = shared_dir(spark, "stayflow-builds", wh.build_id, "guarded")
    columns = ["host_id", "listing_count", "calendar_days", "booked_nights", "total_revenue"]
    guarded_overwrite(wh.dim_hosts().select(*columns), table, location=place)
    last = guarded_overwrite(spark.table(table), table, location=place)
    schema = spark.table(table).schema
    spark.sql(f"DROP TABLE {table}")
    return finalize(spark.read.schema(schema).parquet(last.location))


def build_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two retained builds of the listing mart, the second without never-reviewed listings and with deleted ones renamed:
    what changed, and in which columns."""
    wh = Warehouse.for_dir(spark, sf_dir)
    path = shared_dir(spark, "stayflow-builds", wh.build_id, "retained_listings")
    mart = wh.dim_listings().select("listing_id", "listing_name", "list_price", "number_of_reviews", "is_deleted")
    write_build(mart, path, 1)
    write_build(mart.where("coalesce(number_of_reviews, 1) > 0").withColumn(
        "listing_name", F.when(F.col("is_deleted"), F.lit("gone")).otherwise(F.col("listing_name"))), path, 2)
    return finalize(diff_builds(spark, path, "listing_id", 1, 2))


def marts_before_last_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four marts committed together as one build, then a build with other marts; rows of the build that was current in between."""
    wh = Warehouse.for_dir(spark, sf_dir)
    path = shared_dir(spark, "stayflow-builds", wh.build_id, "published")
    between = wh.publish(path, 1).committed_at
    commit_build(spark, path, 2, {n: df.limit(0) for n, df in wh.build_all().items()})
    at = datetime.fromisoformat(between)
    measure = {"fct_listing_daily": "price", "fct_reservations": "reservation_revenue", "dim_listings": "total_revenue", "dim_hosts": "total_revenue"}
    parts = [read_build(spark, path, as_of=at, table=n).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(c).alias("measure")).select(F.lit(n).alias("mart"), "n_rows", F.col("measure").cast("decimal(38,2)").alias("measure"))
             for n, c in measure.items()]
    return finalize(reduce(DataFrame.unionByName, parts))


SPARK = {f.__name__: f for f in [_mart(n) for n in ("fct_listing_daily", "fct_reservations", "dim_listings",
                                                     "dim_hosts")] + [
    amenities_point_in_time, amenities_validity_join, daily_flags_in_force, revenue_reconciliation, listing_peak_revenue, host_portfolios, guarded_mart, build_diff, marts_before_last_build,
    listings_and_hosts_by_grain, q04_all_grains]}

_VFLAGS = [_slug("is_verified_", v) for v in VERIFICATIONS]
KINDS = {
    "fct_listing_daily": {
        "calendar_id": O, "listing_id": I, "calendar_date": O, "month_start_date": O, "is_available": O,
        "reservation_id": O, "price": R, "revenue": R, "minimum_nights": I, "maximum_nights": I,
        "is_window_start": O, "availability_window_seq": I, "neighborhood": O, "property_type": O,
        "room_type": O, "accommodates": I, "bedrooms": I, "beds": I, "host_id": I, **{f: O for f in FACT_FLAGS},
        "amenity_count": I, "is_deleted": O},
    "fct_reservations": {
        "reservation_key": O, "reservation_id": O, "listing_id": I, "check_in_date": O, "last_night_date": O,
        "check_out_date": O, "check_in_month": O, "nights": I, "reservation_revenue": R, "avg_nightly_price": R,
        "is_contiguous": O, "is_left_censored": O, "is_right_censored": O, "is_censored": O, "listing_name": O,
        "neighborhood": O, "property_type": O, "room_type": O, "accommodates": I, "host_id": I,
        **{f: O for f in FACT_FLAGS}, "amenity_count": I, "is_deleted": O},
    "dim_listings": {
        "listing_id": I, "listing_name": O, "neighborhood": O, "property_type": O, "room_type": O,
        "accommodates": I, "bedrooms": I, "beds": I, "bathrooms": R, "is_shared_bathroom": O,
        "number_of_reviews": I, "review_scores_rating": R, "first_review_date": O, "last_review_date": O,
        "as_of_date": O, "host_id": I, "host_name_masked": O, "host_since": O, "host_location": O,
        "list_price": R, "amenity_count": I, **{f: O for f in LISTING_FLAGS}, "calendar_days": I,
        "booked_nights": I, "available_nights": I, "total_revenue": R, "avg_nightly_price": R,
        "min_nightly_price": R, "max_nightly_price": R, "occupancy_rate": R, "is_deleted": O},
    "dim_hosts": {
        "host_id": I, "host_name_masked": O, "host_since": O, "as_of_date": O, "host_tenure_years": I,
        "host_location": O, "verification_count": I, "verification_list": O, **{f: O for f in _VFLAGS},
        "listing_count": I, "is_multi_listing_host": O, "calendar_days": I, "booked_nights": I,
        "total_revenue": R, "reservations": I, "occupancy_rate": R, "avg_nights_per_stay": R,
        "avg_list_price": R, "revenue_per_listing": R, "total_reviews": I, "avg_review_score": R},
}

ORACLE = {f"mart_{n}": PRELUDE + "\n" + _norm(f"SELECT * FROM {n}", k) for n, k in KINDS.items()}
_CHANGE_DAYS = """,
change_days AS (
  SELECT listing_id, change_day, changed_at, amenities FROM (
    SELECT listing_id, CAST(changed_at AS DATE) AS change_day, changed_at, amenities,
      row_number() OVER (PARTITION BY listing_id, CAST(changed_at AS DATE)
                         ORDER BY changed_at DESC, amenities_change_id DESC, amenities DESC) AS rn
    FROM stg_changelog) WHERE rn = 1
)
"""
ORACLE["amenities_point_in_time"] = PRELUDE + _CHANGE_DAYS + _norm("""SELECT c.listing_id, c.calendar_date, ch.changed_at AS amenities_changed_at,
    CASE WHEN ch.changed_at IS NULL THEN NULL
         ELSE len(list_distinct(from_json(ch.amenities, '["VARCHAR"]'))) END AS amenity_count_as_of,
    f.amenity_count AS latest_amenity_count
  FROM stg_calendar c
  ASOF LEFT JOIN change_days ch ON c.listing_id = ch.listing_id AND c.calendar_date >= ch.change_day
  LEFT JOIN features f ON c.listing_id = f.listing_id""", {
    "listing_id": I, "calendar_date": O, "amenities_changed_at": O, "amenity_count_as_of": I,
    "latest_amenity_count": I})

_IN_FORCE = _CHANGE_DAYS.rstrip() + """,
in_force AS (
  SELECT listing_id, change_day AS valid_from, lead(change_day) OVER (PARTITION BY listing_id ORDER BY change_day) AS valid_to,
    changed_at, list_distinct(from_json(amenities, '["VARCHAR"]')) AS names
  FROM change_days
),
night_names AS (
  SELECT d.*, valid_from, valid_to, changed_at, names FROM int_listing_daily d
  LEFT JOIN in_force i ON i.listing_id = d.listing_id AND d.calendar_date >= valid_from AND (valid_to IS NULL OR d.calendar_date < valid_to)
)
"""
ORACLE["amenities_validity_join"] = PRELUDE + _IN_FORCE + _norm(
    "SELECT listing_id, calendar_date, valid_from, valid_to, changed_at AS amenities_changed_at, len(names) AS amenity_count_as_of FROM night_names",
    {"listing_id": I, "calendar_date": O, "valid_from": O, "valid_to": O, "amenities_changed_at": O, "amenity_count_as_of": I})
ORACLE["daily_flags_in_force"] = PRELUDE + _IN_FORCE + _norm(
    "SELECT listing_id, calendar_date, is_window_start, availability_window_seq, CASE WHEN len(names) > 0 THEN len(names) END AS amenity_count, "
    + ", ".join(f"CASE WHEN len(names) > 0 THEN list_contains(names, '{f[len('has_'):]}') END AS {f}" for f in FACT_FLAGS) + " FROM night_names",
    {"listing_id": I, "calendar_date": O, "is_window_start": O, "availability_window_seq": I, "amenity_count": I, **{f: O for f in FACT_FLAGS}})

ORACLE["revenue_reconciliation"] = PRELUDE + "\n" + _norm("""SELECT d.daily_model_revenue,
    (SELECT sum(total_revenue) FROM dim_listings) AS listing_model_revenue,
    (SELECT sum(reservation_revenue) FROM fct_reservations) AS reservation_model_revenue,
    (SELECT sum(total_revenue) FROM dim_hosts) AS host_model_revenue,
    coalesce((SELECT sum(total_revenue) FROM dim_listings WHERE is_deleted), 0) AS deleted_listing_revenue,
    d.daily_model_revenue - (SELECT sum(total_revenue) FROM dim_hosts)
      = coalesce((SELECT sum(total_revenue) FROM dim_listings WHERE is_deleted), 0) AS host_gap_is_deleted_revenue
  FROM (SELECT sum(revenue) AS daily_model_revenue FROM fct_listing_daily) d""", {
    "daily_model_revenue": R, "listing_model_revenue": R, "reservation_model_revenue": R,
    "host_model_revenue": R, "deleted_listing_revenue": R, "host_gap_is_deleted_revenue": O})

for _name, _model, _metrics, _dims in (("listing_peak_revenue", "P", ["max_revenue", "listings"], ["neighborhood", "room_type"]),
                                       ("host_portfolios", "H", list(HOST_METRICS), ["host_location", "has_bookings"])):
    _sql, _kinds = sv(_model, _metrics, _dims)
    ORACLE[_name] = PRELUDE + "\n" + _norm(_sql, _kinds)
ORACLE["guarded_mart"] = PRELUDE + "\n" + _norm(
    "SELECT host_id, listing_count, calendar_days, booked_nights, total_revenue FROM dim_hosts",
    {"host_id": I, "listing_count": I, "calendar_days": I, "booked_nights": I, "total_revenue": R})
ORACLE["build_diff"] = PRELUDE + "\n" + _norm(
    """SELECT listing_id, 'removed' AS change, NULL AS columns_changed FROM dim_listings WHERE number_of_reviews = 0
       UNION ALL SELECT listing_id, 'changed', 'listing_name' FROM dim_listings WHERE is_deleted""", {"listing_id": I, "change": O, "columns_changed": O})
ORACLE["marts_before_last_build"] = PRELUDE + "\n" + _norm(
    "SELECT 'fct_listing_daily' AS mart, count(*) AS n_rows, sum(price) AS measure FROM fct_listing_daily UNION ALL "
    "SELECT 'fct_reservations', count(*), sum(reservation_revenue) FROM fct_reservations UNION ALL "
    "SELECT 'dim_listings', count(*), sum(total_revenue) FROM dim_listings UNION ALL "
    "SELECT 'dim_hosts', count(*), sum(total_revenue) FROM dim_hosts", {"mart": O, "n_rows": I, "measure": R})


def _grains(grains, select: str) -> str:
    """One grouped SELECT per grain, dimensions outside a grain as NULL."""
    every = list(dict.fromkeys(c for g in grains for c in g))
    return " UNION ALL ".join(
        f"SELECT '{','.join(g)}' AS grain, {', '.join(c if c in g else f'NULL AS {c}' for c in every)}, {select}" + (f" GROUP BY {', '.join(g)}" if g else "")
        for g in grains)


ORACLE["listings_and_hosts_by_grain"] = PRELUDE + "\n" + _norm(
    _grains(DISTINCT_GRAINS, "count(DISTINCT listing_id) AS listings, count(DISTINCT host_id) AS hosts FROM fct_listing_daily"),
    {"grain": O, "month_start_date": O, "neighborhood": O, "listings": I, "hosts": I})
ORACLE["q04_all_grains"] = PRELUDE + "\n" + _norm(" UNION ALL BY NAME ".join(
    f"SELECT '{','.join(g)}' AS grain, * FROM ({sv('P', Q04_METRICS, g, 'NOT l.is_deleted')[0]})" for g in Q04_GRAINS),
    {"grain": O, "neighborhood": O, "room_type": O, "listings": I, "avg_occupancy_rate": R, "avg_achieved_rate": R, "median_revenue_per_listing": R, "hosts": I})
