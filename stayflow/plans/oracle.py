"""Independent SQL (DuckDB dialect) for every registered query.

The driver runs these against its parquet tables (registered as views) and
compares them with the Spark results. Nothing here calls Spark: the binding,
the layered build and the metric definitions are re-stated as plain SQL.
Every output goes through ``_norm``: integers become BIGINT and non-integers
DOUBLE rounded to 4 places, the same normalisation ``questions.finalize``
applies on the Spark side.
"""

from __future__ import annotations

# Fixed values shared with the Spark side (salt of the test binding; the
# surrogate-key NULL marker of the public key convention).
SALT = "stayflow-test-salt"
NULLMARK = "_dbt_utils_surrogate_key_null_"
AMENITIES = ("click", "error", "purchase", "signup", "view")
VERIFICATIONS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
FACT_FLAGS = ("has_signup", "has_click", "has_view")
LISTING_FLAGS = ("has_signup", "has_click", "has_view", "has_error", "has_purchase")


def _slug(prefix: str, v: str) -> str:
    import re
    return prefix + re.sub(r"[^a-z0-9]+", "_", v.lower()).strip("_")


def _sk(*cols: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '{NULLMARK}')" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


_AMENITY_FLAGS_SQL = ",\n    ".join(f"bool_or(amenity_name = '{v}') AS {_slug('has_', v)}" for v in AMENITIES)
_VERIF_FLAGS_SQL = ",\n    ".join(
    f"bool_or(verification_method = '{v}') AS {_slug('is_verified_', v)}" for v in VERIFICATIONS)
_VERIF_COLS = ", ".join(_slug("is_verified_", v) for v in VERIFICATIONS)

PRELUDE = f"""
WITH RECURSIVE
item_names AS (
  SELECT l_orderkey, count(*) AS n_items, list(DISTINCT CASE WHEN l_quantity >= 46 THEN 'error' WHEN l_returnflag = 'R' THEN 'click'
    WHEN l_returnflag = 'A' THEN 'view' WHEN l_linestatus = 'O' THEN 'signup' ELSE 'purchase' END) AS names
  FROM lineitem GROUP BY l_orderkey
),
wishes AS (  -- listings of a customer: one per 16 orders with items; orders of one listing in the order in which they are served
  SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY wish, order_id) AS turn FROM (
    SELECT o_orderkey AS order_id, n_items, names, CAST((dayofyear(o_orderdate) - 1) % 121 AS INTEGER) AS wish,
      CAST(o_custkey + 10000000000 * (CAST('0x' || left(md5(CAST(o_orderkey AS VARCHAR)), 7) AS BIGINT) % ((count(*) OVER (PARTITION BY o_custkey) + 15) // 16)) AS BIGINT) AS listing_id
    FROM orders JOIN item_names ON l_orderkey = o_orderkey)
),
served(listing_id, turn, order_id, begin, free) AS MATERIALIZED (  -- one after another, from the wished day or the first free one
  SELECT listing_id, turn, order_id, wish, CAST(wish + n_items AS INTEGER) FROM wishes WHERE turn = 1
  UNION ALL
  SELECT w.listing_id, w.turn, w.order_id, greatest(w.wish, s.free), CAST(greatest(w.wish, s.free) + w.n_items AS INTEGER)
  FROM served s JOIN wishes w ON w.listing_id = s.listing_id AND w.turn = s.turn + 1
),
stays AS (
  SELECT listing_id, order_id, n_items, names, CAST(DATE '2024-01-01' + begin AS DATE) AS first_night
  FROM wishes JOIN served USING (listing_id, turn, order_id)
),
taken AS (
  SELECT listing_id, order_id, CAST(first_night + CAST(i AS INTEGER) AS DATE) AS night
  FROM (SELECT listing_id, order_id, first_night, unnest(range(n_items)) AS i FROM stays)
),
per_cust AS (
  SELECT o_custkey, count(*) AS n_orders,
    sum(CAST(o_orderstatus = 'F' AS INTEGER)) AS n_f, sum(CAST(o_orderstatus = 'O' AS INTEGER)) AS n_o,
    sum(CAST(o_orderstatus = 'P' AS INTEGER)) AS n_p, bool_or(o_orderpriority = '1-URGENT') AS urgent,
    min(o_orderdate) AS first_order, max(o_orderdate) AS last_order, CAST(floor(min(o_totalprice) / 10) AS BIGINT) AS cents,
    CAST(to_json(list_sort(list(DISTINCT o_orderpriority))) AS VARCHAR) AS priorities,
    avg(CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS avg_priority
  FROM orders GROUP BY o_custkey
),
owners AS (
  SELECT listing_id, per_cust.* FROM (SELECT listing_id FROM stays UNION SELECT o_custkey FROM per_cust)
  JOIN per_cust ON listing_id % 10000000000 = o_custkey
),
season AS (
  SELECT CAST(unnest(generate_series(CAST(min(night) AS TIMESTAMP), CAST(max(night) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
  FROM taken
),
priced AS (
  SELECT listing_id, date, n_f, n_o, n_p, CAST(floor(cents * (100 + CASE WHEN urgent
    THEN (listing_id * 31 + date_diff('day', DATE '2024-01-01', date) * 17) % 41 - 20 ELSE 0 END) / 100) AS BIGINT) AS night_cents
  FROM owners, season
),
raw_calendar AS (
  SELECT p.listing_id, p.date, t.order_id IS NULL AS available,
    CASE WHEN t.order_id IS NULL THEN 'NULL' ELSE 'R' || t.order_id END AS reservation_id,
    (night_cents // 100) || '.' || lpad(CAST(night_cents % 100 AS VARCHAR), 2, '0') AS price,
    CAST(1 + n_p AS INTEGER) AS minimum_nights, CAST(2 + n_f + n_o AS INTEGER) AS maximum_nights
  FROM priced p LEFT JOIN taken t ON t.listing_id = p.listing_id AND t.night = p.date
),
raw_changelog AS (
  SELECT listing_id, CAST(first_night AS TIMESTAMP) AS change_at, CAST(to_json(list_sort(names)) AS VARCHAR) AS amenities FROM stays
),
raw_listings AS (
  SELECT p.listing_id AS id, c_name AS name, h.host_id, 'Host #' || h.host_id AS host_name,
    CAST(p.first_order AS DATE) AS host_since, n_name AS host_location, p.priorities AS host_verifications,
    r_name AS neighborhood, c_mktsegment AS property_type,
    CASE WHEN c_acctbal < 1000 THEN 'Private room' ELSE 'Entire home/apt' END AS room_type,
    CAST(p.n_orders AS INTEGER) AS accommodates,
    CASE WHEN p.n_f = 0 THEN 'Half-bath' ELSE p.n_f || CASE WHEN c_acctbal < 0 THEN ' shared baths' ELSE ' baths' END END AS bathrooms_text,
    CAST(p.n_o AS INTEGER) AS bedrooms, CAST(p.n_p AS INTEGER) AS beds, CAST(NULL AS VARCHAR) AS amenities,
    '$' || (p.cents // 100) || '.' || lpad(CAST(p.cents % 100 AS VARCHAR), 2, '0') AS price,
    CAST(p.n_f AS INTEGER) AS number_of_reviews,
    CASE WHEN p.n_f = 0 THEN '' ELSE CAST(CAST(DATE '2022-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(p.first_order AS DATE)) // 3
      AS INTEGER) AS DATE) AS VARCHAR) END AS first_review,
    CASE WHEN p.n_f = 0 THEN '' ELSE CAST(CAST(DATE '2022-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(p.last_order AS DATE)) // 3
      AS INTEGER) AS DATE) AS VARCHAR) END AS last_review,
    6.0 - p.avg_priority AS review_scores_rating
  FROM customer
  JOIN (SELECT c_custkey AS k, 10 + c_custkey // (1 + c_nationkey % 5) AS host_id FROM customer) h ON h.k = c_custkey
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
  JOIN owners p ON o_custkey = c_custkey AND p.n_o > 0
),
stg_listings AS (
  SELECT id AS listing_id, name AS listing_name, host_id,
    left(sha256('{SALT}' || host_name), 16) AS host_name_masked,
    host_since, host_location, host_verifications, neighborhood, property_type, room_type, accommodates,
    bathrooms_text,
    TRY_CAST(split_part(trim(bathrooms_text), ' ', 1) AS DECIMAL(4,1)) AS bathrooms,
    contains(lower(bathrooms_text), 'shared') AS is_shared_bathroom,
    bedrooms, beds, amenities,
    TRY_CAST(replace(replace(price, '$', ''), ',', '') AS DECIMAL(10,2)) AS price,
    number_of_reviews,
    TRY_CAST(first_review AS DATE) AS first_review_date,
    TRY_CAST(last_review AS DATE) AS last_review_date,
    review_scores_rating
  FROM raw_listings WHERE id IS NOT NULL
),
cal_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY listing_id, date ORDER BY date, available NULLS FIRST,
    reservation_id NULLS FIRST, price NULLS FIRST, minimum_nights NULLS FIRST, maximum_nights NULLS FIRST) AS rn
  FROM raw_calendar
),
stg_calendar AS (
  SELECT {_sk('listing_id', 'date')} AS calendar_id, listing_id, date AS calendar_date, available AS is_available,
    nullif(reservation_id, 'NULL') AS reservation_id, TRY_CAST(price AS DECIMAL(10,2)) AS price,
    minimum_nights, maximum_nights
  FROM cal_ranked WHERE rn = 1
),
stg_changelog AS (
  SELECT {_sk('listing_id', 'change_at')} AS amenities_change_id, listing_id, change_at AS changed_at, amenities
  FROM raw_changelog
),
latest_amenities AS (
  SELECT listing_id, amenities FROM (
    SELECT *, row_number() OVER (PARTITION BY listing_id
      ORDER BY changed_at DESC NULLS LAST, amenities_change_id DESC NULLS LAST, amenities DESC NULLS LAST) AS rn
    FROM stg_changelog) WHERE rn = 1
),
int_listing_amenities AS (
  SELECT DISTINCT listing_id, amenity_name FROM (
    SELECT listing_id, unnest(from_json(amenities, '["VARCHAR"]')) AS amenity_name FROM latest_amenities)
),
features AS (
  SELECT listing_id, count(DISTINCT amenity_name) AS amenity_count,
    list_sort(list_distinct(list(amenity_name))) AS amenity_list,
    {_AMENITY_FLAGS_SQL}
  FROM int_listing_amenities GROUP BY listing_id
),
int_listings AS (
  SELECT u.listing_id, l.listing_name, l.neighborhood, l.property_type, l.room_type, l.accommodates, l.bedrooms,
    l.beds, l.bathrooms, l.is_shared_bathroom, l.number_of_reviews, l.review_scores_rating, l.first_review_date,
    l.last_review_date, l.host_id, l.host_name_masked, l.host_since, l.host_location, l.price AS list_price,
    l.listing_id IS NULL AS is_deleted
  FROM (SELECT listing_id FROM stg_changelog UNION SELECT listing_id FROM stg_calendar) u
  LEFT JOIN stg_listings l ON u.listing_id = l.listing_id
),
daily_joined AS (
  SELECT c.*, l.listing_name, l.neighborhood, l.property_type, l.room_type, l.accommodates, l.bedrooms, l.beds,
    l.host_id, l.is_deleted, f.amenity_count, {", ".join("f." + x for x in FACT_FLAGS)},
    CASE WHEN NOT c.is_available THEN c.price END AS revenue
  FROM stg_calendar c
  LEFT JOIN int_listings l ON c.listing_id = l.listing_id
  LEFT JOIN features f ON c.listing_id = f.listing_id
),
open_nights AS (  -- a date less its rank among the listing's open dates is the same all through a run
  SELECT listing_id, calendar_date, min(calendar_date) OVER (PARTITION BY listing_id, run) AS run_start,
    dense_rank() OVER (PARTITION BY listing_id ORDER BY run) AS run_no
  FROM (SELECT listing_id, calendar_date,
          calendar_date - CAST(row_number() OVER (PARTITION BY listing_id ORDER BY calendar_date) AS INTEGER) AS run
        FROM stg_calendar WHERE is_available)
),
int_listing_daily AS (
  SELECT d.*, coalesce(o.run_start = d.calendar_date, false) AS is_window_start,
    CAST(coalesce(max(o.run_no) OVER (
      PARTITION BY d.listing_id ORDER BY d.calendar_date ROWS UNBOUNDED PRECEDING), 0) AS BIGINT) AS availability_window_seq
  FROM daily_joined d LEFT JOIN open_nights o ON o.listing_id = d.listing_id AND o.calendar_date = d.calendar_date
),
cal_bounds AS (
  SELECT min(calendar_date) AS window_start, max(calendar_date) AS window_end FROM int_listing_daily
),
res_spans AS (
  SELECT listing_id, reservation_id, min(calendar_date) AS check_in_date, max(calendar_date) AS last_night_date,
    count(*) AS nights, sum(revenue) AS reservation_revenue, avg(price) AS avg_nightly_price,
    bool_or(is_deleted) AS is_deleted
  FROM int_listing_daily WHERE reservation_id IS NOT NULL GROUP BY listing_id, reservation_id
),
int_reservations AS (
  SELECT {_sk('listing_id', 'reservation_id')} AS reservation_key, reservation_id, listing_id, check_in_date,
    last_night_date, CAST(last_night_date + INTERVAL 1 DAY AS DATE) AS check_out_date, nights, reservation_revenue,
    avg_nightly_price, is_deleted,
    date_diff('day', check_in_date, last_night_date) + 1 = nights AS is_contiguous,
    check_in_date = b.window_start AS is_left_censored,
    last_night_date = b.window_end AS is_right_censored
  FROM res_spans, cal_bounds b
),
live AS (SELECT * FROM int_listings WHERE NOT is_deleted),
host_nights AS (
  SELECT host_id, count(*) AS days, count(reservation_id) AS booked, coalesce(sum(revenue), 0) AS revenue
  FROM (SELECT listing_id, reservation_id, revenue FROM int_listing_daily) JOIN live USING (listing_id) GROUP BY host_id
),
host_stays AS (
  SELECT host_id, count(*) AS stays, CAST(sum(nights) FILTER (WHERE whole) AS DOUBLE) / nullif(count(*) FILTER (WHERE whole), 0) AS mean_stay
  FROM (SELECT listing_id, nights, check_in_date > window_start AND last_night_date < window_end AS whole FROM int_reservations, cal_bounds)
  JOIN live USING (listing_id) GROUP BY host_id
),
hosts_agg AS (
  SELECT g.*, coalesce(days, 0) AS calendar_days, coalesce(booked, 0) AS booked_nights, coalesce(revenue, 0) AS total_revenue,
    coalesce(stays, 0) AS reservations, coalesce(booked / nullif(days, 0), 0) AS occupancy_rate, mean_stay AS avg_nights_per_stay
  FROM (SELECT host_id, count(*) AS listing_count, min(host_name_masked) AS host_name_masked, min(host_since) AS host_since,
          min(host_location) AS host_location, avg(list_price) AS avg_list_price, sum(number_of_reviews) AS total_reviews,
          avg(review_scores_rating) AS avg_review_score
        FROM live GROUP BY host_id) g
  LEFT JOIN host_nights USING (host_id) LEFT JOIN host_stays USING (host_id)
),
host_min_ver AS (
  SELECT host_id, min(host_verifications) AS host_verifications FROM stg_listings GROUP BY host_id
),
int_host_verifications AS (
  SELECT DISTINCT host_id, verification_method FROM (
    SELECT host_id, unnest(from_json(host_verifications, '["VARCHAR"]')) AS verification_method FROM host_min_ver)
),
ver_flags AS (
  SELECT host_id, count(*) AS verification_count, list_sort(list(verification_method)) AS verification_list,
    {_VERIF_FLAGS_SQL}
  FROM int_host_verifications GROUP BY host_id
),
dim_hosts AS (
  SELECT h.host_id, h.host_name_masked, h.host_since, b.window_end AS as_of_date,
    year(b.window_end) - year(h.host_since) AS host_tenure_years, h.host_location,
    v.verification_count, v.verification_list, {", ".join("v." + _slug("is_verified_", x) for x in VERIFICATIONS)},
    h.listing_count, h.listing_count > 1 AS is_multi_listing_host, h.calendar_days, h.booked_nights,
    h.total_revenue, h.reservations, h.occupancy_rate, h.avg_nights_per_stay, h.avg_list_price,
    CASE WHEN h.listing_count = 0 THEN 0 ELSE h.total_revenue / h.listing_count END AS revenue_per_listing,
    h.total_reviews, h.avg_review_score
  FROM hosts_agg h CROSS JOIN cal_bounds b
  LEFT JOIN ver_flags v ON h.host_id = v.host_id
),
daily_rollup AS (
  SELECT listing_id, count(*) AS calendar_days, count(*) FILTER (WHERE NOT is_available) AS booked_nights,
    count(*) FILTER (WHERE is_available) AS available_nights, coalesce(sum(revenue), 0) AS total_revenue,
    avg(price) AS avg_nightly_price, min(price) AS min_nightly_price, max(price) AS max_nightly_price
  FROM int_listing_daily GROUP BY listing_id
),
dim_listings AS (
  SELECT l.listing_id, l.listing_name, l.neighborhood, l.property_type, l.room_type, l.accommodates, l.bedrooms,
    l.beds, l.bathrooms, l.is_shared_bathroom, l.number_of_reviews, l.review_scores_rating, l.first_review_date,
    l.last_review_date, b.window_end AS as_of_date, l.host_id, l.host_name_masked, l.host_since, l.host_location,
    l.list_price,
    CASE WHEN d.calendar_days IS NOT NULL THEN f.amenity_count END AS amenity_count,
    {", ".join(f"CASE WHEN d.calendar_days IS NOT NULL THEN f.{x} END AS {x}" for x in LISTING_FLAGS)},
    d.calendar_days, d.booked_nights, d.available_nights, d.total_revenue, d.avg_nightly_price,
    d.min_nightly_price, d.max_nightly_price,
    CASE WHEN d.calendar_days = 0 THEN 0 ELSE d.booked_nights / d.calendar_days END AS occupancy_rate,
    l.is_deleted
  FROM int_listings l CROSS JOIN cal_bounds b
  LEFT JOIN daily_rollup d ON l.listing_id = d.listing_id
  LEFT JOIN features f ON l.listing_id = f.listing_id
),
fct_listing_daily AS (
  SELECT calendar_id, listing_id, calendar_date, CAST(date_trunc('month', calendar_date) AS DATE) AS month_start_date,
    is_available, reservation_id, price, revenue, minimum_nights, maximum_nights, is_window_start,
    availability_window_seq, neighborhood, property_type, room_type, accommodates, bedrooms, beds, host_id,
    {", ".join(FACT_FLAGS)}, amenity_count, is_deleted
  FROM int_listing_daily
),
fct_reservations AS (
  SELECT r.reservation_key, r.reservation_id, r.listing_id, r.check_in_date, r.last_night_date, r.check_out_date,
    CAST(date_trunc('month', r.check_in_date) AS DATE) AS check_in_month, r.nights, r.reservation_revenue,
    r.avg_nightly_price, r.is_contiguous, r.is_left_censored, r.is_right_censored,
    r.is_left_censored OR r.is_right_censored AS is_censored,
    l.listing_name, l.neighborhood, l.property_type, l.room_type, l.accommodates, l.host_id,
    {", ".join("f." + x for x in FACT_FLAGS)}, f.amenity_count, r.is_deleted
  FROM int_reservations r
  LEFT JOIN int_listings l ON r.listing_id = l.listing_id
  LEFT JOIN features f ON r.listing_id = f.listing_id
)"""


# ------------------------------------------------------------------ metric layer
# Each member: name -> (SQL expression over aliases d/l/h/r, kind) with kind
# i = integer, r = real, o = other (passed through unchanged).

_ACH = "l.total_revenue / nullif(l.booked_nights, 0)"
_MEMBERS = {
    "D": {
        "base": "fct_listing_daily d",
        "joins": {"l": "JOIN dim_listings l ON d.listing_id = l.listing_id",
                  "h": "JOIN dim_hosts h ON l.host_id = h.host_id"},
        "needs": {"h": ["l"]},
        "dims": {
            "listing_id": ("d.listing_id", "i"), "calendar_date": ("d.calendar_date", "o"),
            "month_start_date": ("d.month_start_date", "o"),
            "day_of_week": ("strftime(d.calendar_date, '%a')", "o"),
            "is_weekend": ("dayofweek(d.calendar_date) IN (0, 6)", "o"),
            "is_available": ("d.is_available", "o"), "reservation_id": ("d.reservation_id", "o"),
            "availability_window_seq": ("d.availability_window_seq", "i"), "is_deleted": ("d.is_deleted", "o"),
            **{f: (f"d.{f}", "o") for f in FACT_FLAGS}, "amenity_count": ("d.amenity_count", "i"),
            "listing_name": ("l.listing_name", "o"), "neighborhood": ("l.neighborhood", "o"),
            "property_type": ("l.property_type", "o"), "room_type": ("l.room_type", "o"),
            "accommodates": ("l.accommodates", "i"), "bedrooms": ("l.bedrooms", "i"), "beds": ("l.beds", "i"),
            "is_shared_bathroom": ("l.is_shared_bathroom", "o"), "list_price": ("l.list_price", "r"),
            "review_scores_rating": ("l.review_scores_rating", "r"),
            "host_tenure_years": ("h.host_tenure_years", "i"), "is_multi_listing_host": ("h.is_multi_listing_host", "o"),
            # facts
            "price": ("d.price", "r"), "revenue": ("d.revenue", "r"), "minimum_nights": ("d.minimum_nights", "i"),
            "maximum_nights": ("d.maximum_nights", "i"),
        },
        "metrics": {
            "total_revenue": ("sum(d.revenue)", "r"),
            "calendar_nights": ("count(*)", "i"),
            "booked_nights": ("count(*) FILTER (WHERE NOT d.is_available)", "i"),
            "available_nights": ("count(*) FILTER (WHERE d.is_available)", "i"),
            "occupancy_rate": ("CASE WHEN count(*) = 0 THEN 0 ELSE (count(*) FILTER (WHERE NOT d.is_available)) "
                               "/ count(*) END", "r"),
            "avg_nightly_price": ("avg(d.price)", "r"),
            "achieved_nightly_rate": ("avg(d.revenue)", "r"),
            "min_nightly_price": ("min(d.price)", "r"),
            "max_nightly_price": ("max(d.price)", "r"),
            "distinct_prices": ("count(DISTINCT d.price)", "i"),
            "listings": ("count(DISTINCT d.listing_id)", "i"),
            "hosts": ("count(DISTINCT d.host_id)", "i"),
            "avg_price_per_bedroom": ("avg(d.price / nullif(d.bedrooms, 0))", "r"),
            "avg_price_per_bed": ("avg(d.price / nullif(d.beds, 0))", "r"),
            "avg_price_per_guest": ("avg(d.price / nullif(d.accommodates, 0))", "r"),
            "avg_minimum_nights": ("avg(d.minimum_nights)", "r"),
            "max_maximum_nights": ("max(d.maximum_nights)", "i"),
            "max_minimum_nights": ("max(d.minimum_nights)", "i"),
        },
    },
    "P": {
        "base": "dim_listings l",
        "joins": {"h": "JOIN dim_hosts h ON l.host_id = h.host_id"},
        "needs": {},
        "dims": {
            "listing_id": ("l.listing_id", "i"), "listing_name": ("l.listing_name", "o"),
            "neighborhood": ("l.neighborhood", "o"), "property_type": ("l.property_type", "o"),
            "room_type": ("l.room_type", "o"), "accommodates": ("l.accommodates", "i"),
            "bedrooms": ("l.bedrooms", "i"), "beds": ("l.beds", "i"), "bathrooms": ("l.bathrooms", "r"),
            "is_shared_bathroom": ("l.is_shared_bathroom", "o"), "first_review_date": ("l.first_review_date", "o"),
            "last_review_date": ("l.last_review_date", "o"), "as_of_date": ("l.as_of_date", "o"),
            "was_never_booked": ("l.total_revenue = 0", "o"), "has_reviews": ("l.number_of_reviews > 0", "o"),
            "is_deleted": ("l.is_deleted", "o"), **{f: (f"l.{f}", "o") for f in LISTING_FLAGS},
            "amenity_count": ("l.amenity_count", "i"),
            "host_id": ("h.host_id", "i"), "host_name_masked": ("h.host_name_masked", "o"),
            "host_location": ("h.host_location", "o"), "host_tenure_years": ("h.host_tenure_years", "i"),
            "is_multi_listing_host": ("h.is_multi_listing_host", "o"),
            "verification_count": ("h.verification_count", "i"),
            # facts
            "total_revenue": ("l.total_revenue", "r"), "occupancy_rate": ("l.occupancy_rate", "r"),
            "avg_nightly_price": ("l.avg_nightly_price", "r"), "list_price": ("l.list_price", "r"),
            "booked_nights": ("l.booked_nights", "i"), "available_nights": ("l.available_nights", "i"),
            "calendar_days": ("l.calendar_days", "i"), "number_of_reviews": ("l.number_of_reviews", "i"),
            "review_scores_rating": ("l.review_scores_rating", "r"),
            "revenue_per_guest": ("l.total_revenue / nullif(l.accommodates, 0)", "r"),
            "achieved_nightly_rate": (_ACH, "r"),
            "discount_to_list": (f"l.list_price - ({_ACH})", "r"),
            "days_since_last_review": ("date_diff('day', l.last_review_date, l.as_of_date)", "i"),
            "months_since_last_review": ("(year(l.as_of_date) - year(l.last_review_date)) * 12 "
                                         "+ month(l.as_of_date) - month(l.last_review_date)", "i"),
        },
        "metrics": {
            "listings": ("count(*)", "i"),
            "portfolio_revenue": ("sum(l.total_revenue)", "r"),
            "avg_revenue_per_listing": ("avg(l.total_revenue)", "r"),
            "median_revenue_per_listing": ("median(CAST(l.total_revenue AS DOUBLE))", "r"),
            "max_revenue": ("max(l.total_revenue)", "r"),
            "avg_occupancy_rate": ("avg(l.occupancy_rate)", "r"),
            "occupancy_rate_weighted": ("CASE WHEN sum(l.calendar_days) = 0 THEN 0 "
                                        "ELSE sum(l.booked_nights) / sum(l.calendar_days) END", "r"),
            "total_booked_nights": ("sum(l.booked_nights)", "i"),
            "total_available_nights": ("sum(l.available_nights)", "i"),
            "avg_list_price": ("avg(l.list_price)", "r"),
            "avg_achieved_rate": (f"avg({_ACH})", "r"),
            "avg_discount_to_list": (f"avg(l.list_price - ({_ACH}))", "r"),
            "avg_revenue_per_guest": ("avg(l.total_revenue / nullif(l.accommodates, 0))", "r"),
            "avg_review_score": ("avg(l.review_scores_rating)", "r"),
            "total_reviews": ("sum(l.number_of_reviews)", "i"),
            "never_booked_listings": ("count(*) FILTER (WHERE l.total_revenue = 0)", "i"),
            "avg_amenity_count": ("avg(l.amenity_count)", "r"),
            "avg_days_since_last_review": ("avg(date_diff('day', l.last_review_date, l.as_of_date))", "r"),
            "stalest_days_since_review": ("max(date_diff('day', l.last_review_date, l.as_of_date))", "i"),
            "hosts": ("count(DISTINCT l.host_id)", "i"),
        },
    },
    "R": {
        "base": "fct_reservations r",
        "joins": {"l": "JOIN dim_listings l ON r.listing_id = l.listing_id",
                  "h": "JOIN dim_hosts h ON l.host_id = h.host_id"},
        "needs": {"h": ["l"]},
        "dims": {
            "reservation_key": ("r.reservation_key", "o"), "listing_id": ("r.listing_id", "i"),
            "listing_name": ("r.listing_name", "o"), "check_in_date": ("r.check_in_date", "o"),
            "last_night_date": ("r.last_night_date", "o"), "check_out_date": ("r.check_out_date", "o"),
            "check_in_month": ("r.check_in_month", "o"),
            "spans_month_boundary": ("CAST(date_trunc('month', r.last_night_date) AS DATE) <> r.check_in_month", "o"),
            "is_censored": ("r.is_censored", "o"), "is_left_censored": ("r.is_left_censored", "o"),
            "is_right_censored": ("r.is_right_censored", "o"), "is_contiguous": ("r.is_contiguous", "o"),
            "is_deleted": ("r.is_deleted", "o"), **{f: (f"r.{f}", "o") for f in FACT_FLAGS},
            "amenity_count": ("r.amenity_count", "i"),
            "neighborhood": ("l.neighborhood", "o"), "property_type": ("l.property_type", "o"),
            "room_type": ("l.room_type", "o"), "accommodates": ("l.accommodates", "i"),
            "is_shared_bathroom": ("l.is_shared_bathroom", "o"), "review_scores_rating": ("l.review_scores_rating", "r"),
            "is_multi_listing_host": ("h.is_multi_listing_host", "o"), "host_tenure_years": ("h.host_tenure_years", "i"),
        },
        "metrics": {
            "reservations": ("count(*)", "i"),
            "booked_nights": ("sum(r.nights)", "i"),
            "total_revenue": ("sum(r.reservation_revenue)", "r"),
            "avg_length_of_stay": ("avg(CASE WHEN NOT r.is_censored THEN r.nights END)", "r"),
            "avg_length_of_stay_all": ("avg(r.nights)", "r"),
            "median_length_of_stay": ("median(CAST(CASE WHEN NOT r.is_censored THEN r.nights END AS DOUBLE))", "r"),
            "max_length_of_stay": ("max(CASE WHEN NOT r.is_censored THEN r.nights END)", "i"),
            "avg_booking_value": ("avg(r.reservation_revenue)", "r"),
            "avg_nightly_rate": ("avg(r.avg_nightly_price)", "r"),
            "censored_reservations": ("count(*) FILTER (WHERE r.is_censored)", "i"),
            "month_boundary_reservations": ("count(*) FILTER (WHERE CAST(date_trunc('month', r.last_night_date) AS DATE)"
                                            " <> r.check_in_month)", "i"),
            "listings": ("count(DISTINCT r.listing_id)", "i"),
            "hosts": ("count(DISTINCT r.host_id)", "i"),
        },
    },
    "H": {
        "base": "dim_hosts h",
        "joins": {},
        "needs": {},
        "dims": {
            "host_id": ("h.host_id", "i"), "host_name_masked": ("h.host_name_masked", "o"),
            "host_since": ("h.host_since", "o"), "as_of_date": ("h.as_of_date", "o"),
            "host_location": ("h.host_location", "o"), "is_multi_listing_host": ("h.is_multi_listing_host", "o"),
            "is_single_listing_host": ("h.listing_count = 1", "o"), "has_bookings": ("h.reservations > 0", "o"),
            # facts
            "total_revenue": ("h.total_revenue", "r"), "revenue_per_listing": ("h.revenue_per_listing", "r"),
            "occupancy_rate": ("h.occupancy_rate", "r"), "listing_count": ("h.listing_count", "i"),
            "booked_nights": ("h.booked_nights", "i"), "calendar_days": ("h.calendar_days", "i"),
            "reservations": ("h.reservations", "i"), "avg_nights_per_stay": ("h.avg_nights_per_stay", "r"),
            "avg_list_price": ("h.avg_list_price", "r"), "host_tenure_years": ("h.host_tenure_years", "i"),
            "verification_count": ("h.verification_count", "i"), "total_reviews": ("h.total_reviews", "i"),
            "avg_review_score": ("h.avg_review_score", "r"),
        },
        "metrics": {
            "hosts": ("count(*)", "i"),
            "listings": ("sum(h.listing_count)", "i"),
            "portfolio_revenue": ("sum(h.total_revenue)", "r"),
            "avg_revenue_per_listing": ("avg(h.revenue_per_listing)", "r"),
            "avg_revenue_per_host": ("avg(h.total_revenue)", "r"),
            "median_revenue_per_listing": ("median(CAST(h.revenue_per_listing AS DOUBLE))", "r"),
            "avg_occupancy_rate": ("avg(h.occupancy_rate)", "r"),
            "occupancy_rate_weighted": ("CASE WHEN sum(h.calendar_days) = 0 THEN 0 "
                                        "ELSE sum(h.booked_nights) / sum(h.calendar_days) END", "r"),
            "avg_listings_per_host": ("avg(h.listing_count)", "r"),
            "max_listings_per_host": ("max(h.listing_count)", "i"),
            "total_reservations": ("sum(h.reservations)", "i"),
            "avg_length_of_stay": ("avg(h.avg_nights_per_stay)", "r"),
            "avg_tenure_years": ("avg(h.host_tenure_years)", "r"),
            "avg_verification_count": ("avg(h.verification_count)", "r"),
            "portfolio_avg_review_score": ("avg(h.avg_review_score)", "r"),
            "portfolio_total_reviews": ("sum(h.total_reviews)", "i"),
            "portfolio_avg_list_price": ("avg(h.avg_list_price)", "r"),
            "multi_listing_hosts": ("count(*) FILTER (WHERE h.listing_count > 1)", "i"),
        },
    },
}


def sv(model: str, metrics=(), dims=(), where: str | None = None, facts=()) -> tuple[str, dict]:
    """SELECT for one metric-layer query over the prelude's marts, plus the
    kinds of its output columns."""
    spec = _MEMBERS[model]
    kinds = {}
    sel = []
    for name in list(dims) + list(facts):
        expr, kind = spec["dims"][name]
        sel.append(f"{expr} AS {name}")
        kinds[name] = kind
    for name in metrics:
        expr, kind = spec["metrics"][name]
        sel.append(f"{expr} AS {name}")
        kinds[name] = kind
    text = " ".join(sel) + " " + (where or "")
    aliases = [a for a in spec["joins"] if f"{a}." in text]
    for a in list(aliases):
        for need in spec["needs"].get(a, []):
            if need not in aliases:
                aliases.insert(0, need)
    order = [a for a in spec["joins"] if a in aliases]
    sql = f"SELECT {', '.join(sel)} FROM {spec['base']} " + " ".join(spec["joins"][a] for a in order)
    if where:
        sql += f" WHERE {where}"
    if metrics and (dims or facts):
        sql += " GROUP BY ALL"
    return sql, kinds


def _rnd(sql: str) -> str:
    """Rewrite every ``round(x, n)`` into a half-up round through DECIMAL(38,9)."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 1, j + 6, -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        expr, places = _rnd(sql[j + 6:comma]), sql[comma + 1:k - 1].strip()
        out.append(sql[i:j] + f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,9)), {places}) AS DOUBLE)")
        i = k


def _norm(inner: str, kinds: dict) -> str:
    cols = []
    inner = _rnd(inner)
    for name, kind in kinds.items():
        if kind == "r":
            cols.append(f"CAST(ROUND(CAST({name} AS DECIMAL(38,9)), 4) AS DOUBLE) AS {name}")
        elif kind == "i":
            cols.append(f"CAST({name} AS BIGINT) AS {name}")
        else:
            cols.append(name)
    return f"SELECT {', '.join(cols)} FROM ({inner}) AS q"


# revenue of each listing, and its place in the order of revenue (listings without any come last)
EARNED = """SELECT listing_id, listing_name, total_revenue AS exact, CAST(total_revenue AS DOUBLE) AS money, coalesce(total_revenue, -1) AS place
    FROM dim_listings"""


def banded(out: str, rows: str, bands: list, means: dict, missing: str | None = None, count: str = "listings", more: dict | None = None) -> str:
    """Counts and rounded means by band: rows (with a value x) are joined to a table of bounds, least value included."""
    lows = ["NULL", *(str(b[1]) for b in bands[:-1])]
    table = ", ".join(f"('{name}', CAST({low} AS DOUBLE), CAST({'NULL' if high is None else high} AS DOUBLE))" for (name, high), low in zip(bands, lows))
    label = f"coalesce(label, '{missing}')" if missing else "label"
    extra = "".join(f", {expr} AS {name}" for name, (expr, _, _) in (more or {}).items())
    body = (f"SELECT {label} AS {out}, count(*) AS {count}" + "".join(f", avg({x}) AS {name}" for name, (x, _) in means.items()) + extra
            + f" FROM ({rows.replace('{ach}', _ACH)}) {'LEFT ' if missing else ''}JOIN (VALUES {table}) AS bounds(label, low, high)"
            + " ON x >= coalesce(low, x) AND x < coalesce(high, x + 1) GROUP BY 1")
    kinds = {out: "o", count: "i", **{m: "r" for m in means}, **{m: kind for m, (_, kind, _) in (more or {}).items()}}
    digits = {m: d for m, (_, d) in means.items()} | {m: d for m, (_, _, d) in (more or {}).items() if d is not None}
    return full(body, kinds, digits=digits)


def full(body: str, kinds: dict, ctes: dict | None = None, digits: dict | None = None) -> str:
    """PRELUDE + extra CTEs + normalised final select; ``digits`` rounds columns half up first."""
    if digits:
        body = "SELECT * REPLACE (" + ", ".join(f"ROUND(CAST({c} AS DECIMAL(38,9)), {d}) AS {c}" for c, d in digits.items()) + f") FROM ({body})"
    extra = "".join(f",\n{name} AS (\n{sql}\n)" for name, sql in (ctes or {}).items())
    return PRELUDE + extra + "\n" + _norm(body, kinds)


def semantic(model: str, metrics=(), dims=(), where=None, facts=()) -> str:
    sql, kinds = sv(model, metrics, dims, where, facts)
    return full(sql, kinds)


# ------------------------------------------------------------------ questions
ND = "NOT d.is_deleted"
NP = "NOT l.is_deleted"
PRIMARY, FIRST, SECOND = "has_signup", "has_click", "has_view"
R, I, O = "r", "i", "o"


def _wrap(model, metrics=(), dims=(), where=None, facts=(), body="", kinds=None):
    inner, _ = sv(model, metrics, dims, where, facts)
    return full(body, kinds, {"sem": inner})


def _questions() -> dict[str, str]:
    q: dict[str, str] = {}
    S = semantic
    # q01
    q["q01_by_month"] = _wrap(
        "D", ["total_revenue", "booked_nights", "listings"], ["month_start_date", PRIMARY],
        body=f"""SELECT month_start_date, {PRIMARY}, listings, booked_nights, total_revenue,
          round(100 * CAST(total_revenue AS DOUBLE) / nullif(sum(total_revenue) OVER (PARTITION BY month_start_date), 0), 1)
            AS pct_of_month_revenue FROM sem""",
        kinds={"month_start_date": O, PRIMARY: O, "listings": I, "booked_nights": I, "total_revenue": R,
               "pct_of_month_revenue": R})
    q["q01_full_year"] = S("D", ["total_revenue", "booked_nights", "occupancy_rate", "achieved_nightly_rate",
                                 "listings"], [PRIMARY])
    # q02
    q["q02_price_change"] = _wrap(
        "D", ["avg_nightly_price"], ["listing_id", "neighborhood", "calendar_date"],
        where="d.calendar_date IN ((SELECT window_start FROM cal_bounds), (SELECT window_end FROM cal_bounds)) AND " + ND,
        body="""SELECT neighborhood, count(*) AS listings,
            round(avg(end_price - start_price), 2) AS avg_price_increase,
            round(avg(start_price), 2) AS avg_start_price, round(avg(end_price), 2) AS avg_end_price
          FROM (SELECT listing_id, neighborhood,
                  max(CASE WHEN calendar_date = (SELECT window_start FROM cal_bounds) THEN avg_nightly_price END) AS start_price,
                  max(CASE WHEN calendar_date = (SELECT window_end FROM cal_bounds) THEN avg_nightly_price END) AS end_price
                FROM sem GROUP BY listing_id, neighborhood) GROUP BY neighborhood""",
        kinds={"neighborhood": O, "listings": I, "avg_price_increase": R, "avg_start_price": R, "avg_end_price": R})
    q["q02_monthly_trend"] = S("D", ["avg_nightly_price", "achieved_nightly_rate", "listings"],
                               ["neighborhood", "month_start_date"], ND)
    # q03
    q["q03_picky_renter"] = _wrap(
        "D", ["calendar_nights", "max_maximum_nights"],
        ["listing_id", "listing_name", "neighborhood", "availability_window_seq"],
        where=f"d.is_available AND d.{FIRST} AND d.{SECOND}",
        body="""SELECT listing_id, listing_name, neighborhood,
            max(CASE WHEN calendar_nights IS NULL OR max_maximum_nights IS NULL THEN NULL
                     ELSE least(calendar_nights, max_maximum_nights) END) AS longest_possible_stay_nights,
            max(calendar_nights) AS longest_availability_window, max(max_maximum_nights) AS owner_max_nights,
            count(*) AS availability_windows
          FROM sem GROUP BY listing_id, listing_name, neighborhood""",
        kinds={"listing_id": I, "listing_name": O, "neighborhood": O, "longest_possible_stay_nights": I,
               "longest_availability_window": I, "owner_max_nights": I, "availability_windows": I})
    q["q03_all_windows"] = _wrap(
        "D", ["calendar_nights", "max_maximum_nights", "max_minimum_nights"],
        ["listing_id", "listing_name", "availability_window_seq"], where="d.is_available",
        body="""SELECT listing_id, listing_name, availability_window_seq, calendar_nights AS window_length_nights,
            max_minimum_nights AS minimum_nights, max_maximum_nights AS owner_max_nights,
            CASE WHEN calendar_nights IS NULL OR max_maximum_nights IS NULL THEN NULL
                 ELSE least(calendar_nights, max_maximum_nights) END AS longest_possible_stay_nights,
            calendar_nights > max_maximum_nights AS is_cap_bound FROM sem""",
        kinds={"listing_id": I, "listing_name": O, "availability_window_seq": I, "window_length_nights": I,
               "minimum_nights": I, "owner_max_nights": I, "longest_possible_stay_nights": I, "is_cap_bound": O})
    occ4 = ["listings", "avg_occupancy_rate", "total_booked_nights", "total_available_nights"]
    q["q04_by_neighborhood"] = S("P", occ4, ["neighborhood"], NP)
    q["q04_by_room_type"] = S("P", occ4, ["room_type"], NP)
    q["q04_by_both"] = S("P", ["listings", "avg_occupancy_rate", "avg_achieved_rate"], ["neighborhood", "room_type"], NP)
    q["q05_detail"] = S("P", ["total_available_nights", "avg_list_price", "avg_review_score", "total_reviews"],
                        ["listing_id", "listing_name", "neighborhood", "room_type"], "l.total_revenue = 0")
    q["q05_count"] = S("P", ["listings", "never_booked_listings", "portfolio_revenue"])
    q["q05_by_neighborhood"] = S("P", ["listings", "never_booked_listings", "avg_occupancy_rate"], ["neighborhood"], NP)
    q["q06_by_month"] = S("D", ["total_revenue", "calendar_nights", "booked_nights", "occupancy_rate",
                                "achieved_nightly_rate", "avg_nightly_price", "listings"], ["month_start_date"])
    q["q06_by_month_and_neighborhood"] = S("D", ["total_revenue", "occupancy_rate", "achieved_nightly_rate",
                                                 "listings"], ["month_start_date", "neighborhood"], ND)
    # q07
    q["q07_concentration"] = full(
        """SELECT a.listing_id, any_value(a.listing_name) AS listing_name, any_value(a.money) AS revenue, count(*) AS revenue_rank,
            100 * any_value(a.money) / nullif(any_value(everything), 0) AS pct_of_total,
            100 * CAST(sum(b.exact) AS DOUBLE) / nullif(any_value(everything), 0) AS running_pct_of_total
          FROM earned a JOIN earned b ON b.place > a.place OR (b.place = a.place AND b.listing_id <= a.listing_id)
          CROSS JOIN (SELECT CAST(sum(exact) AS DOUBLE) AS everything FROM earned)
          GROUP BY a.listing_id""",
        {"listing_id": I, "listing_name": O, "revenue": R, "revenue_rank": I, "pct_of_total": R, "running_pct_of_total": R},
        {"earned": EARNED}, digits={"revenue": 2, "pct_of_total": 2, "running_pct_of_total": 2})
    q["q07_top_five_share"] = full(
        """SELECT listings, total_revenue, top_5_revenue, 100 * top_5_revenue / nullif(total_revenue, 0) AS top_5_pct_of_total
          FROM (SELECT count(*) AS listings, CAST(sum(exact) AS DOUBLE) AS total_revenue FROM earned),
               (SELECT CAST(sum(exact) AS DOUBLE) AS top_5_revenue FROM (SELECT exact FROM earned ORDER BY place DESC, listing_id LIMIT 5))""",
        {"listings": I, "total_revenue": R, "top_5_revenue": R, "top_5_pct_of_total": R},
        {"earned": EARNED}, digits={"total_revenue": 2, "top_5_revenue": 2, "top_5_pct_of_total": 2})
    rate = ["avg_list_price", "avg_achieved_rate", "avg_discount_to_list"]
    q["q08_overall"] = S("P", ["listings", *rate])
    q["q08_by_listing"] = S("P", [*rate, "avg_occupancy_rate"], ["listing_id", "listing_name", "neighborhood"], NP)
    q["q08_by_segment"] = S("P", ["listings", *rate], ["neighborhood", "room_type"], NP)
    # q09
    q["q09_price_band"] = banded(
        "list_price_band", "SELECT list_price AS x, list_price, occupancy_rate, total_revenue, {ach} AS rate FROM dim_listings l WHERE list_price IS NOT NULL",
        [("1. under 75", 75), ("2. 75 to 149", 150), ("3. 150 to 249", 250), ("4. 250 to 399", 400), ("5. 400 and over", None)],
        {"avg_list_price": ("list_price", 2), "avg_occupancy_rate": ("occupancy_rate", 4), "avg_revenue": ("total_revenue", 2),
         "avg_achieved_rate": ("rate", 2)})
    q["q09_scatter"] = S("P", ["avg_list_price", "avg_achieved_rate", "avg_occupancy_rate", "portfolio_revenue"],
                         ["listing_id", "listing_name", "room_type"], NP)
    day6 = ["calendar_nights", "booked_nights", "occupancy_rate", "avg_nightly_price", "achieved_nightly_rate",
            "total_revenue"]
    q["q10_by_day"] = S("D", day6, ["day_of_week"])
    q["q10_weekend_premium"] = S("D", day6, ["is_weekend"])
    q["q10_by_day_and_room_type"] = S("D", ["occupancy_rate", "avg_nightly_price", "achieved_nightly_rate"],
                                      ["day_of_week", "room_type"], ND)
    # q11
    q["q11_by_score_band"] = banded(
        "review_score_band", "SELECT review_scores_rating AS x, number_of_reviews, occupancy_rate, total_revenue, {ach} AS rate FROM dim_listings l",
        [("1. under 4.0", 4.0), ("2. 4.0 to 4.49", 4.5), ("3. 4.5 to 4.79", 4.8), ("4. 4.8 and over", None)],
        {"avg_reviews": ("number_of_reviews", 1), "avg_occupancy_rate": ("occupancy_rate", 4), "avg_achieved_rate": ("rate", 2),
         "avg_revenue": ("total_revenue", 2)}, missing="0. never reviewed")
    q["q11_by_review_volume"] = banded(
        "review_count_band", "SELECT number_of_reviews AS x, occupancy_rate, {ach} AS rate FROM dim_listings l",
        [("0. none", 1), ("1. 1 to 9", 10), ("2. 10 to 49", 50), ("3. 50 to 99", 100), ("4. 100 and over", None)],
        {"avg_occupancy_rate": ("occupancy_rate", 4), "avg_achieved_rate": ("rate", 2)}, missing="4. 100 and over")
    q["q11_per_listing"] = S("P", ["avg_review_score", "total_reviews", "avg_occupancy_rate", "avg_achieved_rate"],
                             ["listing_id", "listing_name", "has_reviews"], NP)
    q["q12_by_capacity"] = S("P", ["listings", "avg_revenue_per_guest", "avg_revenue_per_listing",
                                   "avg_occupancy_rate", "avg_achieved_rate"], ["accommodates"], NP)
    q["q12_by_listing"] = S("P", ["avg_revenue_per_guest", "portfolio_revenue", "avg_occupancy_rate"],
                            ["listing_id", "listing_name", "accommodates", "room_type"], NP)
    q["q12_by_room_type"] = S("P", ["listings", "avg_revenue_per_guest", "avg_revenue_per_listing"], ["room_type"], NP)
    q["q13_split"] = S("P", ["listings", "avg_list_price", "avg_achieved_rate", "avg_occupancy_rate",
                             "avg_revenue_per_listing", "avg_review_score"], ["is_shared_bathroom"], NP)
    q["q13_by_room_type"] = S("P", ["listings", "avg_list_price", "avg_achieved_rate", "avg_occupancy_rate"],
                              ["room_type", "is_shared_bathroom"], NP)
    wide = ["listings", "avg_achieved_rate", "avg_list_price", "avg_occupancy_rate", "avg_revenue_per_listing"]
    q["q14_by_amenity"] = full(
        "SELECT amenity, coalesce(listings, 0) AS listings, " + ", ".join(wide[1:])
        + " FROM (VALUES " + ", ".join(f"('{f}')" for f in LISTING_FLAGS) + ") AS names(amenity) LEFT JOIN (SELECT amenity, "
        + ", ".join(f"{_MEMBERS['P']['metrics'][m][0]} AS {m}" for m in wide)
        + " FROM (UNPIVOT (SELECT listing_id, " + ", ".join(LISTING_FLAGS) + " FROM dim_listings) ON " + ", ".join(LISTING_FLAGS)
        + " INTO NAME amenity VALUE has_it) JOIN dim_listings l USING (listing_id) WHERE has_it AND " + NP
        + " GROUP BY amenity) USING (amenity)",
        {"amenity": O, "listings": I, **{m: R for m in wide[1:]}})
    q["q14_primary_split"] = S("P", ["listings", "avg_achieved_rate", "avg_list_price", "avg_occupancy_rate",
                                     "avg_revenue_per_listing"], [PRIMARY], NP)
    q["q14_by_amenity_count"] = banded(
        "amenity_count_band", "SELECT amenity_count AS x, amenity_count, occupancy_rate, total_revenue, {ach} AS rate FROM dim_listings l WHERE " + NP,
        [("1. under 15", 15), ("2. 15 to 24", 25), ("3. 25 to 34", 35), ("4. 35 and over", None)],
        {"avg_amenity_count": ("amenity_count", 1), "avg_achieved_rate": ("rate", 2), "avg_occupancy_rate": ("occupancy_rate", 4),
         "avg_revenue": ("total_revenue", 2)}, missing="4. 35 and over")
    q["q15_by_listing"] = S("D", ["distinct_prices", "min_nightly_price", "max_nightly_price", "avg_nightly_price",
                                  "achieved_nightly_rate", "occupancy_rate"], ["listing_id", "listing_name"])
    per_listing = """SELECT {x} AS x, any_value(n_prices) AS n_prices, max(price) - min(price) AS spread, avg(price) AS asked,
        avg(minimum_nights) AS nights, count(reservation_id) / count(*) AS taken, avg(revenue) AS got, sum(revenue) AS money
      FROM fct_listing_daily JOIN (SELECT listing_id, count(*) AS n_prices FROM
        (SELECT DISTINCT listing_id, price FROM fct_listing_daily WHERE price IS NOT NULL) GROUP BY listing_id) USING (listing_id)
      GROUP BY listing_id"""
    q["q15_banded"] = banded(
        "pricing_style", per_listing.format(x="any_value(n_prices)"),
        [("1. never changed", 2), ("2. 2 to 5 rates", 6), ("3. 6 to 20 rates", 21), ("4. over 20 rates", None)],
        {"avg_distinct_prices": ("n_prices", 1), "avg_price_spread": ("spread", 2), "avg_occupancy_rate": ("taken", 4), "avg_revenue": ("money", 2)})
    q["q15_static_pricers"] = _wrap(
        "D", ["distinct_prices", "avg_nightly_price", "occupancy_rate", "total_revenue"],
        ["listing_id", "listing_name", "room_type"], ND,
        body="SELECT * FROM sem WHERE distinct_prices = 1",
        kinds={"listing_id": I, "listing_name": O, "room_type": O, "distinct_prices": I, "avg_nightly_price": R,
               "occupancy_rate": R, "total_revenue": R})
    # least value of the next band; just above the greatest of this one, as averages lie between whole nights
    nights = [("1. one night", 1.000001), ("2. 2 to 3 nights", 3.000001), ("3. 4 to 7 nights", 7.000001), ("4. 8 to 30 nights", 30.000001),
              ("5. over 30 nights", None)]
    q["q16_by_night"] = banded(
        "minimum_nights_band", "SELECT minimum_nights AS x, listing_id, reservation_id, price, revenue FROM fct_listing_daily", nights,
        {"avg_nightly_price": ("price", 2), "achieved_nightly_rate": ("revenue", 2)}, count="calendar_nights",
        more={"listings": ("count(DISTINCT listing_id)", I, None), "booked_nights": ("count(reservation_id)", I, None),
              "occupancy_rate": ("count(reservation_id) / count(*)", R, 4), "total_revenue": ("CAST(sum(revenue) AS DOUBLE)", R, 2)})
    q["q16_by_listing"] = banded(
        "minimum_nights_band", per_listing.format(x="avg(minimum_nights)"), nights,
        {"avg_minimum_nights": ("nights", 2), "avg_occupancy_rate": ("taken", 4), "avg_nightly_price": ("asked", 2),
         "avg_achieved_rate": ("got", 2), "avg_revenue": ("money", 2)})
    q["q16_scatter"] = S("D", ["avg_minimum_nights", "max_minimum_nights", "occupancy_rate", "avg_nightly_price",
                               "total_revenue"], ["listing_id", "listing_name", "room_type"], ND)
    q["q17_summary"] = S("R", ["reservations", "booked_nights", "total_revenue", "avg_length_of_stay",
                               "avg_booking_value", "avg_nightly_rate", "censored_reservations"])
    q["q17_by_month"] = S("R", ["reservations", "booked_nights", "avg_length_of_stay", "avg_booking_value"],
                          ["check_in_month"])
    q["q17_censoring"] = S("R", ["reservations", "censored_reservations", "avg_length_of_stay",
                                 "avg_length_of_stay_all"])
    q["q18_leaderboard"] = S("H", ["avg_revenue_per_listing", "avg_occupancy_rate", "listings", "total_reservations",
                                   "avg_length_of_stay"], ["host_id", "host_name_masked", "is_multi_listing_host"])
    q["q18_top_ten"] = _wrap(
        "H", ["avg_revenue_per_listing", "avg_occupancy_rate", "listings", "total_reservations"],
        ["host_id", "host_name_masked"],
        body="SELECT * FROM sem ORDER BY avg_revenue_per_listing DESC NULLS LAST, host_id LIMIT 10",
        kinds={"host_id": I, "host_name_masked": O, "avg_revenue_per_listing": R, "avg_occupancy_rate": R,
               "listings": I, "total_reservations": I})
    q["q18_portfolio_total"] = S("H", ["hosts", "listings", "portfolio_revenue", "avg_revenue_per_listing",
                                       "occupancy_rate_weighted", "avg_listings_per_host", "max_listings_per_host"])
    q["q19_segments"] = S("H", ["hosts", "listings", "avg_revenue_per_listing", "median_revenue_per_listing",
                                "avg_occupancy_rate", "avg_length_of_stay", "avg_listings_per_host"],
                          ["is_multi_listing_host"])
    q["q20_by_tenure"] = _wrap(
        "H", dims=["host_id"], facts=["host_tenure_years", "revenue_per_listing", "occupancy_rate", "listing_count"],
        body="""SELECT host_tenure_years, count(*) AS hosts, sum(listing_count) AS listings,
            round(avg(revenue_per_listing), 2) AS avg_revenue_per_listing, round(avg(occupancy_rate), 4) AS avg_occupancy_rate
          FROM sem GROUP BY ALL""",
        kinds={"host_tenure_years": I, "hosts": I, "listings": I, "avg_revenue_per_listing": R, "avg_occupancy_rate": R})
    q["q20_by_host_since"] = S("H", ["hosts", "listings", "avg_tenure_years", "avg_revenue_per_listing",
                                     "avg_occupancy_rate"], ["host_since"])
    ppx = ["avg_nightly_price", "avg_price_per_bedroom", "avg_price_per_bed", "avg_price_per_guest"]
    q["q21_by_room_type"] = _wrap(
        "D", ppx, ["listing_id", "room_type", "bedrooms", "beds"], ND,
        body="""SELECT room_type, count(*) AS listings, round(avg(avg_nightly_price), 2) AS avg_nightly_price,
            round(avg(avg_price_per_bedroom), 2) AS avg_price_per_bedroom, round(avg(avg_price_per_bed), 2) AS avg_price_per_bed,
            round(avg(avg_price_per_guest), 2) AS avg_price_per_guest,
            count(*) FILTER (WHERE bedrooms IS NULL) AS listings_missing_bedrooms,
            count(*) FILTER (WHERE beds = 0) AS listings_zero_beds
          FROM sem GROUP BY ALL""",
        kinds={"room_type": O, "listings": I, "avg_nightly_price": R, "avg_price_per_bedroom": R,
               "avg_price_per_bed": R, "avg_price_per_guest": R, "listings_missing_bedrooms": I,
               "listings_zero_beds": I})
    q["q21_by_listing"] = S("D", [*ppx, "occupancy_rate"], ["listing_id", "listing_name", "room_type", "bedrooms",
                                                            "beds", "accommodates"], ND)
    q["q21_by_neighborhood"] = S("D", ["listings", *ppx], ["neighborhood"], ND)
    span = "CAST(date_trunc('month', r.last_night_date) AS DATE) <> r.check_in_month"
    q["q22_count"] = S("R", ["reservations", "month_boundary_reservations", "total_revenue"])
    q["q22_by_month"] = S("R", ["reservations", "month_boundary_reservations", "total_revenue"], ["check_in_month"])
    q["q22_detail"] = S("R", ["reservations", "booked_nights", "total_revenue"],
                        ["reservation_key", "listing_id", "check_in_date", "last_night_date", "check_in_month"], span)
    stay = ["reservations", "booked_nights", "avg_length_of_stay", "median_length_of_stay", "max_length_of_stay",
            "censored_reservations"]
    q["q23_by_neighborhood"] = S("R", stay, ["neighborhood"], "NOT r.is_deleted")
    q["q23_by_room_type"] = S("R", stay, ["room_type"], "NOT r.is_deleted")
    q["q23_by_neighborhood_room_type"] = S("R", ["reservations", "avg_length_of_stay", "median_length_of_stay",
                                                 "censored_reservations"], ["neighborhood", "room_type"],
                                           "NOT r.is_deleted")
    q["q24_stalest"] = S("P", ["avg_days_since_last_review", "total_reviews", "avg_occupancy_rate",
                               "portfolio_revenue"],
                         ["listing_id", "listing_name", "neighborhood", "last_review_date", "has_reviews"],
                         "l.number_of_reviews > 0 AND " + NP)
    q["q24_never_reviewed"] = S("P", ["listings", "avg_days_since_last_review", "stalest_days_since_review",
                                      "total_reviews", "avg_occupancy_rate"], ["has_reviews"], NP)
    q["q24_by_staleness_band"] = _wrap(
        "P", dims=["listing_id", "is_deleted"], facts=["months_since_last_review", "number_of_reviews",
                                                       "occupancy_rate", "total_revenue"],
        body="""SELECT CASE WHEN months_since_last_review IS NULL THEN '0. never reviewed'
                 WHEN months_since_last_review <= 3 THEN '1. within 3 months'
                 WHEN months_since_last_review <= 12 THEN '2. 4 to 12 months'
                 WHEN months_since_last_review <= 36 THEN '3. 1 to 3 years' ELSE '4. over 3 years' END AS staleness_band,
            count(*) AS listings, round(avg(number_of_reviews), 1) AS avg_reviews,
            round(avg(occupancy_rate), 4) AS avg_occupancy_rate, round(avg(total_revenue), 2) AS avg_revenue
          FROM sem WHERE NOT is_deleted GROUP BY ALL""",
        kinds={"staleness_band": O, "listings": I, "avg_reviews": R, "avg_occupancy_rate": R, "avg_revenue": R})
    # an open run that is shorter than the strictest minimum stay on its nights cannot be booked
    runs = {"run": """SELECT listing_id, availability_window_seq AS seq, count(*) AS nights, max(minimum_nights) AS need,
        CAST(sum(price) AS DOUBLE) AS asked FROM fct_listing_daily WHERE is_available GROUP BY ALL""",
            "short": "SELECT * FROM run WHERE nights < need"}
    q["q25_portfolio"] = full(
        """SELECT a.n AS availability_windows, b.n AS unbookable_windows, b.nights AS unbookable_nights, b.asked AS unbookable_asking_value,
            a.nights AS all_available_nights, a.asked AS all_available_asking_value, 100 * b.asked / nullif(a.asked, 0) AS pct_of_open_inventory_unbookable
          FROM (SELECT count(*) AS n, sum(nights) AS nights, sum(asked) AS asked FROM run) a,
               (SELECT count(*) AS n, sum(nights) AS nights, sum(asked) AS asked FROM short) b""",
        {"availability_windows": I, "unbookable_windows": I, "unbookable_nights": I, "unbookable_asking_value": R,
         "all_available_nights": I, "all_available_asking_value": R, "pct_of_open_inventory_unbookable": R}, runs,
        digits={"unbookable_asking_value": 2, "all_available_asking_value": 2, "pct_of_open_inventory_unbookable": 2})
    q["q25_by_listing"] = full(
        """SELECT listing_id, listing_name, a.n AS availability_windows, b.n AS unbookable_windows, a.need AS strictest_minimum_nights,
            b.nights AS unbookable_nights, b.asked AS unbookable_asking_value
          FROM (SELECT listing_id, count(*) AS n, sum(nights) AS nights, sum(asked) AS asked FROM short GROUP BY ALL) b
          JOIN (SELECT listing_id, count(*) AS n, max(need) AS need FROM run GROUP BY ALL) a USING (listing_id)
          JOIN dim_listings USING (listing_id)""",
        {"listing_id": I, "listing_name": O, "availability_windows": I, "unbookable_windows": I,
         "strictest_minimum_nights": I, "unbookable_nights": I, "unbookable_asking_value": R}, runs, digits={"unbookable_asking_value": 2})
    q["q25_detail"] = full(
        """SELECT listing_id, listing_name, seq AS availability_window_seq, nights AS window_length_nights, need AS minimum_nights,
            asked AS window_asking_value FROM short JOIN dim_listings USING (listing_id)""",
        {"listing_id": I, "listing_name": O, "availability_window_seq": I, "window_length_nights": I,
         "minimum_nights": I, "window_asking_value": R}, runs, digits={"window_asking_value": 2})
    q["q26_density"] = S("P", ["listings", "avg_achieved_rate", "avg_list_price", "avg_occupancy_rate",
                               "portfolio_revenue", "avg_revenue_per_listing"], ["neighborhood"], NP)
    q["q26_density_by_room_type"] = S("P", ["listings", "avg_achieved_rate", "avg_occupancy_rate"],
                                      ["neighborhood", "room_type"], NP)
    return q


QUESTIONS_SQL = _questions()
