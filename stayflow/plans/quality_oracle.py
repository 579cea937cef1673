"""SQL oracle for the quality suite (one UNION ALL of failing-row counts)."""

from __future__ import annotations

from stayflow.plans.oracle import AMENITIES, PRELUDE, QUESTIONS_SQL, VERIFICATIONS, _norm

_AV = "(SELECT * FROM (VALUES " + ", ".join(f"('{v}')" for v in AMENITIES) + ") AS t(amenity_name))"
_VV = "(SELECT * FROM (VALUES " + ", ".join(f"('{v}')" for v in VERIFICATIONS) + ") AS t(verification_method))"


def _uniq(rel, keys):
    return f"(SELECT count(*) FROM (SELECT {keys} FROM {rel} GROUP BY {keys} HAVING count(*) > 1))"


def _nn(rel, cols):
    return f"(SELECT count(*) FROM {rel} WHERE " + " OR ".join(f"{c} IS NULL" for c in cols) + ")"


def _orph(child, parent, fk, pk=None):
    pk = pk or fk
    return (f"(SELECT count(*) FROM {child} c WHERE c.{fk} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk}))")


_OVER_CAP = """SELECT listing_id, availability_window_seq, count(*) AS calendar_nights,
    max(maximum_nights) AS max_maximum_nights
  FROM fct_listing_daily WHERE is_available GROUP BY listing_id, availability_window_seq
  HAVING count(*) > max(maximum_nights)"""

_HOST_ATTRS = """SELECT host_id, count(DISTINCT host_name_masked) AS distinct_host_name_masked,
    count(DISTINCT host_since) AS distinct_host_since, count(DISTINCT host_location) AS distinct_host_location,
    count(DISTINCT host_verifications) AS distinct_host_verifications
  FROM stg_listings GROUP BY host_id
  HAVING count(DISTINCT host_name_masked) > 1 OR count(DISTINCT host_since) > 1
      OR count(DISTINCT host_location) > 1 OR count(DISTINCT host_verifications) > 1"""

CHECKS = [
    ("unique_stg_calendar_calendar_id", "error", "stg_calendar", _uniq("stg_calendar", "calendar_id")),
    ("unique_stg_calendar_grain", "error", "stg_calendar", _uniq("stg_calendar", "listing_id, calendar_date")),
    ("unique_stg_changelog_id", "error", "stg_amenities_changelog", _uniq("stg_changelog", "amenities_change_id")),
    ("unique_stg_listings_listing_id", "error", "stg_listings", _uniq("stg_listings", "listing_id")),
    ("unique_int_listings_listing_id", "error", "int_listings", _uniq("int_listings", "listing_id")),
    ("unique_fct_listing_daily_calendar_id", "error", "fct_listing_daily", _uniq("fct_listing_daily", "calendar_id")),
    ("unique_fct_reservations_key", "error", "fct_reservations", _uniq("fct_reservations", "reservation_key")),
    ("unique_dim_listings_listing_id", "error", "dim_listings", _uniq("dim_listings", "listing_id")),
    ("unique_dim_hosts_host_id", "error", "dim_hosts", _uniq("dim_hosts", "host_id")),
    ("unique_seed_amenity_name", "error", "seed_amenity", _uniq(_AV, "amenity_name")),
    ("unique_seed_verification_method", "error", "seed_verification", _uniq(_VV, "verification_method")),
    ("rejected_null_listing_ids", "warn", "listings", "(SELECT count(*) FROM raw_listings WHERE id IS NULL)"),
    ("not_null_stg_calendar", "error", "stg_calendar",
     _nn("stg_calendar", ["calendar_id", "listing_id", "calendar_date", "is_available", "price"])),
    ("not_null_stg_listings", "error", "stg_listings", _nn("stg_listings", ["listing_id", "host_id", "price"])),
    ("not_null_stg_changelog", "error", "stg_amenities_changelog", _nn("stg_changelog", ["listing_id", "changed_at"])),
    ("not_null_int_listing_daily", "warn", "int_listing_daily", _nn("int_listing_daily", ["amenity_count"])),
    ("not_null_int_listings", "error", "int_listings", _nn("int_listings", ["listing_id"])),
    ("not_null_int_reservations", "error", "int_reservations", _nn("int_reservations", ["reservation_revenue"])),
    ("not_null_seed_amenity", "error", "seed_amenity", _nn(_AV, ["amenity_name"])),
    ("not_null_seed_verification", "error", "seed_verification", _nn(_VV, ["verification_method"])),
    ("not_null_int_listing_amenities", "error", "int_listing_amenities",
     _nn("int_listing_amenities", ["listing_id", "amenity_name"])),
    ("not_null_fct_listing_daily", "error", "fct_listing_daily",
     _nn("fct_listing_daily", ["calendar_id", "listing_id", "is_deleted"])),
    ("not_null_fct_reservations", "error", "fct_reservations",
     _nn("fct_reservations", ["reservation_key", "check_in_date", "nights"])),
    ("not_null_dim_listings", "error", "dim_listings", _nn("dim_listings", ["listing_id", "is_deleted", "booked_nights"])),
    ("not_null_dim_hosts", "error", "dim_hosts", _nn("dim_hosts", ["host_id", "listing_count", "host_tenure_years"])),
    ("relationship_calendar_to_listings", "warn", "stg_calendar", _orph("stg_calendar", "stg_listings", "listing_id")),
    ("relationship_changelog_to_listings", "warn", "stg_amenities_changelog",
     _orph("stg_changelog", "stg_listings", "listing_id")),
    ("relationship_fct_daily_to_dim_listings", "error", "fct_listing_daily",
     _orph("fct_listing_daily", "dim_listings", "listing_id")),
    ("relationship_fct_reservations_to_dim_listings", "error", "fct_reservations",
     _orph("fct_reservations", "dim_listings", "listing_id")),
    ("relationship_listings_to_amenities", "warn", "int_listings", _orph("int_listings", "int_listing_amenities", "listing_id")),
    ("relationship_amenity_to_vocabulary", "warn", "int_listing_amenities",
     _orph("int_listing_amenities", _AV, "amenity_name")),
    ("relationship_verification_to_vocabulary", "warn", "int_host_verifications",
     _orph("int_host_verifications", _VV, "verification_method")),
    ("accepted_values_room_type", "error", "stg_listings",
     "(SELECT count(*) FROM stg_listings WHERE room_type IS NOT NULL AND room_type NOT IN "
     "('Entire home/apt', 'Private room'))"),
    ("accepted_range_accommodates", "warn", "stg_listings",
     "(SELECT count(*) FROM stg_listings WHERE accommodates IS NOT NULL AND accommodates < 1)"),
    ("accepted_range_price", "error", "stg_listings",
     "(SELECT count(*) FROM stg_listings WHERE price IS NOT NULL AND price <= 0)"),
    ("reservation_is_contiguous", "error", "int_reservations",
     "(SELECT count(*) FROM int_reservations WHERE NOT coalesce(is_contiguous, false))"),
    ("nights_reconcile", "error", "dim_listings",
     "(SELECT count(*) FROM dim_listings WHERE calendar_days IS NOT NULL AND "
     "NOT coalesce(booked_nights + available_nights = calendar_days, false))"),
    ("availability_matches_reservation", "error", "fct_listing_daily",
     "(SELECT count(*) FROM fct_listing_daily WHERE NOT coalesce(is_available = (reservation_id IS NULL), false))"),
    ("host_attributes_consistent", "warn", "stg_listings", f"(SELECT count(*) FROM ({_HOST_ATTRS}))"),
    ("deleted_listing_count", "warn", "int_listings",
     "(SELECT CAST(avg(CAST(is_deleted AS INTEGER)) > 0.05 AS INTEGER) FROM int_listings)"),
    ("amenities_predate_calendar", "warn", "stg_amenities_changelog",
     "(SELECT count(*) FROM stg_changelog WHERE CAST(changed_at AS DATE) >= "
     "(SELECT min(calendar_date) FROM fct_listing_daily))"),
    ("stay_cap_binds", "warn", "fct_listing_daily",
     f"(SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM ({_OVER_CAP}))"),
    ("amenity_values_outside_vocabulary", "warn", "int_listing_amenities",
     f"(SELECT count(*) FROM (SELECT DISTINCT amenity_name FROM int_listing_amenities WHERE amenity_name IS NOT NULL "
     f"EXCEPT SELECT amenity_name FROM {_AV}))"),
    ("amenity_vocabulary_unused", "warn", "seed_amenity",
     f"(SELECT count(*) FROM (SELECT amenity_name FROM {_AV} EXCEPT "
     f"SELECT amenity_name FROM int_listing_amenities WHERE amenity_name IS NOT NULL))"),
    ("verification_vocabulary_unused", "warn", "seed_verification",
     f"(SELECT count(*) FROM (SELECT verification_method FROM {_VV} EXCEPT "
     f"SELECT verification_method FROM int_host_verifications WHERE verification_method IS NOT NULL))"),
]

QUALITY_SUMMARY = PRELUDE + "\n" + _norm(
    " UNION ALL ".join(f"SELECT '{n}' AS check_name, '{s}' AS severity, '{r}' AS relation, "
                       f"CASE WHEN f = 0 THEN 'pass' WHEN '{s}' = 'error' THEN 'fail' ELSE 'warn' END AS status, f AS failing_rows FROM (SELECT {q} AS f)"
                       for n, s, r, q in CHECKS),
    {"check_name": "o", "severity": "o", "relation": "o", "failing_rows": "i", "status": "o"})

HOST_ATTRIBUTES = PRELUDE + "\n" + _norm(_HOST_ATTRS, {
    "host_id": "i", "distinct_host_name_masked": "i", "distinct_host_since": "i", "distinct_host_location": "i",
    "distinct_host_verifications": "i"})

WINDOWS_OVER_CAP = PRELUDE + "\n" + _norm(_OVER_CAP, {
    "listing_id": "i", "availability_window_seq": "i", "calendar_nights": "i", "max_maximum_nights": "i"})


def _block(sql: str) -> str:
    """A block's SQL without the prelude, as a subquery."""
    own = sql[len(PRELUDE):].strip()
    return "WITH" + own[1:] if own.startswith(",") else own


BLOCKS_RETURN_ROWS = PRELUDE + "\n" + _norm(
    " UNION ALL ".join(f"SELECT '{n}' AS block, EXISTS (SELECT 1 FROM ({_block(q)})) AS returns_rows" for n, q in sorted(QUESTIONS_SQL.items())),
    {"block": "o", "returns_rows": "o"})
