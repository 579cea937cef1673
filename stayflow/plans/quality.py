"""Data-quality checks: each returns the failing rows (empty = pass).

A check is (name, severity, relation, builder). ``run_checks`` unions one
count per check into a single result, so the whole suite is one Spark job of
independent aggregations rather than a driver loop of actions.

Severity follows the reference's policy: a change in a source or vocabulary
is ``warn``; a defect in our own build is ``error``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.operators.entity import orphans
from stayflow.operators.keys import ORPHAN_KEYS, ORPHAN_ROWS, UNIQUE, KeyCheck, check_keys
from stayflow.plans import models
from stayflow.plans.warehouse import Warehouse
from stayflow.sources.seeds import load_vocabulary

class QualityError(RuntimeError):
    """A check of severity error has failing rows."""


ROOM_TYPES = ("Entire home/apt", "Private room")


# ----------------------------------------------------------------- primitives
def unique(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def null_in(cols: Sequence[str]) -> Column:
    """Failing-row predicate: any of ``cols`` is NULL."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def outside_values(col: str, values: Sequence) -> Column:
    return F.col(col).isNotNull() & ~F.col(col).isin(*values)


def outside_range(col: str, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    c = F.col(col)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | ((c < min_value) if inclusive else (c <= min_value))
    if max_value is not None:
        bad = bad | ((c > max_value) if inclusive else (c >= max_value))
    return c.isNotNull() & bad


def not_true(expr: Column) -> Column:
    """False or NULL (stricter on NULL than a warehouse test that only counts false)."""
    return ~F.coalesce(expr, F.lit(False))


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.filter(null_in(cols))


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(outside_values(col, values))


def accepted_range(df: DataFrame, col: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    return df.filter(outside_range(col, min_value, max_value, inclusive))


def expression_is_true(df: DataFrame, expr: Column) -> DataFrame:
    """Rows where the expression is false or NULL."""
    return df.filter(not_true(expr))


def attributes_agree(df: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """Keys whose denormalised attributes disagree across child rows."""
    g = df.groupBy(key).agg(*[F.count_distinct(a).alias(f"distinct_{a}") for a in attrs])
    cond = reduce(lambda a, b: a | b, [F.col(f"distinct_{a}") > 1 for a in attrs])
    return g.filter(cond)


def count_is(df: DataFrame, expected: Column, label: str) -> DataFrame:
    """One row when the row count differs from ``expected`` (a one-value column)."""
    got = df.agg(F.count(F.lit(1)).alias("actual")).withColumn("expected", expected.cast("long"))
    return got.filter(F.col("actual") != F.col("expected")).withColumn("what", F.lit(label))


def events_inside_window(events: DataFrame, time_col: str, window_start: Column) -> DataFrame:
    return events.filter(F.to_date(F.col(time_col)) >= window_start)


def nonempty(df: DataFrame, label: str) -> DataFrame:
    """One row when ``df`` is empty (a premise that must hold somewhere)."""
    return df.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == 0).withColumn("what", F.lit(label))


# ----------------------------------------------------------------- the suite
@dataclass(frozen=True)
class Check:
    """A check is a failing-rows builder, a row predicate over a source relation (``source``, ``predicate``), or a key check.
    ``run_checks`` counts predicate checks on the same relation together in one pass, and all key checks in one pass over each
    relation and one shuffle."""

    name: str
    severity: str
    relation: str
    failing: Callable[[Warehouse], DataFrame] | None = None
    source: Callable[[Warehouse], DataFrame] | None = None
    predicate: Column | None = None
    key: KeyCheck | None = None

    def rows(self, wh: Warehouse) -> DataFrame:
        if self.key is None:
            return self.failing(wh) if self.failing is not None else self.source(wh).filter(self.predicate)
        child = _relation(wh, self.key.child)
        if self.key.kind == UNIQUE:
            return unique(child, self.key.child_columns)
        fk, pk = self.key.child_columns[0], self.key.parent_columns[0]
        lost = orphans(child, _relation(wh, self.key.parent), fk, pk)
        return lost.select(F.col(fk).alias("value")).distinct() if self.key.kind == ORPHAN_KEYS else lost


def _relation(wh: Warehouse, name: str) -> DataFrame:
    """A relation of the build, a seed, or a vocabulary that the build pivots on (the checked-in seeds by default)."""
    if name in ("seed_amenity", "seed_verification"):
        return load_vocabulary(wh.spark, name.removeprefix("seed_"))
    if name == "amenities":
        return wh.spark.createDataFrame([(v,) for v in wh.cfg.amenities], "amenity_name string")
    if name == "verifications":
        return wh.spark.createDataFrame([(v,) for v in wh.cfg.verifications], "verification_method string")
    return wh.relation(name)


def _deleted_listings_off(wh: Warehouse) -> DataFrame:
    """One row when the number of listings without a listings row is not the pinned one (or, where none is
    pinned, above the pinned share): a load that lost listings shows here."""
    got = wh.int_listings().agg(F.count_if("is_deleted").alias("deleted"), F.count(F.lit(1)).alias("listings"))
    if wh.cfg.expected_deleted_listings is not None:
        return got.filter(F.col("deleted") != wh.cfg.expected_deleted_listings)
    return got.filter(F.col("deleted") > F.col("listings") * wh.cfg.max_deleted_share)


def _windows_over_cap(wh: Warehouse) -> DataFrame:
    w = models.listing_daily(wh).query(["daily.calendar_nights", "daily.max_maximum_nights"],
                                       ["daily.listing_id", "daily.availability_window_seq"],
                                       where=lambda m: m("daily.is_available"))
    return w.filter(F.col("calendar_nights") > F.col("max_maximum_nights"))


def checks(wh: Warehouse) -> list[Check]:
    spark = wh.spark
    return [
        # unique
        Check("unique_stg_calendar_calendar_id", "error", "stg_calendar", key=KeyCheck("unique_stg_calendar_calendar_id", UNIQUE, "stg_calendar", ("calendar_id",))),
        Check("unique_stg_calendar_grain", "error", "stg_calendar", key=KeyCheck("unique_stg_calendar_grain", UNIQUE, "stg_calendar", ("listing_id", "calendar_date"))),
        Check("unique_stg_changelog_id", "error", "stg_amenities_changelog", key=KeyCheck("unique_stg_changelog_id", UNIQUE, "stg_amenities_changelog", ("amenities_change_id",))),
        Check("unique_stg_listings_listing_id", "error", "stg_listings", key=KeyCheck("unique_stg_listings_listing_id", UNIQUE, "stg_listings", ("listing_id",))),
        Check("unique_int_listings_listing_id", "error", "int_listings", key=KeyCheck("unique_int_listings_listing_id", UNIQUE, "int_listings", ("listing_id",))),
        Check("unique_fct_listing_daily_calendar_id", "error", "fct_listing_daily", key=KeyCheck("unique_fct_listing_daily_calendar_id", UNIQUE, "fct_listing_daily", ("calendar_id",))),
        Check("unique_fct_reservations_key", "error", "fct_reservations", key=KeyCheck("unique_fct_reservations_key", UNIQUE, "fct_reservations", ("reservation_key",))),
        Check("unique_dim_listings_listing_id", "error", "dim_listings", key=KeyCheck("unique_dim_listings_listing_id", UNIQUE, "dim_listings", ("listing_id",))),
        Check("unique_dim_hosts_host_id", "error", "dim_hosts", key=KeyCheck("unique_dim_hosts_host_id", UNIQUE, "dim_hosts", ("host_id",))),
        Check("unique_seed_amenity_name", "error", "seed_amenity", key=KeyCheck("unique_seed_amenity_name", UNIQUE, "seed_amenity", ("amenity_name",))),
        Check("unique_seed_verification_method", "error", "seed_verification", key=KeyCheck("unique_seed_verification_method", UNIQUE, "seed_verification", ("verification_method",))),
        # rejected at staging (kept as a count, as the reference reports its NULL-id rows)
        Check("rejected_null_listing_ids", "warn", "listings",
              lambda w: w.raw("listings").filter(F.col("id").isNull())),
        # not null
        Check("not_null_stg_calendar", "error", "stg_calendar", source=lambda w: w.stg_calendar(),
              predicate=null_in(["calendar_id", "listing_id", "calendar_date", "is_available", "price"])),
        Check("not_null_stg_listings", "error", "stg_listings", source=lambda w: w.stg_listings(),
              predicate=null_in(["listing_id", "host_id", "price"])),
        Check("not_null_stg_changelog", "error", "stg_amenities_changelog", source=lambda w: w.stg_amenities_changelog(),
              predicate=null_in(["listing_id", "changed_at"])),
        Check("not_null_int_listing_daily", "warn", "int_listing_daily", source=lambda w: w.int_listing_daily(),
              predicate=null_in(["amenity_count"])),
        Check("not_null_int_listings", "error", "int_listings", source=lambda w: w.int_listings(), predicate=null_in(["listing_id"])),
        Check("not_null_int_reservations", "error", "int_reservations", source=lambda w: w.int_reservations(),
              predicate=null_in(["reservation_revenue"])),
        Check("not_null_seed_amenity", "error", "seed_amenity", source=lambda w: load_vocabulary(spark, "amenity"),
              predicate=null_in(["amenity_name"])),
        Check("not_null_seed_verification", "error", "seed_verification", source=lambda w: load_vocabulary(spark, "verification"),
              predicate=null_in(["verification_method"])),
        Check("not_null_int_listing_amenities", "error", "int_listing_amenities",
              source=lambda w: w.int_listing_amenities(), predicate=null_in(["listing_id", "amenity_name"])),
        Check("not_null_fct_listing_daily", "error", "fct_listing_daily", source=lambda w: w.fct_listing_daily(),
              predicate=null_in(["calendar_id", "listing_id", "is_deleted"])),
        Check("not_null_fct_reservations", "error", "fct_reservations", source=lambda w: w.fct_reservations(),
              predicate=null_in(["reservation_key", "check_in_date", "nights"])),
        Check("not_null_dim_listings", "error", "dim_listings", source=lambda w: w.dim_listings(),
              predicate=null_in(["listing_id", "is_deleted", "booked_nights"])),
        Check("not_null_dim_hosts", "error", "dim_hosts", source=lambda w: w.dim_hosts(),
              predicate=null_in(["host_id", "listing_count", "host_tenure_years"])),
        # relationships
        Check("relationship_calendar_to_listings", "warn", "stg_calendar", key=KeyCheck("relationship_calendar_to_listings", ORPHAN_ROWS, "stg_calendar", ("listing_id",), "stg_listings", ("listing_id",))),
        Check("relationship_changelog_to_listings", "warn", "stg_amenities_changelog", key=KeyCheck("relationship_changelog_to_listings", ORPHAN_ROWS, "stg_amenities_changelog", ("listing_id",), "stg_listings", ("listing_id",))),
        Check("relationship_fct_daily_to_dim_listings", "error", "fct_listing_daily", key=KeyCheck("relationship_fct_daily_to_dim_listings", ORPHAN_ROWS, "fct_listing_daily", ("listing_id",), "dim_listings", ("listing_id",))),
        Check("relationship_fct_reservations_to_dim_listings", "error", "fct_reservations", key=KeyCheck("relationship_fct_reservations_to_dim_listings", ORPHAN_ROWS, "fct_reservations", ("listing_id",), "dim_listings", ("listing_id",))),
        Check("relationship_listings_to_amenities", "warn", "int_listings", key=KeyCheck("relationship_listings_to_amenities", ORPHAN_ROWS, "int_listings", ("listing_id",), "int_listing_amenities", ("listing_id",))),
        Check("relationship_amenity_to_vocabulary", "warn", "int_listing_amenities", key=KeyCheck("relationship_amenity_to_vocabulary", ORPHAN_ROWS, "int_listing_amenities", ("amenity_name",), "amenities", ("amenity_name",))),
        Check("relationship_verification_to_vocabulary", "warn", "int_host_verifications", key=KeyCheck("relationship_verification_to_vocabulary", ORPHAN_ROWS, "int_host_verifications", ("verification_method",), "verifications", ("verification_method",))),
        # values and ranges
        Check("accepted_values_room_type", "error", "stg_listings", source=lambda w: w.stg_listings(),
              predicate=outside_values("room_type", ROOM_TYPES)),
        Check("accepted_range_accommodates", "warn", "stg_listings", source=lambda w: w.stg_listings(),
              predicate=outside_range("accommodates", min_value=1)),
        Check("accepted_range_price", "error", "stg_listings", source=lambda w: w.stg_listings(),
              predicate=outside_range("price", min_value=0, inclusive=False)),
        # expressions
        Check("reservation_is_contiguous", "error", "int_reservations", source=lambda w: w.int_reservations(),
              predicate=not_true(F.col("is_contiguous"))),
        Check("nights_reconcile", "error", "dim_listings", source=lambda w: w.dim_listings(),
              predicate=F.col("calendar_days").isNotNull() & not_true(
                  F.col("booked_nights") + F.col("available_nights") == F.col("calendar_days"))),
        Check("availability_matches_reservation", "error", "fct_listing_daily", source=lambda w: w.fct_listing_daily(),
              predicate=not_true(F.col("is_available") == F.col("reservation_id").isNull())),
        # singular
        Check("host_attributes_consistent", "warn", "stg_listings",
              lambda w: attributes_agree(w.stg_listings(), "host_id",
                                         ["host_name_masked", "host_since", "host_location", "host_verifications"])),
        Check("deleted_listing_count", "warn", "int_listings",
              lambda w: _deleted_listings_off(w)),
        Check("amenities_predate_calendar", "warn", "stg_amenities_changelog",
              lambda w: events_inside_window(w.stg_amenities_changelog(), "changed_at",
                                             w.fct_listing_daily().select(F.min("calendar_date")).scalar())),
        Check("stay_cap_binds", "warn", "fct_listing_daily", lambda w: nonempty(_windows_over_cap(w), "cap never binds")),
        # vocabulary drift
        Check("amenity_values_outside_vocabulary", "warn", "int_listing_amenities", key=KeyCheck(
            "amenity_values_outside_vocabulary", ORPHAN_KEYS, "int_listing_amenities", ("amenity_name",), "amenities", ("amenity_name",))),
        Check("amenity_vocabulary_unused", "warn", "seed_amenity", key=KeyCheck(
            "amenity_vocabulary_unused", ORPHAN_KEYS, "amenities", ("amenity_name",), "int_listing_amenities", ("amenity_name",))),
        Check("verification_vocabulary_unused", "warn", "seed_verification", key=KeyCheck(
            "verification_vocabulary_unused", ORPHAN_KEYS, "verifications", ("verification_method",), "int_host_verifications", ("verification_method",))),
    ]


def run_checks(wh: Warehouse, only: Sequence[str] | None = None) -> DataFrame:
    """One row per check: name, severity, relation, failing row count, status (pass, warn or fail).

    Predicate checks on one relation are counted in a single pass over it
    (one ``count_if`` per check), key checks together in one pass over each relation and one shuffle; every
    other check is one aggregation. All parts are unioned into one result (one job)."""
    selected = [c for c in checks(wh) if not only or c.name in only]
    parts = []
    by_relation: dict[str, list[Check]] = {}
    keyed = [c for c in selected if c.key is not None]
    if keyed:
        named = {n for c in keyed for n in (c.key.child, c.key.parent) if n}
        relations = {n: _relation(wh, n) for n in sorted(named)}
        found = check_keys(relations, [c.key for c in keyed], {n: wh.made_keys(n) for n in relations})
        about = wh.spark.createDataFrame([(c.name, c.severity, c.relation) for c in keyed], "check_name string, severity string, relation string")
        parts.append(about.join(found, "check_name").select("check_name", "severity", "relation", "failing_rows"))
    for c in selected:
        if c.key is not None:
            continue
        if c.failing is None:
            by_relation.setdefault(c.relation, []).append(c)
            continue
        parts.append(c.failing(wh).agg(F.count(F.lit(1)).alias("failing_rows")).select(
            F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"),
            F.lit(c.relation).alias("relation"), "failing_rows"))
    for relation, group in by_relation.items():
        counts = group[0].source(wh).agg(*[F.count_if(c.predicate).alias(f"_c{i}") for i, c in enumerate(group)])
        rows = F.explode(F.array(*[
            F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"),
                     F.lit(relation).alias("relation"), F.col(f"_c{i}").cast("long").alias("failing_rows"))
            for i, c in enumerate(group)]))
        parts.append(counts.select(rows.alias("_r")).select("_r.*"))
    status = F.when(F.col("failing_rows") == 0, "pass").when(F.col("severity") == "error", "fail").otherwise("warn")
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)


def distinct_blocks(wh: Warehouse, names: Sequence[str] | None = None) -> dict[str, tuple[DataFrame, list[str]]]:
    """Question blocks by plan: the first name of each, its frame, and all names whose plans give the same rows."""
    from stayflow.plans.questions import QUESTIONS

    out: dict[str, tuple[DataFrame, list[str]]] = {}
    by_hash: dict[int, list[str]] = {}
    for name, make in sorted(QUESTIONS.items()):
        if names and name not in names:
            continue
        df = make(wh)
        same = next((n for n in by_hash.setdefault(df.semanticHash(), []) if out[n][0].sameSemantics(df)), None)
        if same:
            out[same][1].append(name)
        else:
            by_hash[df.semanticHash()].append(name)
            out[name] = (df, [name])
    return out


def blocks_return_rows(wh: Warehouse, names: Sequence[str] | None = None) -> DataFrame:
    """One row per question block: block, returns_rows. Each distinct plan is asked once, for one row, as a scalar subquery; all of them
    are one query, run side by side."""
    asked = []
    for df, same in distinct_blocks(wh, names).values():
        there = df.limit(1).agg(F.count(F.lit(1)).alias("n")).scalar() > 0
        asked += [F.struct(F.lit(n).alias("block"), there.alias("returns_rows")) for n in same]
    return wh.spark.range(1).select(F.explode(F.array(*asked)).alias("r")).select("r.*")


def questions_return_rows(wh: Warehouse, names: Sequence[str] | None = None) -> dict[str, bool]:
    """``blocks_return_rows`` as a dictionary."""
    return {r.block: r.returns_rows for r in blocks_return_rows(wh, names).collect()}
