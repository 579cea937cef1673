"""Wires the layers together and materialises build-once relations.

``Warehouse(spark, sf_dir)`` exposes every relation by name. Relations read by
several consumers (the daily intermediate and the four marts) are written once
as parquet under the shared checkpoint folder the cluster names and read back,
which cuts lineage (an executor lost later recomputes from the written files,
not from the raw tables) and gives later queries parquet column pruning and
filter pushdown. Nights and reservations bound to the driver's tables are written
bucketed by listing; their names in the session's catalog go with ``release``. Set ``materialize=False`` for a fully lazy plan.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.functions.text import surrogate_key
from stayflow.plans import build as B
from stayflow.session import shared_dir
from stayflow.sources import testdata
from stayflow.sources.sinks import commit_build

# fct_listing_daily is a projection of int_listing_daily, so it is a view over that written table
_MATERIALIZED = ("order_days", "order_facts", "int_listing_daily", "fct_reservations", "dim_listings", "dim_hosts")
# read by several builders and by the quality suite; fact-sized ones are written to shared storage as well
_LANDED = ("stg_calendar", "stg_amenities_changelog", "int_reservations", "int_listing_amenities", "int_host_verifications")
# small next to the facts: kept (memory, spilling to disk) for this build only
_PERSISTED = ("stg_listings", "int_listings", "listing_features", "listing_rollup")

# written partitioned (directory pruning for month filters at scale)
_PARTITION_BY = {"int_listing_daily": ["month_start_date"]}

# a listing's rows lie together where they are made and are written so (bucketed): whoever groups or joins them by listing needs no shuffle
_BY_LISTING = ("order_days", "int_listing_amenities", "int_listing_daily", "int_reservations")
# of these, read by this build only: their names leave the catalog as soon as they are read back
_UNNAMED = ("order_days", "int_listing_amenities")

# at least so many writers per month; more as the cluster's shuffle partitions, which follow the size of the input, allow
LEAST_WRITERS, MONTHS_AT_ONCE = 8, 4


def writers_per_month(spark: SparkSession) -> int:
    return max(LEAST_WRITERS, int(spark.conf.get("spark.sql.shuffle.partitions")) // MONTHS_AT_ONCE)


# surrogate keys that their row's other columns give: text without any pattern, most of a narrow row's bytes on disk, so they are not
# written but made again when a reader asks for them
_KEYS_ON_READ = {
    "stg_calendar": ("calendar_id", ("listing_id", "calendar_date")),
    "stg_amenities_changelog": ("amenities_change_id", ("listing_id", "changed_at")),
    "int_listing_daily": ("calendar_id", ("listing_id", "calendar_date")),
    "int_reservations": ("reservation_key", ("listing_id", "reservation_id")),
    "fct_reservations": ("reservation_key", ("listing_id", "reservation_id")),
}

# other columns that their row's columns give and that cost more to keep on disk than to make again
_MADE_ON_READ: dict[str, dict[str, Callable[[], Column]]] = {
    "int_listing_daily": {"revenue": B.night_revenue},
    "int_reservations": {"check_out_date": B.check_out_date},
    "fct_reservations": {"check_out_date": B.check_out_date},
}

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written inside gives its shuffle files back as soon as it is written, not when the driver happens to collect its garbage.
    (A Spark that has no such setting ignores it.)"""
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


_CACHE: dict[tuple, "Warehouse"] = {}


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, cfg: B.BuildConfig | None = None,
                 materialize: bool = True, raw: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.cfg = cfg or B.BuildConfig()
        self.materialize = materialize
        self._raw = raw
        self._bound = raw is None
        self._rel: dict[str, DataFrame] = {}
        self._tasks = 0  # in which the nights of a bound build are made
        self._tables: list[str] = []
        self._made: dict[str, tuple[DataFrame, dict[str, tuple[str, ...]]]] = {}
        self.build_id = uuid.uuid4().hex[:12]

    @classmethod
    def for_dir(cls, spark: SparkSession, sf_dir: str, materialize: bool = True) -> "Warehouse":
        """One warehouse per (session, folder) within a process, so the marts are built once."""
        key = (id(spark), spark.sparkContext.applicationId, sf_dir, materialize)
        wh = _CACHE.get(key)
        if wh is None:
            wh = _CACHE[key] = cls(spark, sf_dir, materialize=materialize)
        return wh

    # raw --------------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        """The three raw rental tables. Bound to the driver's tables, the per-order
        and per-customer figures behind all three are landed once."""
        if self._raw is None:
            kept = []

            def keep(df):  # until the days are landed; in memory first, what does not fit goes to the executors' disks
                if self.materialize:
                    kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
                    self._tasks = testdata.tasks_of(df)
                return df

            def deal(df):  # into the tasks that make the nights
                return df.repartition(self._tasks, "listing_id") if self.materialize else df

            try:
                days = self._get("order_days", lambda: testdata.order_days(self.spark, self.sf_dir, keep, deal), dealt=True)
            finally:
                for df in kept:
                    df.unpersist()
            facts = self._get("order_facts", lambda: testdata.order_facts(self.spark, self.sf_dir))
            self._tasks = self._tasks or testdata.tasks_of(days)
            self._raw = {
                "listings": testdata.raw_listings(self.spark, self.sf_dir, days, facts),
                "calendar": testdata.raw_calendar(days, facts, self._tasks, self._bucketed),
                "amenities_changelog": testdata.raw_amenities_changelog(days),
            }
        return self._raw[name]

    @property
    def _bucketed(self) -> bool:
        """What is dealt by listing is written so; above the session's limit of buckets it is not."""
        return self.materialize and self._tasks <= int(self.spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))

    def _get(self, name: str, make, dealt: bool = False) -> DataFrame:
        """``dealt``: the plan has its rows together by listing in tasks that follow the input; they are written from there."""
        if name not in self._rel:
            df = make()
            if self.materialize and name in _MATERIALIZED + _LANDED:
                path = shared_dir(self.spark, "stayflow-builds", self.build_id, name)
                columns, (key, parts) = df.columns, _KEYS_ON_READ.get(name, (None, ()))
                others = _MADE_ON_READ.get(name, {})
                df = df.drop(*others, *([key] if key else []))
                months = _PARTITION_BY.get(name, [])
                if months and not dealt:  # writers in step with the shuffle partitions, whatever the number of tasks before
                    df = df.repartition(*months, F.pmod(F.xxhash64("listing_id"), F.lit(writers_per_month(self.spark))))
                writer = df.write.mode("overwrite").option("compression", "zstd").partitionBy(*months)
                with shuffles_freed(self.spark):
                    if dealt and name in _BY_LISTING and self._bucketed:
                        table = f"spark_catalog.default.stayflow_{self.build_id}_{name}"
                        writer.bucketBy(self._tasks, "listing_id").option("path", path).saveAsTable(table, format="parquet")
                        self._tables.append(table)
                        df = self.spark.table(table)
                        if name in _UNNAMED:
                            self._forget(table)
                    else:
                        writer.parquet(path)
                        df = self.spark.read.schema(df.schema).parquet(path)
                if key or others:
                    made = {c: other() for c, other in others.items()} | ({key: surrogate_key(*parts)} if key else {})
                    df = df.select(*(made[c].alias(c) if c in made else c for c in columns))
                if key:
                    self._made[name] = df, {key: parts}
            elif self.materialize and name in _PERSISTED:
                df = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._rel[name] = df
        return self._rel[name]

    def made_keys(self, name: str) -> dict[str, tuple[str, ...]]:
        """The surrogate keys of a relation that are made of its other columns on reading, with these columns."""
        df, keys = self._made.get(name, (None, {}))
        return keys if df is not None and df is self._rel.get(name) else {}

    @property
    def _dealt(self) -> bool:
        return self._bound and self.cfg.amenity_history == "latest"

    # staging ----------------------------------------------------------
    def stg_listings(self):
        return self._get("stg_listings", lambda: B.stg_listings(self.raw("listings"), self.cfg))

    def stg_calendar(self):
        return self._get("stg_calendar", lambda: B.stg_calendar(self.raw("calendar")))

    def calendar_by_listing(self):
        """``stg_calendar`` for what goes through it listing by listing. Bound to the driver's tables its plan makes the nights of a listing in one
        task, which is cheaper than shuffling the written ones."""
        return B.stg_calendar(self.raw("calendar")) if self._bound else self.stg_calendar()

    def stg_amenities_changelog(self):
        return self._get("stg_amenities_changelog", lambda: B.stg_amenities_changelog(self.raw("amenities_changelog")))

    def changelog_by_listing(self):
        """``stg_amenities_changelog`` for what goes through it listing by listing. Bound to the driver's tables it is made from the stays, which
        lie by listing, so it need not be written for these readers, nor shuffled."""
        return B.stg_amenities_changelog(self.raw("amenities_changelog")) if self._bound else self.stg_amenities_changelog()

    # intermediate -----------------------------------------------------
    def int_listing_amenities(self):
        return self._get("int_listing_amenities", lambda: B.int_listing_amenities(self.changelog_by_listing()), dealt=self._bound)

    def int_host_verifications(self):
        return self._get("int_host_verifications", lambda: B.int_host_verifications(self.stg_listings()))

    def int_listings(self):
        # bound, the listings of the calendar are known without its nights
        def make():
            changelog, listings = self.changelog_by_listing(), self.stg_listings()
            named = testdata.calendar_listings(self._rel["order_days"], self._rel["order_facts"]) if self._bound else self.stg_calendar()
            return B.int_listings(changelog, listings, named)

        return self._get("int_listings", make)

    def listing_features(self):
        return self._get("listing_features", lambda: B.listing_features(self.int_listing_amenities(), self.cfg))

    def listing_feature_history(self):
        return self._get("listing_feature_history", lambda: B.listing_feature_history(self.stg_amenities_changelog(), self.cfg))

    def int_listing_daily(self):
        def make():
            features = self.listing_feature_history() if self.cfg.amenity_history == "in_force" else self.listing_features()
            return B.int_listing_daily(self.calendar_by_listing(), self.int_listings(), features, self.cfg)

        return self._get("int_listing_daily", make, dealt=self._dealt)

    def listing_rollup(self):
        return self._get("listing_rollup", lambda: B.listing_rollup(self.int_listing_daily()))

    def int_reservations(self):
        return self._get("int_reservations", lambda: B.int_reservations(self.int_listing_daily()), dealt=self._dealt)

    def int_hosts(self):
        return self._get("int_hosts", lambda: B.int_hosts(
            self.int_listings(), self.listing_rollup(), self.int_reservations(),
            self.int_host_verifications(), self.cfg))

    # marts ------------------------------------------------------------
    def fct_listing_daily(self):
        def make():
            df = B.fct_listing_daily(self.int_listing_daily(), self.cfg)
            self._made["fct_listing_daily"] = df, self.made_keys("int_listing_daily")
            return df

        return self._get("fct_listing_daily", make)

    def fct_reservations(self):
        return self._get("fct_reservations", lambda: B.fct_reservations(
            self.int_reservations(), self.int_listings(), self.listing_features(), self.cfg))

    def dim_listings(self):
        return self._get("dim_listings", lambda: B.dim_listings(
            self.int_listings(), self.int_listing_daily(), self.listing_rollup(), self.listing_features(), self.cfg))

    def dim_hosts(self):
        return self._get("dim_hosts", lambda: B.dim_hosts(self.int_hosts(), self.int_listing_daily(), self.cfg))

    def relation(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def register_views(self, names=("stg_listings", "stg_calendar", "stg_amenities_changelog", "int_listings",
                                    "int_listing_daily", "int_reservations", "int_hosts", "fct_listing_daily",
                                    "fct_reservations", "dim_listings", "dim_hosts")) -> list[str]:
        """Expose relations as temporary views, so they can be queried with ``spark.sql``."""
        for n in names:
            self.relation(n).createOrReplaceTempView(n)
        return list(names)

    def _forget(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # its name; the files stay
        self._tables.remove(table)

    def release(self) -> None:
        """Drop what this build persisted (the written tables stay on shared storage)."""
        for name, df in self._rel.items():
            if name in _PERSISTED:
                df.unpersist()
        while self._tables:
            self._forget(self._tables[-1])
        for key, wh in list(_CACHE.items()):
            if wh is self:
                del _CACHE[key]

    def build_all(self, enforce: bool = False) -> dict[str, DataFrame]:
        """The four marts. With ``enforce`` the quality suite runs over them and a failing check of severity error stops
        the build."""
        marts = {n: self.relation(n) for n in ("fct_listing_daily", "fct_reservations", "dim_listings", "dim_hosts")}
        if enforce:
            from stayflow.plans import quality

            failed = quality.run_checks(self).where("status = 'fail'").select("check_name", "failing_rows").collect()
            if failed:
                raise quality.QualityError(", ".join(f"{r.check_name}: {r.failing_rows} rows" for r in failed))
        return marts

    def publish(self, path: str, build_id: int, enforce: bool = False):
        """Commit the four marts to the build log under ``path``, all of them at once."""
        return commit_build(self.spark, path, build_id, self.build_all(enforce))
