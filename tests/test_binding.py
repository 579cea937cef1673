"""The binding of the driver's tables loses no order and no item, and stays never meet on a listing."""

import datetime as dt
import hashlib
import random
import time
from collections import defaultdict

from pyspark.sql import functions as F

from stayflow.plans import build
from stayflow.plans.warehouse import Warehouse
from stayflow.sources import testdata
from stayflow.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def test_every_order_with_items_and_every_item_is_there(spark):
    wh = Warehouse.for_dir(spark, SF)
    items = read_table(spark, SF, "lineitem", ["l_orderkey"]).join(read_table(spark, SF, "orders", ["o_orderkey"]), F.col("l_orderkey") == F.col("o_orderkey"))
    stays = wh.fct_reservations()
    assert stays.agg(F.sum("nights")).first()[0] == items.count()
    assert stays.count() == items.select("l_orderkey").distinct().count()
    assert wh.fct_listing_daily().where("NOT is_available").count() == items.count()
    assert stays.where("NOT is_contiguous").count() == 0


def swept(orders, items):
    """Stays one after another on each listing, by a plain loop."""
    count = defaultdict(int)
    for cust, key, _ in orders:
        count[cust] += items[key] > 0
    by = defaultdict(list)
    for cust, key, day in orders:
        if items[key]:
            units = -(-count[cust] // testdata.UNIT_STAYS)
            by[cust + testdata.UNIT_STRIDE * (int(hashlib.md5(str(key).encode()).hexdigest()[:7], 16) % units)].append(((day.timetuple().tm_yday - 1) % testdata.SEASON_DAYS, key))
    out = set()
    for listing, wishes in by.items():
        free = -1
        for wish, key in sorted(wishes):
            begin = max(wish, free)
            free = begin + items[key]
            out.add((listing, key, dt.date.fromisoformat(testdata.SEASON_START) + dt.timedelta(days=begin), items[key]))
    return out


def test_a_customer_with_a_third_of_all_orders(spark, tmp_dir):
    rng = random.Random(6)
    orders = [(1 if i % 3 == 0 else rng.randrange(2, 60), i, dt.datetime(1995, 1, 1) + dt.timedelta(days=rng.randrange(2000))) for i in range(1500)]
    items = {key: rng.choice([0, 1, 1, 2, 4, 7, 12]) for _, key, _ in orders}
    spark.createDataFrame(orders, "o_custkey long, o_orderkey long, o_orderdate timestamp_ntz").write.parquet(tmp_dir + "/t/orders.parquet")
    lines = [(key, "N", "O", 1.0) for key, n in items.items() for _ in range(n)]
    spark.createDataFrame(lines, "l_orderkey long, l_returnflag string, l_linestatus string, l_quantity double").write.parquet(tmp_dir + "/t/lineitem.parquet")
    got = {(r.listing_id, r.order_id, r.date, r.n_items) for r in testdata.order_days(spark, tmp_dir + "/t").collect()}
    assert got == swept(orders, items)
    per_listing = defaultdict(int)
    for listing, *_ in got:
        per_listing[listing] += 1
    assert len([k for k in per_listing if k % testdata.UNIT_STRIDE == 1]) > 20 and max(per_listing.values()) <= 4 * testdata.UNIT_STAYS


def test_nights_are_made_where_their_stays_lie(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    stays = [(1, 10, day(3), 2), (1, 11, day(5), 1), (1, 12, day(9), 4), (2, 20, day(0), 13), (2 + testdata.UNIT_STRIDE, 21, day(4), 1), (3, 30, None, 5), (None, 40, day(2), 2)]
    days = spark.createDataFrame([(*s, ["view"]) for s in stays], "listing_id long, order_id long, date date, n_items int, names array<string>")
    figures = [(c, 3, 1, 1, 1, c % 2, dt.datetime(1995, 1, 1), dt.datetime(1996, 1, 1), 1000 * c, "[]", 2.0) for c in (1, 2, 3, 4)]
    facts = spark.createDataFrame(figures, "o_custkey long, n_orders long, n_f long, n_o long, n_p long, n_urgent long, first_order timestamp_ntz, "
                                  "last_order timestamp_ntz, list_cents long, priorities string, avg_priority double")
    cal = testdata.raw_calendar(days, facts)
    taken = {(u, d + dt.timedelta(days=i)): f"R{o}" for u, o, d, n in stays if d for i in range(n)}
    want = sorted((u, day(n), taken.get((u, day(n)), "NULL")) for u in (1, 2, 2 + testdata.UNIT_STRIDE, 3, 4) for n in range(13))
    assert sorted((r.listing_id, r.date, r.reservation_id) for r in cal.collect()) == want
    # 5 listings x 13 nights: no exchange and no join above the place where nights are made
    plan = cal.groupBy("listing_id", "date").count()._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Generate explode(sequence(")]
    assert "Exchange" not in above and "Join" not in above


def test_surrogate_keys_are_not_written(spark):
    wh = Warehouse.for_dir(spark, SF)
    for name, key, parts in (("stg_calendar", "calendar_id", "listing_id, calendar_date"), ("int_listing_daily", "calendar_id", "listing_id, calendar_date"),
                             ("fct_reservations", "reservation_key", "listing_id, reservation_id")):
        df = wh.relation(name)
        assert df.where(f"{key} != md5(concat_ws('-', {parts})) OR {key} IS NULL").count() == 0
        assert key not in spark.read.parquet(df.inputFiles()[0]).columns
    assert wh.stg_calendar().columns[0] == "calendar_id" and wh.fct_reservations().columns[0] == "reservation_key"


def test_the_daily_table_shuffles_no_night(spark):
    wh = Warehouse.for_dir(spark, SF)
    calendar, listings, features = wh.calendar_by_listing(), wh.int_listings(), wh.listing_features()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where listings are too many to broadcast
    try:
        plan = build.int_listing_daily(calendar, listings, features, wh.cfg)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    above = plan[: plan.index("Generate explode(sequence(")]
    assert above.count("SortMergeJoin") == 2 and "Exchange" not in above


def test_a_mart_writes_the_nights_once(spark):
    wh = Warehouse(spark, SF)
    wh.fct_listing_daily()
    assert "stg_calendar" not in wh._rel and wh.int_listings().select("listing_id").exceptAll(wh.stg_calendar().select("listing_id").distinct()).count() == 0
    wh.release()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stays_travel_with_bits_and_are_read_once(spark, tmp_dir):
    orders = [(k % 3, k, dt.datetime(1995, 1, 1 + k)) for k in range(12)] + [(1, None, None), (None, 5, None)]
    lines = [(k, flag, status, qty) for k in range(12) for flag, status, qty in
             [("N", "O", 1.0), ("N", "F", 2.0), ("R", "F", 3.0), ("A", "F", 4.0), ("R", "O", 46.0), (None, None, None)][: k % 7]]
    spark.createDataFrame(orders, "o_custkey long, o_orderkey long, o_orderdate timestamp_ntz").write.parquet(tmp_dir + "/t/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_returnflag string, l_linestatus string, l_quantity double").write.parquet(tmp_dir + "/t/lineitem.parquet")
    kept = []
    days = testdata.order_days(spark, tmp_dir + "/t", lambda df: kept.append(df.persist()) or kept[-1])
    plan = _plan(days)
    assert "collect_set" not in plan and len(kept) == 1 and plan.count("InMemoryTableScan") >= 2
    names = ["signup", "purchase", "click", "view", "error", "purchase"]
    assert {r.order_id: sorted(r.names) for r in days.collect()} == {k: sorted(set(names[: k % 7])) for k in range(12) if k % 7}
    kept[0].unpersist()


def test_listings_of_the_calendar_are_known_without_nights(spark):
    form = "listing_id long, order_id long, date date, n_items int, names array<string>"
    facts = spark.createDataFrame([(c, 3, 1, 1, 1, 1, dt.datetime(1995, 1, 1), dt.datetime(1996, 1, 1), 1000, "[]", 2.0) for c in (1, 2, 4)],
                                  "o_custkey long, n_orders long, n_f long, n_o long, n_p long, n_urgent long, first_order timestamp_ntz, "
                                  "last_order timestamp_ntz, list_cents long, priorities string, avg_priority double")
    stays = [(1, 10, dt.date(2024, 1, 3), 2, ["view"]), (2 + testdata.UNIT_STRIDE, 21, None, 1, ["view"]), (None, 40, dt.date(2024, 1, 1), 2, ["view"]), (9, 50, None, 1, [])]
    for some in (stays, [(*s[:2], None, *s[3:]) for s in stays], []):
        days = spark.createDataFrame(some, form)
        known = testdata.calendar_listings(days, facts)
        assert {r.listing_id for r in known.collect()} == {r.listing_id for r in testdata.raw_calendar(days, facts).select("listing_id").distinct().collect()}
        assert "explode" not in _plan(known)


def test_nights_are_read_by_listing_without_a_shuffle(spark):
    wh = Warehouse(spark, SF)
    daily, stays = wh.int_listing_daily(), wh.int_reservations()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where listings are too many to broadcast
    try:
        for some in (daily.groupBy("listing_id").agg(F.count_distinct("price")), daily.groupBy("listing_id", "reservation_id").agg(F.sum("revenue")),
                     daily.groupBy("listing_id", "calendar_date").count(), stays.groupBy("listing_id").count(),
                     stays.join(daily.groupBy("listing_id").agg(F.max("price")), "listing_id")):
            assert "Exchange" not in _plan(some)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    tables = [t.name for t in spark.catalog.listTables() if wh.build_id in t.name]
    assert len(tables) == 2
    wh.release()
    assert not [t.name for t in spark.catalog.listTables() if wh.build_id in t.name]


def test_stays_are_written_by_listing_and_shuffled_no_more(spark):
    wh = Warehouse(spark, SF)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        calendar, amenities = _plan(wh.raw("calendar")), _plan(build.int_listing_amenities(wh.changelog_by_listing()))
        features = _plan(build.listing_features(wh.int_listing_amenities(), wh.cfg))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [line for line in calendar.splitlines() if "Exchange" in line and "order_id" in line or "REPARTITION_BY_NUM" in line and "n_items" in line]
    assert "Exchange" not in amenities and "Exchange" not in features
    days = wh._rel["order_days"]
    assert days.groupBy("listing_id").count().count() == days.select("listing_id").distinct().count() > 0
    wh.fct_reservations()
    assert "stg_amenities_changelog" not in wh._rel  # nothing in this mart reads it but by listing
    assert wh.changelog_by_listing().exceptAll(wh.stg_amenities_changelog()).count() == 0
    wh.release()


def test_columns_made_on_reading_are_not_written(spark):
    wh = Warehouse(spark, SF)
    daily, stays, mart = wh.int_listing_daily(), wh.int_reservations(), wh.fct_reservations()
    for df, column in ((daily, "revenue"), (stays, "check_out_date"), (mart, "check_out_date")):
        files = [f for f in df.inputFiles()]
        assert files and column in df.columns and column not in spark.read.parquet(files[0]).columns
    lazy = Warehouse(spark, SF, materialize=False)
    for df, other in ((daily, lazy.int_listing_daily()), (stays, lazy.int_reservations()), (mart, lazy.fct_reservations())):
        assert df.schema.simpleString() == other.schema.simpleString()
        assert df.exceptAll(other).count() == 0 and other.exceptAll(df).count() == 0
    wh.release()


def test_a_written_relation_gives_its_shuffle_files_back(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().endswith(".data")}

    wh, there = Warehouse(spark, SF), files()
    counted = spark.range(5000).groupBy((F.col("id") % 97).alias("listing_id")).count()
    wh._get("stg_calendar", lambda: counted)
    for _ in range(50):
        if files() <= there:
            break
        time.sleep(0.2)
    assert files() <= there and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert wh._rel["stg_calendar"].count() == 97
