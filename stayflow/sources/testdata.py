"""Binding of the driver's tables to the three raw rental tables.

``listings``, ``calendar`` and ``amenities_changelog`` are not among the driver's tables, so each is derived here by
Spark from whole given tables, and all work grows with them. No order with items and no item is left out: the booked
nights of the calendar are the line items, one each.

An order with items is a stay, wished for from its folded date on: the n-th day of its year becomes day
``(n - 1) mod SEASON_DAYS`` after ``SEASON_START``. A customer lets one listing per ``UNIT_STAYS`` orders with items (rounded up),
and orders are dealt to them by a hash of the order key; so a customer with very many orders has many listings, each with a few stays.
On a listing, stays follow by folded date, then order key: each takes its nights, one per line item, from its folded date
or from the first night that the stays before it leave free, whichever is later.

calendar (listing x date): every listing, on every day between the first and last night of all stays. Reservation id =
``'R'`` + order key, the literal ``'NULL'`` on open nights. Price (every night has one) = the smallest order total of
the customer / 1000, as text; for customers with an urgent order it swings with the day by up to a fifth. Minimum
nights = 1 + the customer's pending orders, maximum nights = 2 + the others.

amenities_changelog: one change per stay, on its first night; amenities = JSON
array of the names that the items' return flags, line statuses and quantities stand for.

listings, from ``customer`` + ``nation`` + ``region`` + ``orders``: id = ``c_custkey`` + ``UNIT_STRIDE`` * number of the customer's
listing; a customer without open orders (``o_orderstatus = 'O'``) has no listings rows: deleted listings. A host holds up to five neighbouring customers by
nation, so hosts grow with customers, and host attributes repeated on each listing can disagree. Review dates run
through the years before the season in step with the first and last order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayflow.sources.tables import read_table

# Fixed binding parameters (stated again in the SQL oracle).
SEASON_START = "2024-01-01"
SEASON_DAYS = 121
REVIEWS_START, ORDERS_START = "2022-01-01", "1995-01-01"
PRIVATE_ROOM_BALANCE = 1000
UNIT_STAYS, UNIT_STRIDE = 16, 10_000_000_000
AMENITIES = ("click", "error", "purchase", "signup", "view")
# a stay stands for about 20 nights of the calendar
STAYS_PER_TASK = 30_000


def _dealt_by(order_id: Column) -> Column:
    """28 bits of the key's md5: keys that share a factor with the number of listings are dealt as evenly as any."""
    return F.conv(F.substring(F.md5(order_id.cast("string")), 1, 7), 16, 10).cast("long")


def order_days(spark: SparkSession, sf_dir: str, kept: Callable[[DataFrame], DataFrame] = lambda df: df,
               deal: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """One row per order with items: its listing, first night, number of nights and amenity names. The orders with their items are read twice
    (their number per customer, then themselves); ``kept`` may keep them in between. The names travel as one bit each. ``deal`` may deal them
    out by listing in parts of its own; the queues and all rows given back then lie so."""
    items = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_returnflag", "l_linestatus", "l_quantity"])
    bit = {name: 1 << i for i, name in enumerate(AMENITIES)}
    amenity = (F.when(F.col("l_quantity") >= 46, bit["error"]).when(F.col("l_returnflag") == "R", bit["click"])
               .when(F.col("l_returnflag") == "A", bit["view"]).when(F.col("l_linestatus") == "O", bit["signup"]).otherwise(bit["purchase"]))
    per_order = items.groupBy("l_orderkey").agg(F.count(F.lit(1)).cast("int").alias("n_items"), F.bit_or(amenity).alias("bits"))
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"]).select(
        "o_custkey", F.col("o_orderkey").alias("order_id"), ((F.dayofyear("o_orderdate") - 1) % SEASON_DAYS).alias("wish"))
    wished = kept(orders.join(per_order, F.col("order_id") == F.col("l_orderkey")).drop("l_orderkey"))
    units = wished.groupBy(F.col("o_custkey").alias("_cust")).agg(F.ceil(F.count(F.lit(1)) / UNIT_STAYS).alias("units"))
    dealt = wished.join(units, F.col("o_custkey") == F.col("_cust")).withColumn(
        "listing_id", (F.col("o_custkey") + F.lit(UNIT_STRIDE) * (_dealt_by(F.col("order_id")) % F.col("units"))).cast("long"))
    # stay i begins at max over j <= i of (wish of j + nights of j .. i - 1): a running sum of nights and a running maximum.
    # The window holds the stays of one listing.
    queue = Window.partitionBy("listing_id").orderBy("wish", "order_id")
    before = F.sum("n_items").over(queue.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_items")
    begun = deal(dealt).withColumn("before", before).withColumn(
        "begin", F.max(F.col("wish") - F.col("before")).over(queue.rowsBetween(Window.unboundedPreceding, 0)) + F.col("before"))
    names = F.array_compact(F.array(*(F.when(F.col("bits").bitwiseAND(b) != 0, name) for name, b in bit.items())))
    return begun.select("listing_id", "order_id", F.date_add(F.lit(SEASON_START).cast("date"), F.col("begin").cast("int")).alias("date"), "n_items", names.alias("names"))


def listing_owners(days: DataFrame, facts: DataFrame) -> DataFrame:
    """Every listing with the figures of its customer; a customer whose orders have no items has one listing."""
    named = days.select("listing_id").union(facts.select(F.col("o_custkey").cast("long"))).distinct()
    return named.join(facts, F.col("listing_id") % UNIT_STRIDE == F.col("o_custkey"))


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with orders."""
    orders = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    st = F.col("o_orderstatus")
    return orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(st == "F").alias("n_f"),
        F.count_if(st == "O").alias("n_o"),
        F.count_if(st == "P").alias("n_p"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.floor(F.min("o_totalprice") / 10).cast("long").alias("list_cents"),
        F.to_json(F.sort_array(F.collect_set("o_orderpriority"))).alias("priorities"),
        F.avg(F.substring("o_orderpriority", 1, 1).cast("int")).alias("avg_priority"),
    )


def _money(cents: Column) -> Column:
    return F.concat((cents / 100).cast("long").cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def tasks_of(days: DataFrame) -> int:
    """Tasks that the nights of these stays are made in: what is shuffled are stays, so the number follows them, not the bytes shuffled.
    With fewer than the session's shuffle partitions, Spark would deal the nights out again for a join."""
    return max(int(days.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-days.count() // STAYS_PER_TASK))


def calendar_listings(days: DataFrame, facts: DataFrame) -> DataFrame:
    """The listings that ``raw_calendar`` names, without its nights: every listing has the nights of the season, if there is a stay at all."""
    begun = days.select(F.count("date") > 0).scalar()
    return listing_owners(days, facts).where(begun).select("listing_id")


def raw_calendar(days: DataFrame, facts: DataFrame, tasks: int | None = None, dealt: bool = False) -> DataFrame:
    """``dealt``: the stays already lie by listing in ``tasks`` parts. Else stays are dealt out by listing, and nights are made where they are: each stay gives its own nights and the open ones between the end
    of the stay before it and its own begin, the last one also those after it. So no night is shuffled, and whatever groups, joins or
    orders nights by listing after this finds a listing's nights in one task."""
    tasks = tasks or tasks_of(days)
    ends = days.select(F.struct(F.min("date").alias("lo"), F.max(F.date_add("date", F.col("n_items") - 1)).alias("hi"))).scalar()
    lo, hi = ends.getField("lo"), ends.getField("hi")
    listing = listing_owners(days, facts).repartition(tasks, "listing_id")
    stays = days.where("date IS NOT NULL").select("listing_id", F.col("order_id").alias("stay"), F.col("date").alias("begin"), "n_items")
    stays = stays if dealt else stays.repartition(tasks, "listing_id")
    queue = Window.partitionBy("listing_id").orderBy("begin")  # the stays of one listing never meet; a listing without stays has one row
    free = F.date_add("begin", F.col("n_items"))
    both = listing.join(stays, "listing_id", "left").withColumn("free_from", F.coalesce(F.lag(free).over(queue), lo)).withColumn(
        "is_last", F.lead("begin").over(queue).isNull())
    stretch = lambda order, first, last: F.struct(order.alias("order_id"), first.alias("first"), last.alias("last"))
    nobody = F.lit(None).cast(days.schema["order_id"].dataType)
    stretches = F.array(stretch(nobody, F.col("free_from"), F.coalesce(F.date_sub("begin", 1), hi)), stretch(F.col("stay"), F.col("begin"), F.date_sub(free, 1)),
                        stretch(nobody, F.when(F.col("is_last"), free), hi))
    cal = both.withColumn("stretch", F.explode(stretches)).where("stretch.first <= stretch.last").withColumn(
        "order_id", F.col("stretch.order_id")).withColumn("date", F.explode(F.sequence("stretch.first", "stretch.last")))
    day = F.date_diff("date", F.lit(SEASON_START).cast("date")).cast("long")
    swing = F.when(F.col("n_urgent") > 0, (F.col("listing_id") * 31 + day * 17) % 41 - 20).otherwise(F.lit(0))
    cents = F.floor(F.col("list_cents") * (swing + 100) / 100).cast("long")
    return cal.select(
        "listing_id",
        "date",
        F.col("order_id").isNull().alias("available"),
        F.coalesce(F.concat(F.lit("R"), F.col("order_id").cast("string")), F.lit("NULL")).alias("reservation_id"),
        _money(cents).alias("price"),
        (F.col("n_p") + 1).cast("int").alias("minimum_nights"),
        (F.col("n_f") + F.col("n_o") + 2).cast("int").alias("maximum_nights"),
    )


def raw_amenities_changelog(days: DataFrame) -> DataFrame:
    return days.select("listing_id", F.col("date").cast("timestamp_ntz").alias("change_at"), F.to_json(F.array_sort("names")).alias("amenities"))


def raw_listings(spark: SparkSession, sf_dir: str, days: DataFrame, facts: DataFrame) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    c = (
        cust.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(listing_owners(days, facts).where("n_o > 0"), F.col("c_custkey") == F.col("o_custkey"))
    )
    host_id = (F.floor(F.col("c_custkey") / (F.col("c_nationkey") % 5 + 1)) + 10).cast("long")
    review = lambda ts: F.date_add(
        F.lit(REVIEWS_START).cast("date"), F.floor(F.date_diff(F.col(ts), F.lit(ORDERS_START).cast("date")) / 3).cast("int")).cast("string")
    return c.select(
        F.col("listing_id").alias("id"),
        F.col("c_name").alias("name"),
        host_id.alias("host_id"),
        F.concat(F.lit("Host #"), host_id.cast("string")).alias("host_name"),
        F.to_date("first_order").alias("host_since"),
        F.col("n_name").alias("host_location"),
        F.col("priorities").alias("host_verifications"),
        F.col("r_name").alias("neighborhood"),
        F.col("c_mktsegment").alias("property_type"),
        F.when(F.col("c_acctbal") < PRIVATE_ROOM_BALANCE, F.lit("Private room"))
        .otherwise(F.lit("Entire home/apt")).alias("room_type"),
        F.col("n_orders").cast("int").alias("accommodates"),
        F.when(F.col("n_f") == 0, F.lit("Half-bath"))
        .otherwise(F.concat(F.col("n_f").cast("string"),
                            F.when(F.col("c_acctbal") < 0, F.lit(" shared baths")).otherwise(F.lit(" baths"))))
        .alias("bathrooms_text"),
        F.col("n_o").cast("int").alias("bedrooms"),
        F.col("n_p").cast("int").alias("beds"),
        F.lit(None).cast("string").alias("amenities"),
        F.concat(F.lit("$"), _money(F.col("list_cents"))).alias("price"),
        F.col("n_f").cast("int").alias("number_of_reviews"),
        F.when(F.col("n_f") == 0, F.lit("")).otherwise(review("first_order")).alias("first_review"),
        F.when(F.col("n_f") == 0, F.lit("")).otherwise(review("last_order")).alias("last_review"),
        (F.lit(6.0) - F.col("avg_priority")).alias("review_scores_rating"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    days, facts = order_days(spark, sf_dir), order_facts(spark, sf_dir)
    return {
        "listings": raw_listings(spark, sf_dir, days, facts),
        "calendar": raw_calendar(days, facts),
        "amenities_changelog": raw_amenities_changelog(days),
    }
