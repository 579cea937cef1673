"""Operator-level queries on the driver's TPC-H-style tables.

The business questions exercise the operators on the rental build; these run
the same operators directly over the larger tables (lineitem, orders,
customer, supplier, events) so each one is checked at the data's full size.
``SPARK`` maps names to ``(spark, sf_dir) -> DataFrame``; ``ORACLE`` holds the
independent DuckDB SQL for the same names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.functions.dates import (
    day_name, is_weekend, months_between_boundaries, weekday_order, years_between_boundaries,
)
from stayflow.functions.ratios import avg_exact, band, round_half_up
from stayflow.functions.text import (
    SURROGATE_NULL_MARKER, contains_ci, leading_number, mask_pii, money_to_decimal, sentinel_to_null, surrogate_key,
)
from stayflow.operators.dedupe import dedupe, latest_per_key
from stayflow.operators.entity import entity_universe, reconstruct_entity
from stayflow.operators.flatten import flatten_json_array
from stayflow.operators.ranking import rank_with_running_share, share_of_partition, top_k_share
from stayflow.operators.spans import censor_flags, events_to_spans
from stayflow.operators.union import flag_branches
from stayflow.operators.vocab import vocabulary_pivot
from stayflow.plans.build import BuildConfig
from stayflow.plans.oracle import _norm
from stayflow.plans.questions import finalize
from stayflow.sources.tables import read_table

SALT = BuildConfig().pii_salt
EVENT_TYPES = BuildConfig().amenities
STALENESS_BANDS = [(3, "1. within 3 months"), (12, "2. 4 to 12 months"), (36, "3. 1 to 3 years")]


def _revenue() -> F.Column:
    """Exact line revenue: extended price x (1 - discount) in decimal."""
    return F.col("l_extendedprice").cast("decimal(12,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))


def lineitem_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    one = dedupe(li, ["l_orderkey", "l_linenumber"])
    return one.withColumn("line_key", surrogate_key("l_orderkey", "l_linenumber"))


def customer_text_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    text = F.concat(F.lit("$"), F.format_number("c_acctbal", 2))
    return c.select(
        "c_custkey",
        mask_pii("c_name", SALT).alias("c_name_masked"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).try_cast("bigint").alias("name_number"),
        text.alias("balance_text"),
        money_to_decimal(text, 12, 2).alias("balance_parsed"),
        leading_number(F.concat(F.col("c_nationkey").cast("string"), F.lit(" nations")), 4, 1).alias("nation_number"),
        contains_ci("c_mktsegment", "HOLD").alias("is_household"),
        sentinel_to_null("c_mktsegment", "BUILDING").alias("segment_or_null"),
    )


def events_latest_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return latest_per_key(ev, ["user_id"], ["ts"], ["event_id"])


def events_type_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["user_id", "event_type"])
    arrays = ev.groupBy("user_id").agg(F.to_json(F.sort_array(F.collect_set("event_type"))).alias("types_json"))
    bridge = flatten_json_array(arrays, "types_json", ["user_id"], "event_type")
    return vocabulary_pivot(bridge, "user_id", "event_type", EVENT_TYPES, "did_", count_col="type_count",
                            list_col="type_list")


def lineitem_month_flag_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_shipdate", "l_returnflag", "l_extendedprice", "l_discount"])
    monthly = li.groupBy(F.trunc(F.to_date("l_shipdate"), "month").alias("ship_month"), "l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(_revenue()).alias("revenue"))
    # rows per month are bounded by the return-flag domain: window over the aggregate, one scan
    shared = share_of_partition(monthly, "revenue", ["ship_month"], "share", method="window")
    return shared.withColumn("pct_of_month_revenue", round_half_up(F.lit(100) * F.col("share"), 1)).drop("share")


def _customer_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_extendedprice", "l_discount"])
    od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    per_order = li.groupBy("l_orderkey").agg(F.sum(_revenue()).alias("rev"))
    j = per_order.join(od, F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("rev").alias("revenue"))


def customer_revenue_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rev = _customer_revenue(spark, sf_dir)
    ranked = rank_with_running_share(rev, "revenue", ["c_custkey"], rank_col="revenue_rank", running_col="running",
                                     total_col="total")
    total = F.col("total")
    return ranked.select(
        "c_custkey", "revenue", "revenue_rank",
        round_half_up(F.lit(100) * F.col("revenue").cast("double") / F.nullif(total, F.lit(0)).cast("double"), 4)
        .alias("pct_of_total"),
        round_half_up(F.lit(100) * F.col("running").cast("double") / F.nullif(total, F.lit(0)).cast("double"), 4)
        .alias("running_pct_of_total"),
    )


def customer_top5_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    rev = _customer_revenue(spark, sf_dir)
    s = top_k_share(rev, "revenue", 5, ["c_custkey"], count_col="customers", total_col="total_revenue",
                    top_col="top_5_revenue", pct_col="top_5_pct")
    return s.withColumn("top_5_pct", round_half_up(F.col("top_5_pct").cast("double"), 2))


def customer_order_staleness(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey"])
    od = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate", "o_orderpriority"])
    as_of = od.select(F.max(F.to_date("o_orderdate"))).scalar()
    urgent = od.filter(F.col("o_orderpriority") == "1-URGENT").groupBy("o_custkey").agg(
        F.max(F.to_date("o_orderdate")).alias("last_urgent_date"))
    j = c.join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left")
    months = months_between_boundaries("last_urgent_date", as_of)
    return j.select(
        "c_custkey", "last_urgent_date",
        F.date_diff(as_of, F.col("last_urgent_date")).alias("days_since"),
        months.alias("months_since"),
        years_between_boundaries("last_urgent_date", as_of).alias("years_since"),
        band(months, STALENESS_BANDS, "4. over 3 years", null_label="0. never", inclusive=True).alias("staleness_band"),
    )


def supplier_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as entities rebuilt from their line items: the universe is the
    suppliers lines refer to; a supplier without a listed parent row is deleted.

    Line items are reduced per supplier (partial aggregation, so a supplier with
    a third of all lines is combined map-side) before any join; the joins then
    see one row per supplier on each side."""
    li = read_table(spark, sf_dir, "lineitem", ["l_suppkey", "l_partkey", "l_extendedprice", "l_discount"])
    sup = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    stats = li.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_distinct("l_partkey").alias("parts"),
        F.sum(_revenue()).alias("revenue"),
    )
    # parent attributes rebuilt with min() per key, as a host is rebuilt from its listings
    rebuilt = reconstruct_entity(sup.withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey",
                                 ["s_name", "s_nationkey"])
    universe = entity_universe(stats, "l_suppkey", rebuilt, "l_suppkey", unique=True)
    return universe.select(
        F.col("l_suppkey").alias("s_suppkey"), "s_name", "s_nationkey", "is_deleted", "lines", "parts", "revenue")


def order_ship_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_shipdate", "l_extendedprice", "l_discount"])
    days = li.select("l_orderkey", F.to_date("l_shipdate").alias("ship_date"), _revenue().alias("rev"))
    spans = events_to_spans(days, ["l_orderkey"], "ship_date", [F.sum("rev").alias("revenue")],
                            first_col="first_ship", last_col="last_ship", count_col="lines")
    bounds = spans.select(F.struct(F.min("first_ship").alias("lo"), F.max("last_ship").alias("hi"))).scalar()  # one row per order, not per line
    return censor_flags(spans, bounds.getField("lo"), bounds.getField("hi"), "first_ship", "last_ship")


def lineitem_flag_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_returnflag", "l_linestatus", "l_discount", "l_quantity",
                                                "l_extendedprice"])
    flagged = li.select(
        (F.col("l_returnflag") == "R").alias("is_returned"),
        (F.col("l_linestatus") == "O").alias("is_open"),
        (F.col("l_discount") >= 0.05).alias("is_discounted"),
        (F.col("l_quantity") >= 40).alias("is_bulk"),
        _revenue().alias("rev"),                       # computed once per line
        F.col("l_quantity").cast("decimal(12,2)").alias("qty"),
    )
    return flag_branches(flagged, ["is_returned", "is_open", "is_discounted", "is_bulk"], "flag", {
        "lines": lambda on: F.count(on(F.lit(1))),
        "revenue": lambda on: F.sum(on(F.col("rev"))),
        "avg_quantity": lambda on: avg_exact(on(F.col("qty"))),
    })


def events_weekday_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["ts", "event_type", "value"])
    d = ev.select(F.to_date("ts").alias("d"), "event_type", "value")
    return d.groupBy(day_name("d").alias("day_of_week"), weekday_order("d").alias("weekday_order"),
                     is_weekend("d").alias("is_weekend")).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        avg_exact(F.col("value").cast("decimal(12,2)")).alias("avg_value"),
    )


def _fin(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finalize(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    return run


SPARK = {f.__name__: _fin(f) for f in (
    lineitem_dedupe, customer_text_parsing, events_latest_per_user, events_type_pivot, lineitem_month_flag_share,
    customer_revenue_concentration, customer_top5_share, customer_order_staleness, supplier_portfolio,
    order_ship_spans, lineitem_flag_branches, events_weekday_profile,
)}

# ------------------------------------------------------------------ oracle SQL
R, I, O = "r", "i", "o"
_REV = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"
_NULLMARK = SURROGATE_NULL_MARKER


def _plain(body: str, kinds: dict, ctes: dict | None = None) -> str:
    head = ("WITH " + ",\n".join(f"{n} AS (\n{s}\n)" for n, s in ctes.items()) + "\n") if ctes else ""
    return head + _norm(body, kinds)


_CUST_REV = f"""SELECT o.o_custkey AS c_custkey, sum(p.rev) AS revenue
  FROM (SELECT l_orderkey, sum({_REV}) AS rev FROM lineitem GROUP BY l_orderkey) p
  JOIN orders o ON p.l_orderkey = o.o_orderkey GROUP BY o.o_custkey"""

ORACLE = {
    "lineitem_dedupe": _plain(
        f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
              l_returnflag, l_linestatus, l_shipdate,
              md5(coalesce(CAST(l_orderkey AS VARCHAR), '{_NULLMARK}') || '-' ||
                  coalesce(CAST(l_linenumber AS VARCHAR), '{_NULLMARK}')) AS line_key
            FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
                    l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST,
                    l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST,
                    l_shipdate NULLS FIRST) AS rn FROM lineitem) WHERE rn = 1""",
        {"l_orderkey": I, "l_partkey": I, "l_suppkey": I, "l_linenumber": I, "l_quantity": R, "l_extendedprice": R,
         "l_discount": R, "l_tax": R, "l_returnflag": O, "l_linestatus": O, "l_shipdate": O, "line_key": O}),
    "customer_text_parsing": _plain(
        f"""SELECT c_custkey, left(sha256('{SALT}' || c_name), 16) AS c_name_masked,
              TRY_CAST(split_part(c_name, '#', 2) AS BIGINT) AS name_number,
              '$' || format('{{:,.2f}}', c_acctbal) AS balance_text,
              TRY_CAST(replace(replace('$' || format('{{:,.2f}}', c_acctbal), '$', ''), ',', '') AS DECIMAL(12,2))
                AS balance_parsed,
              TRY_CAST(split_part(trim(CAST(c_nationkey AS VARCHAR) || ' nations'), ' ', 1) AS DECIMAL(4,1))
                AS nation_number,
              contains(lower(c_mktsegment), 'hold') AS is_household,
              nullif(c_mktsegment, 'BUILDING') AS segment_or_null
            FROM customer""",
        {"c_custkey": I, "c_name_masked": O, "name_number": I, "balance_text": O, "balance_parsed": R,
         "nation_number": R, "is_household": O, "segment_or_null": O}),
    "events_latest_per_user": _plain(
        """SELECT event_id, ts, user_id, event_type, value FROM (
             SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST,
               event_type DESC NULLS LAST, value DESC NULLS LAST) AS rn FROM events) WHERE rn = 1""",
        {"event_id": I, "ts": O, "user_id": I, "event_type": O, "value": R}),
    "events_type_pivot": _plain(
        "SELECT user_id, count(DISTINCT event_type) AS type_count, list_sort(list_distinct(list(event_type))) AS type_list, "
        + ", ".join(f"bool_or(event_type = '{t}') AS did_{t}" for t in EVENT_TYPES)
        + """ FROM (SELECT DISTINCT user_id, unnest(from_json(types_json, '["VARCHAR"]')) AS event_type
                FROM (SELECT user_id, CAST(to_json(list_sort(list_distinct(list(event_type)))) AS VARCHAR) AS types_json
                      FROM events GROUP BY user_id)) GROUP BY user_id""",
        {"user_id": I, "type_count": I, "type_list": O, **{f"did_{t}": O for t in EVENT_TYPES}}),
    "lineitem_month_flag_share": _plain(
        """SELECT ship_month, l_returnflag, lines, revenue,
             round(100 * CAST(revenue AS DOUBLE) / nullif(CAST(sum(revenue) OVER (PARTITION BY ship_month) AS DOUBLE), 0), 1)
               AS pct_of_month_revenue FROM monthly""",
        {"ship_month": O, "l_returnflag": O, "lines": I, "revenue": R, "pct_of_month_revenue": R},
        {"monthly": f"""SELECT CAST(date_trunc('month', CAST(l_shipdate AS DATE)) AS DATE) AS ship_month, l_returnflag,
                          count(*) AS lines, sum({_REV}) AS revenue FROM lineitem GROUP BY ALL"""}),
    "customer_revenue_concentration": _plain(
        """SELECT c_custkey, revenue, revenue_rank,
             round(100 * CAST(revenue AS DOUBLE) / nullif(CAST(total AS DOUBLE), 0), 4) AS pct_of_total,
             round(100 * CAST(sum(revenue) OVER (ORDER BY revenue_rank) AS DOUBLE) / nullif(CAST(total AS DOUBLE), 0), 4)
               AS running_pct_of_total
           FROM (SELECT *, row_number() OVER (ORDER BY revenue DESC NULLS LAST, c_custkey) AS revenue_rank,
                        sum(revenue) OVER () AS total FROM cust_rev)""",
        {"c_custkey": I, "revenue": R, "revenue_rank": I, "pct_of_total": R, "running_pct_of_total": R},
        {"cust_rev": _CUST_REV}),
    "customer_top5_share": _plain(
        """SELECT count(*) AS customers, sum(revenue) AS total_revenue,
             sum(CASE WHEN rk <= 5 THEN revenue END) AS top_5_revenue,
             round(100 * CAST(sum(CASE WHEN rk <= 5 THEN revenue END) AS DOUBLE) / nullif(CAST(sum(revenue) AS DOUBLE), 0), 2)
               AS top_5_pct
           FROM (SELECT revenue, row_number() OVER (ORDER BY revenue DESC NULLS LAST, c_custkey) AS rk FROM cust_rev)""",
        {"customers": I, "total_revenue": R, "top_5_revenue": R, "top_5_pct": R}, {"cust_rev": _CUST_REV}),
    "customer_order_staleness": _plain(
        """SELECT c.c_custkey, u.last_urgent_date,
             date_diff('day', u.last_urgent_date, a.as_of) AS days_since,
             (year(a.as_of) - year(u.last_urgent_date)) * 12 + month(a.as_of) - month(u.last_urgent_date) AS months_since,
             year(a.as_of) - year(u.last_urgent_date) AS years_since,
             CASE WHEN u.last_urgent_date IS NULL THEN '0. never'
                  WHEN (year(a.as_of) - year(u.last_urgent_date)) * 12 + month(a.as_of) - month(u.last_urgent_date) <= 3
                    THEN '1. within 3 months'
                  WHEN (year(a.as_of) - year(u.last_urgent_date)) * 12 + month(a.as_of) - month(u.last_urgent_date) <= 12
                    THEN '2. 4 to 12 months'
                  WHEN (year(a.as_of) - year(u.last_urgent_date)) * 12 + month(a.as_of) - month(u.last_urgent_date) <= 36
                    THEN '3. 1 to 3 years'
                  ELSE '4. over 3 years' END AS staleness_band
           FROM customer c
           LEFT JOIN (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS last_urgent_date FROM orders
                      WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey) u ON c.c_custkey = u.o_custkey
           CROSS JOIN (SELECT max(CAST(o_orderdate AS DATE)) AS as_of FROM orders) a""",
        {"c_custkey": I, "last_urgent_date": O, "days_since": I, "months_since": I, "years_since": I,
         "staleness_band": O}),
    "supplier_portfolio": _plain(
        f"""SELECT u.l_suppkey AS s_suppkey, s.s_name, s.s_nationkey, s.s_suppkey IS NULL AS is_deleted,
             st.lines, st.parts, st.revenue
           FROM (SELECT DISTINCT l_suppkey FROM lineitem) u
           LEFT JOIN supplier s ON u.l_suppkey = s.s_suppkey
           JOIN (SELECT l_suppkey, count(*) AS lines, count(DISTINCT l_partkey) AS parts, sum({_REV}) AS revenue
                 FROM lineitem GROUP BY l_suppkey) st ON u.l_suppkey = st.l_suppkey""",
        {"s_suppkey": I, "s_name": O, "s_nationkey": I, "is_deleted": O, "lines": I, "parts": I, "revenue": R}),
    "order_ship_spans": _plain(
        f"""SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) AS first_ship, max(CAST(l_shipdate AS DATE)) AS last_ship,
             count(*) AS lines, sum({_REV}) AS revenue,
             date_diff('day', min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE))) + 1 = count(*) AS is_contiguous,
             min(CAST(l_shipdate AS DATE)) = (SELECT min(CAST(l_shipdate AS DATE)) FROM lineitem) AS is_left_censored,
             max(CAST(l_shipdate AS DATE)) = (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem) AS is_right_censored
           FROM lineitem GROUP BY l_orderkey""",
        {"l_orderkey": I, "first_ship": O, "last_ship": O, "lines": I, "revenue": R, "is_contiguous": O,
         "is_left_censored": O, "is_right_censored": O}),
    "lineitem_flag_branches": _plain(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS flag, count(*) AS lines, sum({_REV}) AS revenue,
                  CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) / nullif(count(l_quantity), 0) AS avg_quantity
                FROM lineitem WHERE {cond}"""
            for name, cond in (("is_returned", "l_returnflag = 'R'"), ("is_open", "l_linestatus = 'O'"),
                               ("is_discounted", "l_discount >= 0.05"), ("is_bulk", "l_quantity >= 40"))),
        {"flag": O, "lines": I, "revenue": R, "avg_quantity": R}),
    "events_weekday_profile": _plain(
        """SELECT strftime(CAST(ts AS DATE), '%a') AS day_of_week, isodow(CAST(ts AS DATE)) AS weekday_order,
             dayofweek(CAST(ts AS DATE)) IN (0, 6) AS is_weekend, count(*) AS events,
             count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
             CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / nullif(count(value), 0) AS avg_value
           FROM events GROUP BY ALL""",
        {"day_of_week": O, "weekday_order": I, "is_weekend": O, "events": I, "purchases": I, "avg_value": R}),
}
