"""A second metric model, over the driver's order tables, to run the metric
layer on the largest table with multi-hop paths:

    line -> orders -> customer -> cnation        (three hops)
    line -> supplier -> snation -> sregion       (three hops)

The measure table is ``lineitem`` deduplicated on (order, line number) with a
surrogate key, because a measure table's key must be unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.functions.ratios import avg_exact, round_half_up
from stayflow.functions.text import surrogate_key
from stayflow.operators.dedupe import dedupe
from stayflow.plans.oracle import _norm
from stayflow.plans.questions import finalize
from stayflow.plans.semantic import Model, Relationship, Table
from stayflow.sources.tables import read_table


def sales_model(spark: SparkSession, sf_dir: str) -> Model:
    def lines():
        li = read_table(spark, sf_dir, "lineitem")
        return dedupe(li, ["l_orderkey", "l_linenumber"]).withColumn(
            "line_key", surrogate_key("l_orderkey", "l_linenumber"))

    def nation():
        return read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])

    line = Table("line", lines, "line_key", derived={
        "revenue": lambda c: c("l_extendedprice").cast("decimal(12,2)") * (F.lit(1) - c("l_discount").cast("decimal(4,2)")),
        "ship_year": lambda c: F.year(c("l_shipdate")),
    })
    orders = Table("orders", lambda: read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"]),
                   "o_orderkey")
    customer = Table("customer", lambda: read_table(spark, sf_dir, "customer",
                                                    ["c_custkey", "c_nationkey", "c_mktsegment"]), "c_custkey")
    supplier = Table("supplier", lambda: read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"]),
                     "s_suppkey")
    tables = {
        "line": line, "orders": orders, "customer": customer, "supplier": supplier,
        "cnation": Table("cnation", nation, "n_nationkey"),
        "snation": Table("snation", nation, "n_nationkey"),
        "sregion": Table("sregion", lambda: read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"]),
                         "r_regionkey"),
    }
    rels = [
        Relationship("line", "l_orderkey", "orders", "o_orderkey"),
        Relationship("orders", "o_custkey", "customer", "c_custkey"),
        Relationship("customer", "c_nationkey", "cnation", "n_nationkey"),
        Relationship("line", "l_suppkey", "supplier", "s_suppkey"),
        Relationship("supplier", "s_nationkey", "snation", "n_nationkey"),
        Relationship("snation", "n_regionkey", "sregion", "r_regionkey"),
    ]
    dims = {
        "line.l_returnflag": "l_returnflag", "line.l_linestatus": "l_linestatus", "line.ship_year": "ship_year",
        "orders.o_orderpriority": "o_orderpriority", "customer.c_mktsegment": "c_mktsegment",
        "cnation.customer_nation": "n_name", "snation.supplier_nation": "n_name", "sregion.supplier_region": "r_name",
    }
    facts = {"line.revenue": "revenue", "line.l_quantity": "l_quantity"}
    metrics = {
        "line.total_revenue": lambda c: F.sum(c("revenue")),
        "line.lines": lambda c: F.count(F.lit(1)),
        "line.orders": lambda c: F.count_distinct(c("l_orderkey")),
        "line.avg_quantity": lambda c: avg_exact(c("l_quantity").cast("decimal(12,2)")),
        "line.max_discount": lambda c: F.max(c("l_discount")),
    }
    return Model("sales", "line", tables, rels, facts, dims, metrics)


def sales_by_nation_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned-line revenue by customer nation and market segment (three hops)."""
    m = sales_model(spark, sf_dir)
    q = m.query(["line.total_revenue", "line.lines", "line.orders", "line.avg_quantity"],
                ["cnation.customer_nation", "customer.c_mktsegment"],
                where=lambda c: c("line.l_returnflag") == "R")
    return finalize(q)


def sales_by_supplier_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by supplier region and ship year, with each region's share of the year."""
    m = sales_model(spark, sf_dir)
    q = m.query(["line.total_revenue", "line.lines", "line.max_discount"],
                ["sregion.supplier_region", "line.ship_year"])
    from stayflow.operators.ranking import share_of_partition

    shared = share_of_partition(q, "total_revenue", ["ship_year"], "share", method="window")
    return finalize(shared.withColumn("pct_of_year", round_half_up(F.lit(100) * F.col("share"), 2)).drop("share"))


SPARK = {f.__name__: f for f in (sales_by_nation_segment, sales_by_supplier_region)}

_LINES = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
    l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST,
    l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST,
    l_shipdate NULLS FIRST) AS rn FROM lineitem) WHERE rn = 1)"""
_REV = "CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))"

ORACLE = {
    "sales_by_nation_segment": _norm(f"""SELECT n.n_name AS customer_nation, c.c_mktsegment, sum({_REV}) AS total_revenue,
          count(*) AS lines, count(DISTINCT l.l_orderkey) AS orders,
          CAST(sum(CAST(l.l_quantity AS DECIMAL(12,2))) AS DOUBLE) / nullif(count(l.l_quantity), 0) AS avg_quantity
        FROM {_LINES} l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        WHERE l.l_returnflag = 'R' GROUP BY ALL""",
        {"customer_nation": "o", "c_mktsegment": "o", "total_revenue": "r", "lines": "i", "orders": "i",
         "avg_quantity": "r"}),
    "sales_by_supplier_region": _norm(f"""SELECT supplier_region, ship_year, total_revenue, lines, max_discount,
          round(100 * CAST(total_revenue AS DOUBLE) / nullif(CAST(sum(total_revenue) OVER (PARTITION BY ship_year) AS DOUBLE), 0), 2)
            AS pct_of_year
        FROM (SELECT r.r_name AS supplier_region, year(l.l_shipdate) AS ship_year, sum({_REV}) AS total_revenue,
                count(*) AS lines, max(l.l_discount) AS max_discount
              FROM {_LINES} l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
              JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY ALL)""",
        {"supplier_region": "o", "ship_year": "i", "total_revenue": "r", "lines": "i", "max_discount": "r",
         "pct_of_year": "r"}),
}
