"""Fused key checks against one check at a time."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stayflow.operators.entity import orphans
from stayflow.operators.keys import ORPHAN_KEYS, ORPHAN_ROWS, UNIQUE, KeyCheck, check_keys
from stayflow.plans import quality
from stayflow.plans.warehouse import Warehouse


def test_checks_match_one_at_a_time(spark):
    rng = random.Random(3)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(9))
    child = spark.createDataFrame(
        [(rng.choice([None, *range(30)]), rng.choice(["a", "b", "", "1:a", None]), rng.choice(["", "a", "1:a-"]), day(), dt.datetime(2024, 1, 1, rng.randrange(4)), rng.random() < 0.5)
         for _ in range(900)] + [(7, "a", "a", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), True)] * 500, "k int, s string, s2 string, d date, at timestamp, b boolean")
    parent = spark.createDataFrame([(i, f"p{i}") for i in range(0, 25, 2)] + [(None, "none"), (4, "twice")], "id long, s string")
    columns = [("k",), ("s", "s2"), ("k", "d"), ("k", "d", "at"), ("at", "b", "k", "d", "s")]
    checks = [KeyCheck(f"u{i}", UNIQUE, "child", c) for i, c in enumerate(columns)]
    checks += [KeyCheck("rows", ORPHAN_ROWS, "child", ("k",), "parent", ("id",)), KeyCheck("keys", ORPHAN_KEYS, "child", ("k",), "parent", ("id",)),
               KeyCheck("back", ORPHAN_ROWS, "parent", ("id",), "child", ("k",)), KeyCheck("text", ORPHAN_KEYS, "child", ("s",), "parent", ("s",)),
               KeyCheck("id", UNIQUE, "parent", ("id",)), KeyCheck("empty", ORPHAN_ROWS, "child", ("k",), "nothing", ("id",))]
    want = {f"u{i}": child.groupBy(*c).count().where("count > 1").count() for i, c in enumerate(columns)}
    want |= {"rows": orphans(child, parent, "k", "id").count(), "keys": orphans(child, parent, "k", "id").select("k").distinct().count(),
             "back": orphans(parent, child, "id", "k").count(), "text": orphans(child, parent, "s").select("s").distinct().count(), "id": 1,
             "empty": child.where("k IS NOT NULL").count()}
    out = check_keys({"child": child, "parent": parent, "nothing": parent.limit(0)}, checks)
    assert {r.check_name: r.failing_rows for r in out.collect()} == want
    none = check_keys({"child": child.limit(0), "parent": parent.limit(0), "nothing": parent.limit(0)}, checks)
    assert {r.failing_rows for r in none.collect()} == {0}


def test_one_shuffle_for_all_keys_of_the_suite(spark):
    wh = Warehouse.for_dir(spark, "/root/testdata/sf0.001")
    keyed = [c for c in quality.checks(wh) if c.key is not None]
    assert len(keyed) == 21
    names = {n for c in keyed for n in (c.key.child, c.key.parent) if n}
    out = check_keys({n: quality._relation(wh, n) for n in names}, [c.key for c in keyed])
    plan = out._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if " Exchange hashpartitioning(c#" in line and "a#" in line]
    assert len(shuffles) == 1
    for c in keyed:  # the fused count is the number of failing rows that the check itself lists
        listed = c.rows(wh).count()
        assert out.where(F.col("check_name") == c.name).first().failing_rows == listed, c.name


def test_blocks_are_one_query(spark):
    wh = Warehouse.for_dir(spark, "/root/testdata/sf0.001")
    names = ["q01_full_year", "q05_count", "q17_summary"]
    out = quality.blocks_return_rows(wh, names)
    assert sorted(r.block for r in out.collect()) == names
    assert out._jdf.queryExecution().executedPlan().toString().count("Subquery") >= 3
    from stayflow.plans import questions

    questions.QUESTIONS["q05_again"] = questions.QUESTIONS["q05_count"]
    try:
        blocks = quality.distinct_blocks(wh, [*names, "q05_again"])
        assert sorted(blocks) == ["q01_full_year", "q05_again", "q17_summary"] and blocks["q05_again"][1] == ["q05_again", "q05_count"]
    finally:
        del questions.QUESTIONS["q05_again"]


def test_nothing_to_check():
    with pytest.raises(ValueError):
        check_keys({}, [])


def test_keys_made_on_reading_go_by_their_columns(spark):
    wh = Warehouse.for_dir(spark, "/root/testdata/sf0.001")
    keyed = [c.key for c in quality.checks(wh) if c.key is not None and c.key.kind == UNIQUE]
    relations = {n: quality._relation(wh, n) for n in {c.child for c in keyed}}
    made = {n: wh.made_keys(n) for n in relations}
    assert made["fct_listing_daily"] == made["stg_calendar"] == {"calendar_id": ("listing_id", "calendar_date")} and made["dim_hosts"] == {}
    out = check_keys(relations, keyed, made)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "calendar_id" not in plan and "md5(concat_ws(-, cast(listing_id" not in plan.split("stg_amenities")[0].split("reservation_id")[0]
    assert {r.check_name: r.failing_rows for r in out.collect()} == {c.name: 0 for c in keyed}


def test_made_keys_count_as_the_keys_themselves(spark):
    from stayflow.functions.text import surrogate_key

    rng = random.Random(5)
    rows = [(rng.choice([None, *range(-12, 12)]), rng.choice([None, dt.date(2024, 1, 1 + rng.randrange(9))])) for _ in range(400)]
    df = spark.createDataFrame(rows, "k long, d date").withColumn("id", surrogate_key("k", "d")).withColumn("s", F.col("d").cast("string")).withColumn("id2", surrogate_key("k", "s"))
    checks = [KeyCheck("by_key", UNIQUE, "t", ("id",)), KeyCheck("by_text", UNIQUE, "t", ("id2",)), KeyCheck("grain", UNIQUE, "t", ("k", "d"))]
    want = df.groupBy("id").count().where("count > 1").count()
    got = check_keys({"t": df}, checks, {"t": {"id": ("k", "d"), "id2": ("k", "s")}})
    assert {r.check_name: r.failing_rows for r in got.collect()} == {"by_key": want, "by_text": want, "grain": want} and want > 0
