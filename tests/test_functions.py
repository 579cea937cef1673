import datetime as dt
import hashlib
from decimal import Decimal

import pytest

from stayflow.functions import (
    avg_exact, band, contains_ci, day_name, div0, flag_name, flag_names, is_weekend, leading_number,
    least_strict, mask_pii, money_to_decimal, months_between_boundaries, round_half_up, safe_div,
    sentinel_to_null, surrogate_key, weekday_order, years_between_boundaries,
)


def one(spark, col, schema="x string", value=None):
    return spark.createDataFrame([(value,)], schema).select(col.alias("out")).first()["out"]


def test_surrogate_key_matches_md5_of_joined_text(spark):
    df = spark.createDataFrame([(7, dt.date(2021, 7, 12)), (None, dt.date(2021, 7, 12))], "a long, d date")
    got = [r[0] for r in df.select(surrogate_key("a", "d")).collect()]
    assert got[0] == hashlib.md5(b"7-2021-07-12").hexdigest()
    assert got[1] == hashlib.md5(b"_dbt_utils_surrogate_key_null_-2021-07-12").hexdigest()


def test_mask_pii_is_salted_truncated_and_null_preserving(spark):
    df = spark.createDataFrame([("Maria",), (None,)], "n string")
    got = [r[0] for r in df.select(mask_pii("n", "pepper")).collect()]
    assert got[0] == hashlib.sha256(b"pepperMaria").hexdigest()[:16]
    assert got[1] is None


@pytest.mark.parametrize("text,expected", [
    ("$1,234.50", Decimal("1234.50")), ("$85.00", Decimal("85.00")), ("abc", None), (None, None),
])
def test_money_to_decimal(spark, text, expected):
    assert one(spark, money_to_decimal("x"), value=text) == expected


@pytest.mark.parametrize("text,expected", [
    ("2.5 baths", Decimal("2.5")), ("1 shared bath", Decimal("1.0")), ("Half-bath", None), (None, None),
    ("  3 baths ", Decimal("3.0")),
])
def test_leading_number(spark, text, expected):
    assert one(spark, leading_number("x"), value=text) == expected


@pytest.mark.parametrize("text,expected", [("1 Shared bath", True), ("2 baths", False), (None, None)])
def test_contains_ci(spark, text, expected):
    assert one(spark, contains_ci("x", "shared"), value=text) == expected


def test_sentinel_to_null(spark):
    df = spark.createDataFrame([("NULL",), ("R1",), (None,)], "x string")
    assert [r[0] for r in df.select(sentinel_to_null("x")).collect()] == [None, "R1", None]


def test_flag_names_examples_and_collisions():
    assert flag_name("has_", "Air conditioning") == "has_air_conditioning"
    assert flag_name("has_", "Children’s books") == "has_children_s_books"
    assert flag_name("has_", "Pack ’n Play/travel crib") == "has_pack_n_play_travel_crib"
    assert flag_name("has_", "65 inch HDTV, with Netflix") == "has_65_inch_hdtv_with_netflix"
    assert flag_name("is_verified_", "government_id") == "is_verified_government_id"
    with pytest.raises(ValueError):
        flag_names("is_verified_", ["email", "Email"])


def test_boundary_date_differences(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 31), dt.date(2021, 2, 1)), (dt.date(2008, 12, 31), dt.date(2022, 1, 1))],
                               "a date, b date")
    got = df.select(months_between_boundaries("a", "b"), years_between_boundaries("a", "b")).collect()
    assert tuple(got[0]) == (1, 0)
    assert tuple(got[1]) == (13 * 12 + 1, 14)


def test_weekday_helpers(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),)], "d date")
    got = [tuple(r) for r in df.select(day_name("d"), is_weekend("d"), weekday_order("d")).collect()]
    assert got == [("Sat", True, 6), ("Sun", True, 7), ("Mon", False, 1)]


def test_div0_safe_div_least_strict(spark):
    df = spark.createDataFrame([(4, 2), (4, 0), (None, 0), (3, None)], "a int, b int")
    got = [tuple(r) for r in df.select(div0("a", "b"), safe_div("a", "b"), least_strict("a", "b")).collect()]
    assert got == [(2.0, 2.0, 2), (0.0, None, 0), (None, None, None), (None, None, None)]


def test_band_null_handling(spark):
    bounds = [(75, "1. under 75"), (150, "2. 75 to 149")]
    df = spark.createDataFrame([(10.0,), (75.0,), (500.0,), (None,)], "p double")
    plain = [r[0] for r in df.select(band("p", bounds, "3. top")).collect()]
    labelled = [r[0] for r in df.select(band("p", bounds, "3. top", null_label="0. none")).collect()]
    inclusive = [r[0] for r in df.select(band("p", bounds, "3. top", inclusive=True)).collect()]
    assert plain == ["1. under 75", "2. 75 to 149", "3. top", "3. top"]  # NULL falls through like SQL CASE
    assert labelled[-1] == "0. none"
    assert inclusive[1] == "1. under 75"


def test_round_half_up_resolves_exact_ties(spark):
    df = spark.createDataFrame([(10.015,), (108.61875,), (2.5,)], "x double")
    got = [tuple(r) for r in df.select(round_half_up("x", 2), round_half_up("x", 4), round_half_up("x", 0)).collect()]
    assert got[0][0] == 10.02 and got[1][1] == 108.6188 and got[2][2] == 3.0


def test_round_half_up_passes_nan_and_infinity_through(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.005,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert got[0] != got[0] and got[1] == float("inf") and got[2] == 1.01


def test_avg_exact_divides_the_exact_sum(spark):
    df = spark.createDataFrame([(Decimal("0.10"),), (Decimal("0.20"),), (None,)], "x decimal(10,2)")
    assert df.select(avg_exact("x")).first()[0] == pytest.approx(0.15)
    empty = spark.createDataFrame([(None,)], "x decimal(10,2)")
    assert empty.select(avg_exact("x")).first()[0] is None


def test_cluster_settings_scale_with_volume():
    from stayflow.session import cluster_settings

    tb = 1024 ** 4
    big = cluster_settings(100 * tb, executors=1000, cores_per_executor=8)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600          # 100 TiB / 256 MiB
    small = cluster_settings(10 * 1024 ** 2, executors=2, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 16              # two waves of 8 slots
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
