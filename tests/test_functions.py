"""Column helpers: boundary differences, zones, predicates (hand-written rows)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from closetops.functions import (any_in, elapsed_days, epoch_to_ntz, exclude_prefix_digits,
                                 hour_boundaries, month_boundaries, shift_zone, to_eastern, week_start)
from closetops.plans.leakage import _between_dates


def _one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]


def test_hour_boundaries(spark):
    s = "a timestamp_ntz, b timestamp_ntz"
    assert _one(spark, hour_boundaries("a", "b"), s, (dt.datetime(2024, 1, 1, 1, 59), dt.datetime(2024, 1, 1, 2, 1))) == 1
    assert _one(spark, hour_boundaries("a", "b"), s, (dt.datetime(2024, 1, 1, 23, 0), dt.datetime(2024, 1, 3, 0, 30))) == 25
    assert _one(spark, hour_boundaries("a", "b"), s, (dt.datetime(2024, 1, 1, 1, 0), dt.datetime(2024, 1, 1, 1, 59))) == 0


def test_month_boundaries(spark):
    s = "a date, b date"
    assert _one(spark, month_boundaries("a", "b"), s, (dt.date(2024, 1, 31), dt.date(2024, 2, 1))) == 1
    assert _one(spark, month_boundaries("a", "b"), s, (dt.date(2023, 12, 1), dt.date(2024, 2, 29))) == 2


def test_elapsed_days(spark):
    s = "a timestamp_ntz, b timestamp_ntz"
    assert _one(spark, elapsed_days("b", "a"), s, (dt.datetime(2024, 1, 1, 2), dt.datetime(2024, 1, 5, 1))) == 3


def test_zone_shift_winter_and_summer(spark):
    s = "t timestamp_ntz"
    assert _one(spark, shift_zone("t", "America/Chicago", "UTC"), s, (dt.datetime(2024, 1, 15, 10),)) == dt.datetime(2024, 1, 15, 16)
    assert _one(spark, shift_zone("t", "America/Chicago", "UTC"), s, (dt.datetime(2024, 7, 15, 10),)) == dt.datetime(2024, 7, 15, 15)
    assert _one(spark, to_eastern("t"), s, (dt.datetime(2024, 7, 15, 10),)) == dt.datetime(2024, 7, 15, 6)


def test_epoch_to_ntz(spark):
    assert _one(spark, epoch_to_ntz("e"), "e bigint", (86400 * 2 + 3661,)) == dt.datetime(1970, 1, 3, 1, 1, 1)


def test_week_start_monday(spark):
    s = "d date"
    assert _one(spark, week_start("d"), s, (dt.date(2024, 1, 10),)) == dt.date(2024, 1, 8)
    assert _one(spark, week_start("d"), s, (dt.date(2024, 1, 7),)) == dt.date(2024, 1, 1)
    assert _one(spark, week_start("d"), s, (dt.date(2024, 1, 8),)) == dt.date(2024, 1, 8)


def test_between_dates_drops_last_day_daytime(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 2, 25, 0, 0, 0),), (dt.datetime(2017, 2, 25, 0, 0, 1),)],
                               "t timestamp_ntz")
    kept = df.filter(_between_dates(F.col("t"), "2017-01-29", "2017-02-25")).count()
    assert kept == 1


def test_prefix_exclusion_and_nulls(spark):
    df = spark.createDataFrame([("SS12",), ("XX8_ONE SIZE",), ("SSX",), ("P5_3",), (None,)], "sku string")
    kept = sorted(r.sku for r in df.filter(exclude_prefix_digits("sku")).collect())
    assert kept == ["P5_3", "SSX"]


def test_any_in_null_safe(spark):
    df = spark.createDataFrame([("ITEM_LIMBO", None), (None, None), ("X", "PROBLEM_ITEM")], "a string, b string")
    got = [r.v for r in df.select(any_in(["a", "b"], ["ITEM_LIMBO", "PROBLEM_ITEM"]).alias("v")).collect()]
    assert got == [True, False, True]


def test_decimal_cast_rounds_half_up(spark):
    df = spark.createDataFrame([(Decimal("1.2250"),), (Decimal("-1.2250"),)], "x decimal(20,4)")
    got = [r.v for r in df.select(F.col("x").cast("decimal(9,2)").alias("v")).collect()]
    assert got == [Decimal("1.23"), Decimal("-1.23")]
