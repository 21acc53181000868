"""Null order values against the plain windows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from closetops.operators.seqlog import row_number_within, shift_within

ROWS = [("a", None, 1), ("a", 5, 2), ("a", 9, 3), ("b", None, 4), (None, 3, 5), (None, None, 6), ("a", 2_000_000, 7)]


@pytest.fixture()
def table(spark):
    return spark.createDataFrame(ROWS, "k string, o long, v int")


def test_row_number_keeps_rows_with_null_order(table):
    got = row_number_within(table, ["k"], ["o"], F.floor(F.col("o") / 4), "n")
    want = table.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("direction", ["lead", "lag"])
def test_shift_links_rows_with_null_order(table, direction):
    got = shift_within(table, ["k"], ["o"], {"x": "v"}, direction, F.floor(F.col("o") / 4))
    want = table.withColumn("x", getattr(F, direction)("v").over(Window.partitionBy("k").orderBy("o")))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
