"""One-pass profile of the columns of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, n_rows, n_null, n_distinct, min_value, max_value), one row per column.

    The columns are stacked as (name, value as text) and grouped: values are counted per (name,
    value) first, so a value that most rows hold is one row after the map side, and distinct
    counts are exact.  Minimum and maximum compare text.  The table is read once; an empty one
    gives no rows; values that are not text, numbers, dates or booleans must be cast before.
    """
    columns = columns or df.columns
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value"))
                                for c in columns]))
    values = df.select(pairs.alias("p")).select("p.*").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
        F.count("value").alias("n_distinct"), F.min("value").alias("min_value"), F.max("value").alias("max_value"))
