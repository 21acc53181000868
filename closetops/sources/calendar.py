"""The date dimension (``dates`` in the analyses).

One row per day.  Calendar parts are plain; the fiscal parts follow a retail
4-5-4 year that starts on the Sunday falling in Jan 29 .. Feb 4 (the Sunday on
or before Feb 4).  Weeks run Sunday to Saturday.

The frame is generated from two date parameters, so its size is bounded by
the span (about 15k rows for 1990-2030) and it is safe to broadcast.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_START = "1990-01-01"
DEFAULT_END = "2030-12-31"


def fiscal_year_start(year: Column) -> Column:
    feb4 = F.make_date(year, F.lit(2), F.lit(4))
    return F.date_sub(feb4, F.dayofweek(feb4) - 1)


def calendar(spark: SparkSession, start: str = DEFAULT_START, end: str = DEFAULT_END) -> DataFrame:
    n_days = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1
    d = F.col("asofdate")
    y = F.year(d)
    fy = F.when(d >= fiscal_year_start(y), y).otherwise(y - 1)
    days = spark.range(n_days).select(
        F.date_add(F.lit(dt.date.fromisoformat(start)), F.col("id").cast("int")).alias("asofdate"))
    wk0 = F.floor(F.datediff(d, F.col("fy_start")) / 7).cast("int")
    q = F.least(F.floor(F.col("wk0") / 13).cast("int"), F.lit(3))
    wq = F.col("wk0") - F.col("q") * 13
    m = F.when(wq < 4, 0).when(wq < 9, 1).otherwise(2)
    m_off = F.when(F.col("m") == 0, 0).when(F.col("m") == 1, 4).otherwise(9)
    return (days
            .withColumn("fiscal_year", fy)
            .withColumn("fy_start", fiscal_year_start(F.col("fiscal_year")))
            .withColumn("wk0", wk0)
            .withColumn("q", q)
            .withColumn("m", m)
            .select(
                "asofdate",
                y.cast("bigint").alias("calendar_year"),
                F.month(d).cast("bigint").alias("calendar_month"),
                F.col("fiscal_year").cast("bigint").alias("fiscal_year"),
                (F.col("q") * 3 + F.col("m") + 1).cast("bigint").alias("fiscal_month"),
                F.date_add(F.col("fy_start"), (F.col("q") * 13 + m_off) * 7).alias("fiscal_month_start"),
                (F.col("wk0") + 1).cast("bigint").alias("fiscal_week"),
                F.date_add(F.col("fy_start"), F.col("wk0") * 7).alias("fiscal_week_start"),
                F.date_add(F.col("fy_start"), F.col("wk0") * 7 + 6).alias("fiscal_week_end"),
            ))


def spanning(facts: DataFrame, *dates: str, margin_days: int = 0) -> DataFrame:
    """The calendar from the first to the last date in the given columns of ``facts`` (one
    aggregate; an empty table gives the default span)."""
    days = [F.to_date(F.col(c)) for c in dates]
    lo, hi = facts.agg(F.least(*[F.min(d) for d in days], F.lit(None).cast("date")),
                       F.greatest(*[F.max(d) for d in days], F.lit(None).cast("date"))).first()
    if lo is None:
        return calendar(facts.sparkSession)
    margin = dt.timedelta(days=margin_days)
    return calendar(facts.sparkSession, (lo - margin).isoformat(), (hi + margin).isoformat())


def on_calendar(facts: DataFrame, days: DataFrame, date: str | Column) -> DataFrame:
    """``facts`` joined to the calendar rows of ``date``.

    Null dates have no day and drop out, as in an inner join; a date the calendar does not hold
    fails the query and names the date, so a calendar that is too short loses no rows unseen.
    ``days`` keeps the name ``asofdate`` for its day.
    """
    day = F.to_date(F.col(date) if isinstance(date, str) else date)
    held = days.select(F.col("asofdate").alias("_cal_match"), *days.columns)
    j = facts.withColumn("_cal_day", day).where(F.col("_cal_day").isNotNull()).join(
        held, F.col("_cal_day") == F.col("_cal_match"), "left")
    missing = F.raise_error(F.concat(F.lit("no calendar row for "), F.col("_cal_day").cast("string"))).cast("boolean")
    return j.where(F.when(F.col("_cal_match").isNotNull(), True).otherwise(missing)).drop("_cal_day", "_cal_match")
