"""Sweep line: how many intervals cover each day, without expanding them to days.

An interval of days adds one on its first day and takes one off on the day
after its last.  Summed per (group, day) these marks are one row per group and
day at most, whatever the number and the length of the intervals, and their
running sum per group is the number of intervals that cover the day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.calendar import on_calendar


def daily_cover(intervals: DataFrame, group: str, first: str, last: str, counts: dict[str, Column],
                calendar: DataFrame, day: str = "asofdate") -> DataFrame:
    """(day, group, one column per entry of ``counts``): for each day of ``calendar`` and each group,
    the number of covering intervals for which the condition holds; days no interval covers are left out.

    A null group is a group; intervals with a null end or with first > last cover nothing; a span
    that leaves the calendar fails the query.  Only the span of each group, one row, is expanded to its days, not the
    intervals; the window holds the days of one group.
    """
    ok = intervals.where(F.col(first) <= F.col(last))
    flags = {n: F.when(c, 1).otherwise(0) for n, c in counts.items()}
    names = ["_all", *counts]

    def marks(at: Column, sign: int) -> DataFrame:
        return ok.select(F.col(group), at.alias(day), F.lit(sign).alias("_all"), *[(sign * c).alias(n) for n, c in flags.items()])

    days = calendar.select(F.col(day).alias("asofdate")).distinct()
    spans = ok.groupBy(F.col(group).alias("_g")).agg(F.min(first).alias("_lo"), F.max(last).alias("_hi"))
    spine = on_calendar(spans.select("_g", F.explode(F.sequence("_lo", "_hi")).alias("_d")), days, "_d").select(
        F.col("_g").alias(group), F.col("asofdate").alias(day), F.lit(0).alias("_all"), *[F.lit(0).alias(n) for n in counts])
    rows = (marks(F.col(first), 1).unionByName(marks(F.date_add(last, 1), -1)).unionByName(spine.withColumn("_day", F.lit(1)),
                                                                                        allowMissingColumns=True)
            .groupBy(group, day).agg(*[F.sum(n).alias(n) for n in names], F.max("_day").alias("_day")))
    upto = Window.partitionBy(group).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return (rows.select(day, group, "_day", *[F.sum(n).over(upto).alias(n) for n in names])
            .where("_day = 1 AND _all > 0").select(day, group, *counts))
