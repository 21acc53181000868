"""Joins of points to intervals, in one or more dimensions, through an index of cells.

An interval of L days belongs to the level whose cells are at least L days
wide (16, 64, 256, ... days), so it meets two cells at most; a point meets one
cell on each level that occurs.  Points and boxes (one interval per dimension)
are matched by an equi-join on (key, levels, cells) and the exact condition.
The join's keys are as many as the cells, so a key with thousands of intervals
is spread over the tasks, and a point meets only boxes near it.  Cells and
levels are merged, never broadcast: the planner takes them for as small as the
table the boxes were made of, and they would be gathered at the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days of a cell on the lowest level, and how much wider the next level's are.
CELL, STEP = 16, 4


def _day(c: str | Column) -> Column:
    return F.unix_date(F.to_date(F.col(c) if isinstance(c, str) else c))


def _width(level: Column) -> Column:
    return (CELL * F.pow(F.lit(STEP), level)).cast("bigint")


def interval_join(points: DataFrame, boxes: DataFrame, on: tuple[str, str], within: list[tuple[str, str, str]]) -> DataFrame:
    """Inner join of ``points`` and ``boxes`` where points[on[0]] = boxes[on[1]] and, for each
    (point, low, high) of ``within``, the point lies in [low, high]; low and high are columns of
    ``boxes``, dates or timestamps.

    The result equals that of the plain join on the condition, repeated rows included; nulls and
    intervals with low > high match nothing.  Column names of the two sides must differ.
    """
    cells = boxes
    names = []
    for i, (_, lo, hi) in enumerate(within):
        length = _day(hi) - _day(lo) + 1
        level = F.greatest(F.lit(0), F.ceil(F.log(length / CELL) / F.log(F.lit(float(STEP)))).cast("int"))
        cells = (cells.where(F.col(lo) <= F.col(hi)).withColumn(f"_il{i}", level)
                 .withColumn(f"_ic{i}", F.explode(F.sequence(F.floor(_day(lo) / _width(F.col(f"_il{i}"))),
                                                             F.floor(_day(hi) / _width(F.col(f"_il{i}")))))))
        names += [f"_il{i}", f"_ic{i}"]
    cells = cells.withColumnRenamed(on[1], "_ikey")
    levels = cells.select("_ikey", *names[::2]).distinct().withColumnRenamed("_ikey", "_lkey").hint("merge")
    asked = points.join(levels, points[on[0]] == levels["_lkey"]).drop("_lkey")
    for i, (point, _, _) in enumerate(within):
        asked = asked.withColumn(f"_ic{i}", F.floor(_day(point) / _width(F.col(f"_il{i}"))))
    asked = asked.withColumn("_ikey", F.col(on[0]))
    inside = F.lit(True)
    for point, lo, hi in within:
        inside = inside & (F.col(point) >= F.col(lo)) & (F.col(point) <= F.col(hi))
    return asked.join(cells.hint("merge"), ["_ikey", *names]).where(inside).drop("_ikey", *names)
