"""Predicate and flag helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def flag(cond: Column) -> Column:
    """0/1 integer flag; a NULL condition yields 0 (the ELSE arm)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def any_in(cols, values) -> Column:
    """True when any of ``cols`` is in ``values``; NULL members count as false."""
    return reduce(lambda a, b: a | b, [F.coalesce(_c(c).isin(list(values)), F.lit(False)) for c in cols])


def exclude_prefix_digits(col, prefixes=("SS", "XX")) -> Column:
    """Keep rows whose value matches none of ``^<prefix>\\d+`` (NULL values are dropped)."""
    c = _c(col)
    return reduce(lambda a, b: a & b, [~c.rlike(rf"^{p}\d+") for p in prefixes])


def months_back(as_of, months: int) -> Column:
    """``as_of - interval 'n months'`` as a DATE."""
    return F.add_months(F.lit(as_of).cast("date") if not isinstance(as_of, Column) else as_of, -months)
