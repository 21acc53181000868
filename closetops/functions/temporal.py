"""Date and time helpers with the warehouse's boundary-count semantics.

The analyses count *boundaries crossed* (``datediff(hour, a, b)`` is 1 for
01:59 -> 02:01), which differs from Spark's ``timestampdiff`` (full units).
Everything here works on TIMESTAMP_NTZ wall-clock values, so results do not
depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EASTERN = "America/New_York"
CENTRAL = "America/Chicago"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hour_boundaries(start, end) -> Column:
    """Number of hour boundaries between two timestamps (end - start)."""
    s, e = _c(start), _c(end)
    return (F.datediff(F.to_date(e), F.to_date(s)).cast("bigint") * 24
            + F.hour(e) - F.hour(s))


def day_boundaries(start, end) -> Column:
    """``datediff('day', start, end)``: midnights crossed."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def month_boundaries(start, end) -> Column:
    """``datediff('month', start, end)``: month starts crossed (Jan 31 -> Feb 1 is 1)."""
    s, e = _c(start), _c(end)
    return (F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)


def elapsed_days(later, earlier) -> Column:
    """Whole days of ``later - earlier`` (the DAY field of the interval), truncated toward zero."""
    return F.extract(F.lit("DAY"), _c(later) - _c(earlier))


def shift_zone(ts, from_zone: str, to_zone: str) -> Column:
    """Re-express a wall-clock NTZ timestamp of ``from_zone`` in ``to_zone``."""
    return F.convert_timezone(F.lit(from_zone), F.lit(to_zone), _c(ts))


def raw_bounds(ts, lo: str, hi: str) -> Column:
    """What a stored wall-clock time must meet for its zone-shifted value to lie in [lo, hi].

    No zone is a day or more away from another's wall clock at the offsets in use, so the raw
    value lies within a day of the window.  Unlike the shifted comparison this one names the bare
    column and reaches the scan; it is used beside the exact condition, never in its place.
    """
    day = F.make_dt_interval(F.lit(1))
    stored = lambda d: F.lit(d).cast("date").cast("timestamp_ntz")
    return _c(ts).between(stored(lo) - day, stored(hi) + day)


def to_eastern(ts) -> Column:
    """UTC wall clock -> US Eastern wall clock (the ``*_est`` columns)."""
    return shift_zone(ts, "UTC", EASTERN)


def epoch_to_ntz(seconds) -> Column:
    """Epoch seconds -> UTC wall-clock TIMESTAMP_NTZ, independent of the session zone."""
    s = _c(seconds).cast("bigint")
    return (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(F.floor(s / 86400).cast("int"), F.lit(0), F.lit(0),
                                 (s - F.floor(s / 86400) * 86400).cast("decimal(18,6)")))


def week_start(d) -> Column:
    """Monday of the ISO week of ``d`` as a DATE (``date_trunc('week', d)``), zone independent."""
    x = F.to_date(_c(d))
    return F.date_sub(x, (F.dayofweek(x) + 5) % 7)
