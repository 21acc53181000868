"""Daily ageing of idle inventory units.

next scan per unit -> stretches idle >= 48 h -> one row per report day
inside each stretch -> per-day, per-site histogram of stretch length.

The report day ``d`` belongs to a stretch when ``d + 10h`` lies in
[scan + 48h, next scan], so each stretch has a first and a last report day.  The
histogram counts covering stretches per day with a sweep line (marks at both
ends, summed up per site), without a row per stretch and day; the report of the
single days expands them with ``sequence``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import hour_boundaries
from ..operators.seqlog import DEFAULT_SEQ_BUCKET, next_state
from ..operators.sweep import daily_cover
from ..sources.calendar import on_calendar

# Fixed values of the report.
IDLE_HOURS = 48
REPORT_HOUR = 10
EXCLUDED_STATIONS = ("CUSTOMER", "RACK", "DARK_STORAGE")
BARCODE_PATTERNS = ("^9", "^1")
# Histogram edges in hours and the bin names (2-3 days ... 180 days and above).
BIN_EDGES = (48, 72, 240, 720, 4320)
BIN_NAMES = ("days_2_3", "days_3_10", "days_10_30", "days_30_180", "days_180_plus")


def idle_stretches(ns: DataFrame, idle_since: str = "2017-01-01",
                   min_hours: int = IDLE_HOURS) -> DataFrame:
    """Scans followed by >= ``min_hours`` of no scan, ending on/after ``idle_since``."""
    return (ns.filter((F.col("next_updated_on") >= F.col("cur_updated_on")
                       + F.make_dt_interval(F.lit(0), F.lit(min_hours)))
                      & (F.col("next_updated_on") >= F.lit(idle_since).cast("timestamp_ntz"))
                      & (F.col("status") != "INACTIVE"))
            .withColumn("time_to_next_scan", hour_boundaries("cur_updated_on", "next_updated_on")))


def report_spans(stretches: DataFrame, as_of: str, report_hour: int = REPORT_HOUR) -> DataFrame:
    """Stretches of the report's stations and barcodes with the first and last report day (``_lo``, ``_hi``).

    A stretch is reported on day d when aging_date <= d + report_hour <= next_updated_on and d < as_of.
    """
    shift = F.make_dt_interval(F.lit(0), F.lit(report_hour))
    lo_ts = F.col("aging_date") - shift
    lo_day = F.to_date(lo_ts)
    lo = F.when(lo_ts == lo_day.cast("timestamp_ntz"), lo_day).otherwise(F.date_add(lo_day, 1))
    hi = F.least(F.to_date(F.col("next_updated_on") - shift),
                 F.date_sub(F.lit(as_of).cast("date"), 1))
    barcode_ok = F.col("barcode").rlike(BARCODE_PATTERNS[0])
    for p in BARCODE_PATTERNS[1:]:
        barcode_ok = barcode_ok | F.col("barcode").rlike(p)
    return (stretches
            .filter(~F.col("cur_location_station").isin(*EXCLUDED_STATIONS) & barcode_ok)
            .withColumn("_lo", lo).withColumn("_hi", hi)
            .filter(F.col("_lo") <= F.col("_hi")))


def expand_days(stretches: DataFrame, calendar: DataFrame, as_of: str,
                report_hour: int = REPORT_HOUR) -> DataFrame:
    """One row per (stretch, report day), with the day's fiscal week; a day the calendar lacks fails."""
    x = (report_spans(stretches, as_of, report_hour)
         .withColumn("asofdate", F.explode(F.sequence("_lo", "_hi"))).drop("_lo", "_hi"))
    cal = calendar.select(F.col("asofdate"), "fiscal_week", "fiscal_week_start", "fiscal_week_end")
    return on_calendar(x.withColumnRenamed("asofdate", "_d"), cal, "_d").select(
        "asofdate", *[c for c in x.columns if c != "asofdate"], "fiscal_week", "fiscal_week_start", "fiscal_week_end")


def _bins() -> dict[str, Column]:
    h = F.col("time_to_next_scan")
    tops = [*BIN_EDGES[1:], None]
    return {name: (h >= lo) if hi is None else (h >= lo) & (h < hi) for name, lo, hi in zip(BIN_NAMES, BIN_EDGES, tops)}


def ageing_bins(days: DataFrame) -> DataFrame:
    """Count report rows per (day, site) into stretch-length bins; newest day first."""
    return (days.filter(F.col("asofdate").isNotNull())
            .groupBy("asofdate", "cur_location_site")
            .agg(F.count(F.lit(1)).alias("total"), *[F.count(F.when(c, 1)).alias(n) for n, c in _bins().items()])
            .orderBy(F.col("asofdate").desc()))


def ageing_histogram(stretches: DataFrame, calendar: DataFrame, as_of: str) -> DataFrame:
    """The rows of ``ageing_bins(expand_days(..))`` by a sweep over the stretches' ends, so that no
    stretch is expanded to its days."""
    spans = report_spans(stretches, as_of).select("cur_location_site", "_lo", "_hi", "time_to_next_scan")
    return daily_cover(spans, "cur_location_site", "_lo", "_hi", {"total": F.lit(True), **_bins()}, calendar).orderBy(
        F.col("asofdate").desc())


def ageing_report(scan_log: DataFrame, calendar: DataFrame, as_of: str,
                  idle_since: str = "2017-01-01",
                  bucket_width: int | None = DEFAULT_SEQ_BUCKET) -> DataFrame:
    ns = next_state(scan_log, as_of=as_of, bucket_width=bucket_width)
    return ageing_histogram(idle_stretches(ns, idle_since), calendar, as_of)
