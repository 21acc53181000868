"""Issue -> replacement matching, same-style replacement share, replacement weekdays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import week_start
from ..operators.aggs import count_distinct_ifs
from .order_issues import DELIVERY_REPLACEMENT_REASONS, _classic_rental, replacements

CLASSIC_TYPES = ("CLASSIC", "CLASSIC_POSH", "STORE_PICKUP", "STORE_PICKUP_WEB")


def issue_replacements(po: DataFrame, af: DataFrame, ogr: DataFrame, styles: DataFrame,
                       variant: str = "rpl") -> DataFrame:
    """Booking-level issue facts with the replacement booking, group and style.

    ``variant="rpl"`` has group ids and the PO columns; ``"style"`` is the
    narrower frame the same-style share reads.
    """
    p = _classic_rental(po).select(
        "order_id", "uid", "group_id", "order_datetime_est", "group_created_est",
        "reservation_booking_id", "reservation_created", "email", "type",
        "last_possible_begin_date", "rental_begin_date", "style", "po_category").distinct()
    a = af.select(F.col("annotation_target_id").alias("_at"), "annotation_group").distinct()
    rp = replacements(af, ogr, styles).select(
        F.col("order_id").alias("_ro"), F.col("group_id").alias("_rg"), "replacement_style",
        F.col("annotation_target_id").alias("_rt"), "detail_value").distinct()
    x = (p.join(a, p["reservation_booking_id"] == a["_at"], "left")
         .join(rp, p["order_id"] == rp["_ro"], "left"))
    g, dv = F.col("annotation_group"), F.col("detail_value")
    fit, fit_r = g == "RFF", (g == "RFF") & (dv == "FIT")
    qual, qual_r = g == "QUALITY_ISSUE", (g == "QUALITY_ISSUE") & dv.like("%QUALITY%")
    dlv, dlv_r = g == "SHIPPING", (g == "SHIPPING") & dv.isin(*DELIVERY_REPLACEMENT_REASONS)
    has_po = F.col("po_category").isNotNull()
    po_r = has_po & dv.like("%PO%")
    c = F.col
    rpl = variant == "rpl"
    cols = [
        "order_id", "uid", "group_id", "order_datetime_est", "group_created_est",
        "reservation_booking_id", "reservation_created", "email", "type",
        "last_possible_begin_date", "rental_begin_date",
        c("_ro").alias("order_id_w_rplm"), "detail_value",
        F.when(fit, c("order_id")).alias("fit_order_id"),
        F.when(fit, c("style")).alias("fit_style"),
        *([F.when(fit, c("group_id")).alias("fit_group_id")] if rpl else []),
        F.when(fit, c("reservation_booking_id")).alias("fit_booking_id"),
        F.when(fit_r, c("order_id")).alias("rpl_fit_order_id"),
        F.when(fit_r, c("_rt")).alias("rpl_fit_booking_id"),
        *([F.when(fit_r, c("_rg")).alias("rpl_fit_group_id")] if rpl else []),
        F.when(fit_r, c("replacement_style")).alias("rpl_fit_replacement_style"),
        F.when(qual, c("order_id")).alias("quality_order_id"),
        F.when(qual, c("style")).alias("quality_style"),
        *([F.when(qual, c("group_id")).alias("quality_group_id")] if rpl else []),
        F.when(qual, c("reservation_booking_id")).alias("quality_booking_id"),
        F.when(qual_r, c("order_id")).alias("rpl_quality_order_id"),
        *([F.when(qual_r, c("_rg")).alias("rpl_quality_group_id")] if rpl else []),
        F.when(qual_r, c("_rt")).alias("rpl_quality_booking_id"),
        F.when(qual_r, c("replacement_style")).alias("rpl_quality_replacement_style"),
        F.when(dlv, c("order_id")).alias("delivery_order_id"),
        F.when(dlv, c("style")).alias("delivery_style"),
        *([F.when(dlv, c("group_id")).alias("delivery_group_id")] if rpl else []),
        F.when(dlv, c("reservation_booking_id")).alias("delivery_reservation_booking_id"),
        F.when(dlv_r, c("order_id")).alias("rpl_delivery_order_id"),
        *([F.when(dlv_r, c("_rg")).alias("rpl_delivery_group_id")] if rpl else []),
        F.when(dlv_r, c("_rt")).alias("rpl_delivery_booking_id"),
        F.when(dlv_r, c("replacement_style")).alias("rpl_delivery_replacement_style"),
    ]
    if rpl:
        cols += [
            F.when(has_po, c("order_id")).alias("po_order_id"),
            F.when(has_po, c("group_id")).alias("po_group_id"),
            F.when(has_po, c("reservation_booking_id")).alias("po_booking_id"),
            F.when(po_r, c("_ro")).alias("rpl_po_order_id"),
            F.when(po_r, c("_rg")).alias("rpl_po_group_id"),
            F.when(po_r, c("_rt")).alias("rpl_po_booking_id"),
        ]
    return x.select(*cols).distinct()


def _recent(view: DataFrame, as_of: str, days: int) -> DataFrame:
    lo = F.date_sub(week_start(F.lit(as_of).cast("date")), days)
    return view.filter(F.col("rental_begin_date").between(lo, F.lit(as_of).cast("date")))


def same_style_share(style_view: DataFrame, as_of: str, days: int = 60) -> DataFrame:
    """Replacements in the same style as the item with the issue, per issue type.

    ``delivery_same_style_rpl`` counts the *fit* replacement booking id under
    the delivery condition, as the analysis does (always 0: one row cannot be
    both a fit and a delivery issue); ``delivery_same_style_rpl_by_delivery_id``
    counts the delivery replacement booking id.
    """
    c = F.col
    v = _recent(style_view, as_of, days)
    m = {
        "fit_total_rpl": (c("fit_style").isNotNull() & c("rpl_fit_replacement_style").isNotNull(),
                          c("rpl_fit_booking_id")),
        "fit_same_style_rpl": ((c("fit_style") == c("rpl_fit_replacement_style"))
                               & c("rpl_fit_replacement_style").isNotNull(), c("rpl_fit_booking_id")),
        "quality_total_rpl": (c("quality_style").isNotNull() & c("rpl_quality_replacement_style").isNotNull(),
                              c("rpl_quality_booking_id")),
        "quality_same_style_rpl": ((c("quality_style") == c("rpl_quality_replacement_style"))
                                   & c("rpl_quality_replacement_style").isNotNull(), c("rpl_quality_booking_id")),
        "delivery_total_rpl": (c("delivery_style").isNotNull() & c("rpl_delivery_replacement_style").isNotNull(),
                               c("rpl_delivery_booking_id")),
        "delivery_same_style_rpl": ((c("delivery_style") == c("rpl_delivery_replacement_style"))
                                    & c("rpl_delivery_replacement_style").isNotNull(), c("rpl_fit_booking_id")),
        "delivery_same_style_rpl_by_delivery_id": (
            (c("delivery_style") == c("rpl_delivery_replacement_style"))
            & c("rpl_delivery_replacement_style").isNotNull(), c("rpl_delivery_booking_id")),
    }
    return count_distinct_ifs(v, m)


def recent_delivery_issues(style_view: DataFrame, as_of: str, days: int = 180) -> DataFrame:
    return _recent(style_view.filter(F.col("delivery_reservation_booking_id").isNotNull()), as_of, days)


def replacement_by_weekday(resolution: DataFrame, as_of: str, days: int = 60) -> DataFrame:
    """Distinct replacement bookings by begin weekday (0 = Sunday) and order type, last ``days``."""
    lo = F.date_sub(week_start(F.lit(as_of).cast("date")), days)
    x = resolution.filter(F.col("oi_resolution_date").between(lo, F.lit(as_of).cast("date")))
    return (x.groupBy((F.dayofweek("rental_begin_date") - 1).cast("bigint").alias("weekday"),
                      F.when(F.col("order_type").isin(*CLASSIC_TYPES), "CLASSIC")
                      .otherwise(F.col("order_type")).alias("order_type"))
            .agg(F.countDistinct("replacement_booking_id").alias("replacement_bookings"))
            .orderBy("order_type", "weekday"))
