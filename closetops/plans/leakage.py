"""Refund leakage: confirmed ledger movements with the order profile; leakage by reason per month.

Ledger timestamps are Chicago wall clock; the analysis re-expresses them in
UTC before filtering and dating them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import CENTRAL, raw_bounds, shift_zone
from ..sources.calendar import on_calendar

# Fixed values of the analysis: membership products by SKU.
PRO_SKUS = ("XX8_ONE SIZE", "XX8_One Size")
UNLIMITED_SKUS = ("XX14_One Size", "XX13_One Size", "XX44_One Size", "XX45_One Size", "XX46_One Size",
                  "XX14_ONE SIZE", "XX13_ONE SIZE", "XX44_ONE SIZE", "XX45_ONE SIZE", "XX46_ONE SIZE",
                  "XX77_ONE SIZE", "XX77_One Size")
STYLEPASS_SKUS = ("XX55_One Size", "XX55_ONE SIZE")
ORDER_DATE_SHIFT_HOURS = 7
ECOMMERCE = "Ecommerce"


def _utc(c: str):
    return shift_zone(c, CENTRAL, "UTC")


def _between_dates(col, lo: str, hi: str):
    return col.between(F.lit(lo).cast("date").cast("timestamp_ntz"), F.lit(hi).cast("date").cast("timestamp_ntz"))


def order_profile(io: DataFrame, ig: DataFrame, ib: DataFrame, rb: DataFrame, rbd: DataFrame) -> DataFrame:
    """Per (invoice group, order): first invoice time, begin date, order type and membership flags."""
    g = ig.filter(F.col("group_id") != -1).select(F.col("id").alias("_igid"), F.col("invoice_order_id"),
                                                  F.col("group_id"))
    b = ib.select(F.col("invoice_group_id"), F.col("booking_id"))
    r = rb.select(F.col("id").alias("_rbid"), F.col("sku"))
    d = rbd.select(F.col("reservation_booking_id").alias("_dbid"), F.col("rental_begin_date"))
    x = (io.join(g, g["invoice_order_id"] == io["id"], "inner")
         .join(b, b["invoice_group_id"] == g["_igid"], "inner")
         .join(r, b["booking_id"] == r["_rbid"], "inner")
         .join(d, r["_rbid"] == d["_dbid"], "inner"))
    member = lambda skus: F.max(F.when(F.col("sku").isin(*skus), 1).otherwise(0))
    return x.groupBy("group_id", "order_id").agg(
        F.min("created_at").alias("order_date"),
        F.max("sku").alias("sku"),
        F.to_date(F.max("rental_begin_date")).alias("rental_begin_date"),
        F.max("order_type").alias("order_type"),
        member(PRO_SKUS).alias("pro_membership"),
        member(UNLIMITED_SKUS).alias("unlimited_membership"),
        member(STYLEPASS_SKUS).alias("stylepass_membership"))


def leakage_detail(fli: DataFrame, profile: DataFrame, showroom_order: DataFrame, showroom: DataFrame,
                   lo: str, hi: str, begin_from: str = "2015-01-01") -> DataFrame:
    """Confirmed ledger lines updated in [lo, hi] (UTC) of orders begun in [begin_from, hi]."""
    f = (fli.filter((F.col("status") == "CONFIRMED") & raw_bounds("updated_at", lo, hi))
         .withColumn("initiated_at", _utc("created_at"))
         .withColumn("updated_at_utc", _utc("updated_at"))
         .filter(_between_dates(F.col("updated_at_utc"), lo, hi)))
    z = (profile.filter(F.col("rental_begin_date").between(F.lit(begin_from).cast("date"), F.lit(hi).cast("date")))
         .select(F.col("group_id").alias("_zg"), "order_date", "rental_begin_date", "order_type",
                 "pro_membership", "unlimited_membership", "stylepass_membership"))
    so = (showroom_order.filter(F.col("deleted") == 0)
          .select(F.col("order_id").alias("_soid"), "showroom_id").distinct())
    s = showroom.select(F.col("id").alias("_sid"), F.col("name").alias("_sname"))
    x = (f.join(z, f["group_id"] == z["_zg"], "inner")
         .join(so, f["order_id"] == so["_soid"], "left")
         .join(s, F.col("showroom_id") == s["_sid"], "left"))
    both = (F.col("unlimited_membership") == 1) & (F.col("pro_membership") == 1)
    membership = (F.when(both, "Both").when(F.col("unlimited_membership") == 1, "Unlimited")
                  .when(F.col("pro_membership") == 1, "Pro")
                  .when(F.col("stylepass_membership") == 1, "StylePass"))
    showroom_name = F.when(F.coalesce(F.col("_sname"), F.lit("")) == "", ECOMMERCE).otherwise(F.col("_sname"))
    return (x.select(
        F.col("id").alias("fli_id"), "order_id", "group_id", "tax_rate",
        F.col("subtotal").cast("decimal(9,2)").alias("subtotal"),
        F.col("tax").cast("decimal(9,2)").alias("tax"),
        F.col("total").cast("decimal(9,2)").alias("total"),
        "type", "direction", "status", "initiated_at",
        F.col("updated_at_utc").alias("updated_at"),
        (F.col("order_date") + F.make_dt_interval(F.lit(0), F.lit(ORDER_DATE_SHIFT_HOURS))).alias("order_date"),
        F.col("rental_begin_date").alias("rent_begin_date"), "order_type",
        membership.alias("membership_group"), showroom_name.alias("showroom"))
        .distinct()
        .orderBy("fli_id", "order_id", "group_id", "tax_rate", "subtotal", "tax"))


def leakage_by_reason(ots: DataFrame, fli: DataFrame, orderdata: DataFrame, dates: DataFrame,
                      lo: str, hi: str, begin_from: str = "2015-01-01", grain: str = "calendar") -> DataFrame:
    """Refunded amount per month and annotation type of refund transactions updated in [lo, hi].

    A transaction is dated by the earliest qualifying ledger update of its
    order group; that minimum is taken per group before the join, so no
    transaction is paired with every ledger line of its group.
    """
    f = (fli.filter((F.col("status") == "CONFIRMED") & (F.col("direction") == "OUT") & raw_bounds("updated_at", lo, hi))
         .withColumn("_u", _utc("updated_at"))
         .filter(_between_dates(F.col("_u"), lo, hi)))
    per_group = f.groupBy(F.col("group_id").alias("_fg")).agg(F.min(F.to_date("_u")).alias("updated_at"))
    ot = orderdata.groupBy(F.col("order_id").alias("_oto")).agg(F.min("rental_begin_date").alias("rental_begin_date"))
    o = ots.filter(F.col("fli_total") < 0)
    keys = ["transaction_id", "order_id", "group_id", "annotation_type_summary", "annotation_group_summary",
            "fli_total", "fli_tax_total", "fli_pretax_total", "rental_begin_date"]
    rf = (o.join(per_group, o["group_id"] == per_group["_fg"], "inner")
          .join(ot, o["order_id"] == ot["_oto"], "left")
          .filter(F.col("rental_begin_date").between(F.lit(begin_from).cast("date"), F.lit(hi).cast("date")))
          .select(*keys, "updated_at").distinct())
    if grain == "calendar":
        y, m = "calendar_year", "calendar_month"
    else:
        y, m = "fiscal_year", "fiscal_month"
    cal = dates.select("asofdate", y, m)
    x = on_calendar(rf, cal, "updated_at")
    return x.groupBy(y, m, "annotation_type_summary").agg(
        (-F.sum("fli_total")).cast("decimal(38,6)").alias("fli_total"))
