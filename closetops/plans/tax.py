"""Jurisdiction-entry report: units shipped into one tax zone, numbered per unit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranged import row_number_ranged
from ..sources.calendar import on_calendar

ENTRY_COLS = ["calendar_year", "calendar_month", "state", "city", "order_id", "barcode", "sku",
              "unit_cost", "activated_on", "ship_date", "postal_code"]


def tax_entries(og: DataFrame, zones: DataFrame, ogr: DataFrame, fvi: DataFrame, shipment: DataFrame,
                dates: DataFrame, zone_code: str = "IL", cutoff: str = "2018-01-01") -> DataFrame:
    """Distinct shipped units into ``zone_code``; ``nth_entry`` numbers a unit's entries by ship date
    (ties broken by the remaining columns), -1 for units activated before ``cutoff``."""
    z = zones.filter(F.col("zone_code") == zone_code).select(F.col("zone_id").alias("_zid"))
    o = og.join(z, og["state"] == z["_zid"], "inner").select("group_id", "state", "city", "postal_code")
    b = ogr.select(F.col("group_id").alias("_bg"), "order_id", "barcode", "sku").distinct()
    v = fvi.select(F.col("barcode").alias("_vb"), F.col("cost").alias("unit_cost"), "activated_on")
    s = shipment.select(F.col("shipper_reference").alias("_sr"), F.to_date("ship_date").alias("ship_date")).distinct()
    cal = dates.select("asofdate", "calendar_year", "calendar_month")
    a = (o.join(b, o["group_id"] == b["_bg"], "inner")
         .join(v, F.col("barcode") == v["_vb"], "inner")
         .join(s, o["group_id"] == s["_sr"], "inner"))
    a = on_calendar(a, cal, "ship_date").select(*ENTRY_COLS).distinct()
    order = ["ship_date", "order_id", "sku", "state", "city", "postal_code", "calendar_year", "calendar_month",
             "unit_cost", "activated_on"]
    x = row_number_ranged(a, ["barcode"], order, "_rn")
    return (x.select(*ENTRY_COLS,
                     F.when(F.to_date("activated_on") < F.lit(cutoff).cast("date"), F.lit(-1))
                     .otherwise(F.col("_rn")).cast("bigint").alias("nth_entry"))
            .orderBy("barcode", "nth_entry"))
