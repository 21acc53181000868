"""Problem-order fact: classic orders and subscription orders, unioned.

The subscription branch reads three sources — canceled subscription
bookings (``reservations.unit_usage`` of ``reservation_fact``), active
subscription bookings and add-on bookings (``reservations.reservation_extras``)
— unioned *by column name*.  (The analysis lists ``mail, child_sku`` in the
third branch where the first two list ``child_sku, mail``; a positional union
would swap them, so names are aligned here.  The canceled source carries no
add-on sku, so its ``child_sku`` is NULL.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import any_in, months_back

# Fixed values of the analysis.
CLASSIC_TYPES = ("CLASSIC", "CLASSIC_POSH", "STORE_PICKUP", "STORE_PICKUP_WEB")
PROBLEM_STATUSES = ("ITEM_LIMBO", "PROBLEM_ITEM", "PROBLEM_IN_PROGRESS")
LIMBO = "ITEM_LIMBO"
INTERNAL_LABEL, EXTERNAL_LABEL = "staff_email", "non staff_email"

OUT_COLS = ["order_type", "group_id", "reservation_booking_id", "extra_reservation_booking_id",
            "rental_begin_date", "merchandise_category", "type", "email", "sub_type", "po_category",
            "po_reason", "po_parent_group_id", "po_parent_extra_group_id",
            "po_parent_reservations_booking_id", "parent_extras_po_reservations_booking_id"]

SUB_COLS = ["fulfillment_id", "rental_begin_date", "merchandise_category", "product_type", "order_id",
            "group_id", "reservation_booking_id", "sku", "child_sku", "mail", "last_fulfillment_status",
            "last2nd_fulfillment_status", "last_fulfillment_updated_on", "last2nd_fulfillment_updated_on",
            "cancel_flag"]


def _since(as_of: str, months: int):
    return F.col("rental_begin_date") > months_back(as_of, months)


def _email(internal_domain: str):
    return (F.when(F.col("mail").like(f"%{internal_domain}%"), INTERNAL_LABEL)
            .otherwise(EXTERNAL_LABEL).alias("email"))


def classic_candidates(apr: DataFrame, as_of: str, months: int = 8) -> DataFrame:
    """Problem-report rows of classic orders inside the look-back."""
    return apr.filter(F.col("order_type").isin(*CLASSIC_TYPES) & _since(as_of, months))


def subscription_candidates(bookings: DataFrame, as_of: str, months: int = 24) -> DataFrame:
    """Subscription bookings inside the union's look-back."""
    return bookings.filter((F.col("order_type") == "QUEUE") & _since(as_of, months))


def reported(bookings: DataFrame, as_of: str, months: int = 8) -> DataFrame:
    """Bookings inside the look-back of the report's branches."""
    return bookings.filter(_since(as_of, months))


def problem_orders_classic(apr: DataFrame, pmi: DataFrame, extras: DataFrame, as_of: str,
                           internal_domain: str, months: int = 8) -> DataFrame:
    return classic_rows(apr, pmi, extras, as_of, internal_domain, months).distinct()


def classic_rows(apr: DataFrame, pmi: DataFrame, extras: DataFrame, as_of: str,
                 internal_domain: str, months: int = 8) -> DataFrame:
    """The classic branch before its rows are made distinct."""
    a = classic_candidates(apr, as_of, months)
    pm = pmi.filter(F.col("special_type") != "X").select(F.col("sku").alias("_psku"))
    e = extras.select(F.col("reservation_booking_id").alias("_ebid"), F.col("child_sku").alias("_echild"),
                      F.col("last_fulfillment_status").alias("_elfs"))
    x = (a.join(pm, a["sku"] == pm["_psku"], "inner")
         .join(e, a["reservation_booking_id"] == e["_ebid"], "left"))
    cat, reason, lfs = F.col("po_category"), F.col("po_reason"), F.col("_elfs")
    limbo = lfs == LIMBO
    no_cat = cat.isNull()
    low = F.lower(reason)
    return x.select(
        F.lit("Classic").alias("order_type"), "group_id", "reservation_booking_id",
        F.when(F.col("_echild").isNotNull(), F.col("reservation_booking_id")).alias("extra_reservation_booking_id"),
        "rental_begin_date", "merchandise_category", "type", _email(internal_domain), "sub_type",
        F.when(no_cat & limbo, "Warehouse").otherwise(cat).alias("po_category"),
        (F.when(no_cat & limbo, "Extra PO")
         .when((cat == "Predicted") & low.like("%late%"), "Lateness")
         .when(low.like("%allogator%"), "ALLOGATOR UNKNOWN")
         .when(no_cat & (reason == "Predicted"), F.lit(None))
         .when((cat == "Warehouse") & low.like("%miss%"), "Missing")
         .otherwise(reason)).alias("po_reason"),
        F.when(cat.isNotNull(), F.col("group_id")).alias("po_parent_group_id"),
        F.when(cat.isNotNull() | limbo, F.col("group_id")).alias("po_parent_extra_group_id"),
        F.when(cat.isNotNull(), F.col("reservation_booking_id")).alias("po_parent_reservations_booking_id"),
        F.when(limbo | cat.isNotNull(), F.col("reservation_booking_id"))
        .alias("parent_extras_po_reservations_booking_id"),
    )


def subscription_sources(canceled: DataFrame, ogr: DataFrame, extras: DataFrame, as_of: str,
                         months: int = 24) -> DataFrame:
    c = (canceled.filter(_since(as_of, months))
         .withColumn("child_sku", F.lit(None).cast("string")).withColumn("cancel_flag", F.lit(1)))
    o = (subscription_candidates(ogr, as_of, months)
         .withColumn("child_sku", F.lit(None).cast("string")).withColumn("cancel_flag", F.lit(0)))
    e = subscription_candidates(extras, as_of, months).withColumn("cancel_flag", F.lit(0))
    return (c.select(*SUB_COLS).unionByName(o.select(*SUB_COLS)).unionByName(e.select(*SUB_COLS))
            .distinct())


def problem_orders_subscription(sources: DataFrame, ups: DataFrame, pmi: DataFrame, as_of: str,
                                internal_domain: str, months: int = 8) -> DataFrame:
    return subscription_rows(sources, ups, pmi, as_of, internal_domain, months).distinct()


def subscription_rows(sources: DataFrame, ups: DataFrame, pmi: DataFrame, as_of: str,
                      internal_domain: str, months: int = 8) -> DataFrame:
    """The subscription branch before its rows are made distinct."""
    u = ups.select(F.col("fulfillment_id").alias("_ufid"), "po_category", "po_reason")
    pm = pmi.select(F.col("sku").alias("_psku"), "sub_type")
    x = (reported(sources, as_of, months)
         .join(u, sources["fulfillment_id"] == u["_ufid"], "left")
         .join(pm, sources["sku"] == pm["_psku"], "inner"))
    problem = any_in(["last_fulfillment_status", "last2nd_fulfillment_status"], PROBLEM_STATUSES)
    keep = problem | (F.col("cancel_flag") == 0)
    cat = F.col("po_category")
    return x.select(
        F.lit("Unlimited").alias("order_type"),
        F.when(keep, F.col("group_id")).alias("group_id"),
        F.when(keep, F.col("reservation_booking_id")).alias("reservation_booking_id"),
        F.when(F.col("child_sku").isNotNull(), F.col("reservation_booking_id")).alias("extra_reservation_booking_id"),
        "rental_begin_date", "merchandise_category", F.col("product_type").alias("type"),
        _email(internal_domain), "sub_type",
        F.when(cat.isNull() & problem, "Warehouse").otherwise(cat).alias("po_category"),
        F.when(cat.isNull() & problem, "Extra PO").otherwise(F.col("po_reason")).alias("po_reason"),
        F.when(cat.isNotNull(), F.col("group_id")).alias("po_parent_group_id"),
        F.when(cat.isNotNull() | problem, F.col("group_id")).alias("po_parent_extra_group_id"),
        F.when(cat.isNotNull(), F.col("reservation_booking_id")).alias("po_parent_reservations_booking_id"),
        F.when(cat.isNotNull() | problem, F.col("reservation_booking_id"))
        .alias("parent_extras_po_reservations_booking_id"),
    )


def problem_orders(classic: DataFrame, subscription: DataFrame) -> DataFrame:
    """The rows of both branches, each once, whether they were made distinct before or not."""
    return classic.select(*OUT_COLS).unionByName(subscription.select(*OUT_COLS)).distinct()
