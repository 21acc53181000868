"""Order issues, refunds and repeat orders (customer loyalty after an issue).

refund_delta          first-invoice amount minus net confirmed amount per order
order_issues          bookings annotated with issue type, replacement and refund
issue_rollup          one row per order with the issue / replacement order ids
issue_summary         + calendar, order rank and the issue category
loyalty               repeat orders within 30..365 days of the rental, by issue
unreplaced_orders     subscription orders in a late window with no replacement
profile_*             data-profile probes of the annotation log

Fan-out control: the analyses join bookings, annotations, replacements and
refunds on the order id and de-duplicate at the end.  Each side is reduced to
the distinct columns the output uses *before* the join, so the join emits
exactly the output rows; amounts that the analyses multiply through a join
(ledger x bookings of a group) are pre-summed per join key and multiplied
back, never expanded row by row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import exclude_prefix_digits
from ..operators import stage
from ..operators.aggs import horizon_counts
from ..operators.keybits import Asked, KeyBits, asked, key_bits, may_meet, stored_with_bits
from ..sources.calendar import on_calendar

# Fixed values of the analyses.
SPECIAL_SKU_PREFIXES = ("SS", "XX")
HORIZONS = (30, 60, 90, 180, 270, 365)
DELIVERY_REPLACEMENT_REASONS = ("CARRIER_ISSUE", "OPERATION_ISSUE")


def _signed(amount: str):
    return F.when(F.col("direction") == "OUT", F.lit(0) - F.col(amount)).otherwise(F.col(amount))


def _confirmed_count(fsh: DataFrame) -> DataFrame:
    """Number of CONFIRMED history rows per ledger line (the join multiplicity)."""
    return (fsh.filter(F.col("to_status") == "CONFIRMED")
            .groupBy(F.col("fli_id")).agg(F.count(F.lit(1)).alias("_conf")))


def confirmed_ledger(fli: DataFrame, fsh: DataFrame) -> DataFrame:
    """Confirmed ledger lines with the number of their confirmations as ``_conf``."""
    conf = _confirmed_count(fsh)
    return fli.join(conf, fli["id"] == conf["fli_id"], "inner")


def refund_delta(fli: DataFrame, fsh: DataFrame, invoice_order: DataFrame, uc_orders: DataFrame,
                 ogr: DataFrame, dates: DataFrame, internal_domain: str,
                 min_fiscal_year: int = 2015, ledger: DataFrame | None = None) -> DataFrame:
    """Per order (and booking fiscal week/month): step-0 amount, net amount and refund.

    The net amount sums every confirmed ledger line of the order's groups once
    per booking of that group (as the analysis joins ledger to bookings on the
    group id); that product is formed from per-group sums.  With ``ledger``, a stored part of
    :func:`confirmed_ledger` that holds whole orders, the result is theirs.
    """
    f = confirmed_ledger(fli, fsh) if ledger is None else ledger
    io0 = invoice_order.filter(F.col("seq") == 0).select(F.col("id").alias("_inv"))
    uco_ids = uc_orders.select(F.col("order_id").alias("_oid"))
    step0 = (f.join(io0, f["invoice_id"] == io0["_inv"], "inner")
             .join(uco_ids, f["order_id"] == uco_ids["_oid"], "inner")
             .groupBy("order_id")
             .agg(F.sum(_signed("subtotal") * F.col("_conf")).alias("fli_step_zero_amount")))
    per_group = (f.groupBy("order_id", "group_id")
                 .agg(F.sum(_signed("total") * F.col("_conf")).alias("_amt")))
    uco = (uc_orders.filter(~F.col("primary_email").like(f"%{internal_domain}"))
           .select(F.col("order_id").alias("_oid"), "order_type"))
    cal = dates.select("asofdate", "fiscal_year", "fiscal_week_start", "fiscal_month_start")
    bk = (on_calendar(ogr.select("group_id", "rental_begin_date"), cal, "rental_begin_date")
          .filter(F.col("fiscal_year") >= min_fiscal_year)
          .groupBy("group_id", "fiscal_week_start", "fiscal_month_start")
          .agg(F.count(F.lit(1)).alias("_bookings")))
    total = (per_group.join(uco, per_group["order_id"] == uco["_oid"], "inner")
             .join(bk, "group_id", "inner")
             .groupBy("order_id", "order_type", "fiscal_week_start", "fiscal_month_start")
             .agg(F.sum(F.col("_amt") * F.col("_bookings")).alias("fli_amount")))
    return (step0.join(total, "order_id", "inner")
            .select("order_id",
                    F.col("fli_step_zero_amount").cast("decimal(38,4)").alias("fli_step_zero_amount"),
                    F.col("fli_amount").cast("decimal(38,6)").alias("fli_amount"),
                    (F.col("fli_step_zero_amount") - F.col("fli_amount")).cast("decimal(38,6)").alias("refund")))


def replacements(af: DataFrame, ogr: Asked, styles: DataFrame | None = None) -> DataFrame:
    """Replacement bookings: annotation -> booking (-> style), distinct; other bookings are left out before they move."""
    a = af.filter((F.col("annotation_group") == "REPLACEMENT") & (F.col("detail_name") == "reason"))
    held = key_bits(a, "annotation_target_id")
    ogr = may_meet(asked(ogr, held), "reservation_booking_id", held)
    cols = [ogr["group_id"]]
    x = a.join(ogr, a["annotation_target_id"] == ogr["reservation_booking_id"], "inner")
    if styles is not None:
        x = x.join(styles.select(F.col("sku").alias("_ssku"), F.col("style").alias("replacement_style")),
                   ogr["sku"] == F.col("_ssku"), "inner")
        cols += [ogr["sku"].alias("replacement_sku"), F.col("replacement_style")]
    return x.select(a["order_id"], *cols, a["annotation_target_id"], a["detail_value"]).distinct()


def _classic_rental(po: DataFrame) -> DataFrame:
    return po.filter((F.col("order_type") == "CLASSIC") & (F.col("merchandise_category") == "RENTAL")
                     & exclude_prefix_digits("sku", SPECIAL_SKU_PREFIXES))


def _refunds(ledger: DataFrame) -> DataFrame:
    """Confirmed outgoing subtotal per order, counted once per confirmation."""
    return (ledger.filter(F.col("direction") == "OUT")
            .groupBy(F.col("order_id").alias("_fo"))
            .agg(F.sum(F.col("subtotal") * F.col("_conf")).alias("_refund")))


#: Bits of an order's mask of annotation groups.
ISSUE_BITS = {"RFF": 1, "QUALITY_ISSUE": 2, "SHIPPING": 4}


def order_rollup(po: DataFrame, af: DataFrame, ogr: DataFrame, fli: DataFrame, fsh: DataFrame) -> DataFrame:
    """The rows of ``issue_rollup(order_issues(..))`` without a row per booking, annotation and replacement.

    Each side is reduced to what the rollup asks of it before they meet: bookings to one row per
    (order, customer, begin date, e-mail), annotations to a bit mask per order, replacements to the
    least and greatest order group per (order, reason).  Some booking's group differs from some
    replacement's unless all four bounds are one group.  What is joined is as large as the result.
    """
    keys = ["order_id", "uid", "rental_begin_date", "email"]
    po_group = F.when(F.col("po_category").isNotNull(), F.col("group_id"))
    bookings = _classic_rental(po).groupBy(*keys).agg(
        F.countDistinct("group_id").alias("group_cnt"), F.count("po_category").alias("_npo"),
        F.min(po_group).alias("_plo"), F.max(po_group).alias("_phi"))
    bit = F.lit(0)
    for group, b in ISSUE_BITS.items():
        bit = F.when(F.col("annotation_group") == group, b).otherwise(bit)
    masks = (af.filter(F.col("annotation_group").isin(*ISSUE_BITS)).groupBy(F.col("order_id").alias("_ao"))
             .agg(F.bit_or(bit).alias("_mask")))
    rp = replacements(af, ogr).groupBy(F.col("order_id").alias("_ro"), "detail_value").agg(
        F.min("group_id").alias("_rlo"), F.max("group_id").alias("_rhi"))
    x = (bookings.join(masks, F.col("order_id") == F.col("_ao"), "left")
         .join(rp, F.col("order_id") == F.col("_ro"), "left")
         .join(_refunds(confirmed_ledger(fli, fsh)), F.col("order_id") == F.col("_fo"), "left"))
    oid, dv = F.col("order_id"), F.col("detail_value")
    has = {g: F.coalesce(F.col("_mask"), F.lit(0)).bitwiseAND(F.lit(b)) > 0 for g, b in ISSUE_BITS.items()}
    one_group = (F.col("_plo") == F.col("_phi")) & (F.col("_rlo") == F.col("_rhi")) & (F.col("_plo") == F.col("_rlo"))
    return x.select(
        *keys, "detail_value", F.coalesce("_refund", F.lit(0)).cast("decimal(38,4)").alias("refund_amount"), "group_cnt",
        F.col("_ro").alias("rpl_order_id"),
        F.when(has["RFF"], oid).alias("fit_order_id"),
        F.when(has["QUALITY_ISSUE"], oid).alias("quality_order_id"),
        F.when(has["SHIPPING"], oid).alias("delivery_order_id"),
        F.when(F.col("_npo") > 0, oid).alias("po_order_id"),
        F.when(has["RFF"] & (dv == "FIT"), oid).alias("rpl_fit_order_id"),
        F.when(has["QUALITY_ISSUE"] & dv.like("%QUALITY%"), oid).alias("rpl_quality_order_id"),
        F.when(has["SHIPPING"] & dv.isin(*DELIVERY_REPLACEMENT_REASONS), oid).alias("rpl_delivery_order_id"),
        F.when(dv.like("%PO%") & ~one_group, oid).alias("rpl_po_order_id"))


def order_issues(po: DataFrame, af: DataFrame, ogr: Asked, fli: DataFrame, fsh: DataFrame,
                 refund_view: DataFrame | Callable[[DataFrame, KeyBits], DataFrame]) -> DataFrame:
    """Booking-level issue facts of classic rental orders (distinct rows).

    The bookings are written once; annotations and ledger lines of other orders are left out before they
    move (``operators.keybits``), and the confirmed ledger of these orders is written once.  A refund view
    given as a function of that ledger and the orders' bitmap is made from it.
    The bookings are made distinct with the result, once they are at their order, and so move once.
    """
    p, held = stored_with_bits(_classic_rental(po).select(
        "order_id", "uid", "group_id", "order_datetime_est", "group_created_est",
        "reservation_booking_id", "reservation_created", "email", "type",
        "last_possible_begin_date", "rental_begin_date", "po_category"), "order_id")
    af = may_meet(af, "order_id", held)
    made = not isinstance(refund_view, DataFrame)
    ledger = stage(confirmed_ledger(may_meet(fli, "order_id", held), fsh)
                   .select("order_id", "direction", "subtotal", "_conf", *(["group_id", "invoice_id", "total"] if made else [])))
    if made:
        refund_view = refund_view(ledger, held)
    refund_view = may_meet(refund_view, "order_id", held)
    groups = af.select(F.col("order_id").alias("_ao"), "annotation_group").distinct()
    rp = replacements(af, ogr).select(F.col("order_id").alias("_ro"), F.col("group_id").alias("_rg"),
                                      "detail_value").distinct()
    rf = _refunds(ledger)
    vrf = refund_view.select(F.col("order_id").alias("_vo"), F.col("refund").alias("_vref")).distinct()
    x = (p.join(groups, p["order_id"] == groups["_ao"], "left")
         .join(rp, p["order_id"] == rp["_ro"], "left")
         .join(rf, p["order_id"] == rf["_fo"], "left")
         .join(vrf, p["order_id"] == vrf["_vo"], "left"))
    g, dv, has_po = F.col("annotation_group"), F.col("detail_value"), F.col("po_category").isNotNull()
    oid = F.col("order_id")
    return x.select(
        "order_id", "uid", "group_id", "order_datetime_est", "group_created_est",
        "reservation_booking_id", "reservation_created", "email", "type",
        "last_possible_begin_date", "rental_begin_date",
        F.col("_ro").alias("order_id_w_rplm"), "detail_value",
        F.coalesce(F.col("_refund"), F.lit(0)).cast("decimal(38,4)").alias("refund_amount"),
        F.coalesce(F.col("_vref"), F.lit(0)).cast("decimal(38,6)").alias("fli_credit_refund"),
        F.when(g == "RFF", oid).alias("fit_order_id"),
        F.when((g == "RFF") & (dv == "FIT"), oid).alias("rpl_fit_order_id"),
        F.when(g == "QUALITY_ISSUE", oid).alias("quality_order_id"),
        F.when((g == "QUALITY_ISSUE") & dv.like("%QUALITY%"), oid).alias("rpl_quality_order_id"),
        F.when(g == "SHIPPING", oid).alias("delivery_order_id"),
        F.when((g == "SHIPPING") & dv.isin(*DELIVERY_REPLACEMENT_REASONS), oid).alias("rpl_delivery_order_id"),
        F.when(has_po, oid).alias("po_order_id"),
        F.when(has_po, F.col("group_id")).alias("po_group_id"),
        F.when(has_po & dv.like("%PO%"), F.col("_ro")).alias("rpl_po_order_id"),
        F.when(has_po & dv.like("%PO%"), F.col("_rg")).alias("rpl_po_group_id"),
    ).distinct()


def issue_rollup(ooi: DataFrame) -> DataFrame:
    """One row per (order, uid, begin date, email, reason, refund) with max-collapsed ids."""
    keys = ["order_id", "uid", "rental_begin_date", "email", "detail_value"]
    return (ooi.withColumn("refund_amount", F.coalesce(F.col("refund_amount"), F.lit(0)).cast("decimal(38,4)"))
            .groupBy(*keys, "refund_amount")
            .agg(F.countDistinct("group_id").alias("group_cnt"),
                 F.max("order_id_w_rplm").alias("rpl_order_id"),
                 F.max("fit_order_id").alias("fit_order_id"),
                 F.max("quality_order_id").alias("quality_order_id"),
                 F.max("delivery_order_id").alias("delivery_order_id"),
                 F.max("po_order_id").alias("po_order_id"),
                 F.max("rpl_fit_order_id").alias("rpl_fit_order_id"),
                 F.max("rpl_quality_order_id").alias("rpl_quality_order_id"),
                 F.max("rpl_delivery_order_id").alias("rpl_delivery_order_id"),
                 F.max(F.when(F.col("rpl_po_group_id") != F.col("po_group_id"),
                              F.col("po_order_id"))).alias("rpl_po_order_id")))


def issue_summary(rollup: DataFrame, dates: DataFrame, orderdata: DataFrame) -> DataFrame:
    """Rollup + calendar of the begin date + order rank + issue category (PO > delivery > quality > fit)."""
    cal = dates.select("asofdate", "fiscal_week_start", "fiscal_month_start", "fiscal_year")
    nth = orderdata.select(F.col("order_id").alias("_oo"), "nth_order").distinct()
    x = (on_calendar(rollup, cal, "rental_begin_date")
         .join(nth, rollup["order_id"] == nth["_oo"], "left"))
    cat = (F.when(F.col("po_order_id").isNotNull(), "PO")
           .when(F.col("delivery_order_id").isNotNull(), "Delivery")
           .when(F.col("quality_order_id").isNotNull(), "Quality")
           .when(F.col("fit_order_id").isNotNull(), "Fit")
           .otherwise("non_PO"))
    return x.select(*[rollup[c] for c in rollup.columns], "asofdate", "fiscal_week_start",
                    "fiscal_month_start", "fiscal_year", "nth_order",
                    F.coalesce(rollup["refund_amount"], F.lit(0)).cast("decimal(38,4)").alias("fli_credit_refund"),
                    cat.alias("order_issue_category")).distinct()


_ISSUE_COLS = {
    "po": ("PO", "po_order_id", "rpl_po_order_id"),
    "quality": ("QUALITY", "quality_order_id", "rpl_quality_order_id"),
    "fit": ("FIT", "fit_order_id", "rpl_fit_order_id"),
}


def loyalty(summary: DataFrame, ogr: DataFrame, issue: str | None = None,
            horizons=HORIZONS) -> DataFrame:
    """Distinct later orders of the customer within each horizon of the rental begin date.

    ``issue=None`` labels rows with the issue category and any-replacement flag;
    ``issue in {"po", "quality", "fit"}`` labels them for that issue only.
    """
    nn = F.col
    if issue is None:
        label = nn("order_issue_category").alias("order_issue_category")
        rpl = ((nn("po_order_id").isNotNull() & nn("rpl_po_order_id").isNotNull())
               | (nn("delivery_order_id").isNotNull() & nn("rpl_delivery_order_id").isNotNull())
               | (nn("quality_order_id").isNotNull() & nn("rpl_quality_order_id").isNotNull())
               | (nn("fit_order_id").isNotNull() & nn("rpl_fit_order_id").isNotNull()))
    else:
        tag, col, rcol = _ISSUE_COLS[issue]
        label = F.when(nn(col).isNotNull(), tag).otherwise(f"NON_{tag}").alias("order_issue")
        rpl = nn(col).isNotNull() & nn(rcol).isNotNull()
    base = summary.select(
        "uid", "email", "rental_begin_date", label,
        F.when(rpl, "W. Replacement").otherwise("No Replacement").alias("replacement_flg"),
        "nth_order",
        F.when(nn("refund_amount") == 0, "no_refund").otherwise("refund").alias("refund_flg"),
    ).distinct()
    base = stage(base)
    hz = horizon_counts(base, ogr, "uid", "rental_begin_date", "order_id", "order_datetime_est", horizons)
    out = base.join(hz, ["uid", "rental_begin_date"], "left")
    return out.select(*base.columns, *[F.coalesce(F.col(f"orders_in_{n}d"), F.lit(0)).cast("bigint")
                                       .alias(f"orders_in_{n}d") for n in horizons])


def unreplaced_orders(ogr: DataFrame, af: DataFrame, dates: DataFrame, week_from: str,
                      zone: int = 2, begin_gap_days: int = -1) -> DataFrame:
    """Subscription rental bookings in a shipping zone whose group got no replacement."""
    rpl = replacements(af, ogr).select(F.col("group_id").alias("_rg")).filter(F.col("_rg").isNotNull()).distinct()
    cal = dates.select("asofdate", "fiscal_week_start")
    x = (ogr.filter((F.col("order_type") == "QUEUE") & (F.col("merchandise_category") == "RENTAL")
                    & (F.col("ups_ground_shipping_zone") == zone)
                    & (F.datediff("last_possible_begin_date", "rental_begin_date") == begin_gap_days))
         .join(rpl, F.col("group_id") == F.col("_rg"), "left_anti"))
    x = on_calendar(x, cal, "order_datetime_est").filter(F.col("fiscal_week_start") >= F.lit(week_from).cast("date"))
    return (x.select("fiscal_week_start", "order_datetime_est", "order_id", "group_id",
                     "rental_begin_date", "last_possible_begin_date", "ups_ground_shipping_zone")
            .distinct().orderBy(F.col("fiscal_week_start").desc()))


def profile_contact_methods(af: DataFrame) -> DataFrame:
    return (af.filter(F.col("annotation_group").isin("SHIPPING", "RFF", "QUALITY_ISSUE")
                      & F.col("detail_name").isin("reason", "fitOverall")
                      & (F.col("contact_method") != "AUTOMATED"))
            .select("contact_method").distinct())


def profile_coverage(af: DataFrame, po: DataFrame) -> DataFrame:
    """Time coverage of fit annotations joined to classic rental bookings on the order id.

    min/max over the join equal min/max over each side restricted to orders present on the other
    side: both sides are stacked and reduced to one row per order before they move, and orders of
    one side only are left out then.  Nothing is joined or sorted.
    """
    a = af.filter((F.col("annotation_group") == "RFF") & F.col("detail_name").isin("reason", "fitOverall")
                  & (F.col("annotation_target") == "BOOKING"))
    p = po.filter((F.col("order_type") == "CLASSIC") & (F.col("merchandise_category") == "RENTAL")
                  & exclude_prefix_digits("sku", SPECIAL_SKU_PREFIXES))
    no_time = F.lit(None).cast("timestamp_ntz")
    both = (a.select("order_id", F.lit(1).alias("_a"), F.lit(0).alias("_p"), F.col("transaction_created").alias("_tc"),
                     no_time.alias("_od"))
            .unionByName(p.select("order_id", F.lit(0).alias("_a"), F.lit(1).alias("_p"), no_time.alias("_tc"),
                                  F.col("order_datetime_est").alias("_od")))
            .filter(F.col("order_id").isNotNull()))
    per_order = both.groupBy("order_id").agg(F.max("_a").alias("_a"), F.max("_p").alias("_p"), F.min("_tc").alias("_lo"),
                                             F.max("_tc").alias("_hi"), F.max("_od").alias("_od"))
    return per_order.filter((F.col("_a") == 1) & (F.col("_p") == 1)).agg(
        F.max("_hi").alias("max_transaction_created"), F.min("_lo").alias("min_transaction_created"),
        F.max("_od").alias("max_order_datetime_est"))


def profile_shipping_orders(af: DataFrame) -> DataFrame:
    return (af.filter((F.col("annotation_group") == "SHIPPING") & (F.col("annotation_target") == "BOOKING")
                      & F.col("detail_name").isin("reason", "fitOverall"))
            .agg(F.countDistinct("order_id").alias("order_cnt")))


def profile_latest_order(af: DataFrame, po: DataFrame) -> DataFrame:
    """Latest order time of classic rental bookings that a fit annotation names as its booking (a semi-join)."""
    a = af.filter((F.col("annotation_group") == "RFF") & (F.col("annotation_target") == "BOOKING")).select("annotation_id")
    p = po.filter((F.col("order_type") == "CLASSIC") & (F.col("merchandise_category") == "RENTAL")
                  & exclude_prefix_digits("sku", SPECIAL_SKU_PREFIXES))
    return (p.join(a, p["reservation_booking_id"] == a["annotation_id"], "left_semi")
            .agg(F.max("order_datetime_est").alias("max_order_datetime_est")))


def profile_replacement_reasons(af: DataFrame) -> DataFrame:
    """The reasons given for replacements."""
    return (af.filter((F.col("annotation_group") == "REPLACEMENT") & (F.col("detail_name") == "reason"))
            .select("annotation_group", "detail_value").distinct().orderBy("annotation_group"))
