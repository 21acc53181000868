"""Registered queries: each binds the driver tables and runs one report.

Parameters that the analyses hard-code for their own calendar (report dates,
look-back anchors) are set here to the span of the test data; the plan
functions keep them as explicit arguments.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from .plans import (ageing, cart, leakage, order_issues as oi, problem_orders as po,
                    replacements as rp, reservations as rs, tax, wcr)
from .operators import stage
from .operators.keybits import key_bits, may_meet
from .operators.profile import profile_columns
from .operators.seqlog import next_state
from .session import ensure_checkpoint_dir
from .sources.sinks import publish
from .sources.bindings import INTERNAL_DOMAIN, Warehouse

# Fixed "today" for the two halves of the test data (events: Jan 2024;
# orders: 1995-2001).  The analyses use CURRENT_DATE / getdate() instead.
AS_OF_EVENTS = "2024-02-01"
AS_OF_ORDERS = "2001-09-01"
IDLE_SINCE = "2017-01-01"
MIN_FISCAL_YEAR = 1997
UNREPLACED_WEEK_FROM = "1999-05-10"
ANNOTATION_COLUMNS = ("annotation_group", "annotation_target", "detail_name", "detail_value", "contact_method", "order_id")


_WAREHOUSES: dict = {}


def materialize_warehouse(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Store every binding of ``sf_dir`` under the session's checkpoint folder.

    Used by the bench so timings measure the analyses over stored warehouse
    tables rather than the synthetic derivation of those tables.
    """
    import uuid

    from .oracle.bindings_sql import BINDINGS
    from .session import ensure_checkpoint_dir
    wh = _wh(spark, sf_dir)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warehouse-{uuid.uuid4().hex[:8]}"
    names = [n for n in BINDINGS if hasattr(Warehouse, n)]
    return wh.materialize(names, folder)


def _wh(spark: SparkSession, sf_dir: str, merged: bool = False) -> Warehouse:
    """One Warehouse per (session, directory, merged or not): bindings are built and analysed once.
    Stored bindings join nothing, so that they serve both."""
    if merged and _wh(spark, sf_dir).stored:
        merged = False
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, merged)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = Warehouse(spark, sf_dir, merged)
    return _WAREHOUSES[key]


def _cart_wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return _wh(spark, sf_dir, merged=True)


def q_ageing_bins(spark, sf_dir) -> DataFrame:
    wh = _wh(spark, sf_dir)
    return ageing.ageing_report(wh.inventory_unit, wh.dates, as_of=AS_OF_EVENTS, idle_since=IDLE_SINCE)


def q_published_ageing(spark, sf_dir) -> DataFrame:
    """The ageing report published by site under the shared checkpoint folder, read back from there."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/published-{spark.sparkContext.applicationId}/ageing"
    report = q_ageing_bins(spark, sf_dir)
    publish(report, path=path, partition_by=["cur_location_site"])
    return spark.read.schema(report.schema).parquet(path).select(*report.columns)


def q_next_state(spark, sf_dir) -> DataFrame:
    wh = _wh(spark, sf_dir)
    return next_state(wh.inventory_unit, as_of=AS_OF_EVENTS)


def q_idle_days(spark, sf_dir) -> DataFrame:
    wh = _wh(spark, sf_dir)
    ns = next_state(wh.inventory_unit, as_of=AS_OF_EVENTS)
    return ageing.expand_days(ageing.idle_stretches(ns, IDLE_SINCE), wh.dates, AS_OF_EVENTS)


def _refund_view(wh, ledger=None, orders=None):
    asked = (lambda rows: rows if orders is None else may_meet(rows, "order_id", orders))
    return oi.refund_delta(wh.financial_line_item, wh.fli_status_history,
                           asked(wh.holding(orders=orders).invoice_order), asked(wh.uc_orders),
                           wh.order_group_reservation, wh.dates,
                           internal_domain=INTERNAL_DOMAIN, min_fiscal_year=MIN_FISCAL_YEAR, ledger=ledger)


def _order_issues(wh):
    return oi.order_issues(wh.ogr_po, wh.yp_autumn_full, _reserved(wh), wh.financial_line_item, wh.fli_status_history,
                           lambda ledger, orders: _refund_view(wh, ledger, orders))


def _rollup(wh):
    return oi.order_rollup(wh.ogr_po, wh.yp_autumn_full, wh.order_group_reservation, wh.financial_line_item,
                           wh.fli_status_history)


def _summary(wh):
    return oi.issue_summary(_rollup(wh), wh.dates, wh.v_ot_orderdata)


def q_refund_delta(spark, sf_dir):
    return _refund_view(_wh(spark, sf_dir))


def q_order_issues(spark, sf_dir):
    return _order_issues(_wh(spark, sf_dir))


def q_issue_rollup(spark, sf_dir):
    return _rollup(_wh(spark, sf_dir))


def q_issue_summary(spark, sf_dir):
    return _summary(_wh(spark, sf_dir))


def _loyalty(issue):
    def q(spark, sf_dir):
        wh = _wh(spark, sf_dir)
        return oi.loyalty(_summary(wh), wh.order_group_reservation, issue=issue)
    return q


def q_unreplaced(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return oi.unreplaced_orders(wh.order_group_reservation, wh.yp_autumn_full, wh.dates,
                                week_from=UNREPLACED_WEEK_FROM)


def q_profile_contact(spark, sf_dir):
    return oi.profile_contact_methods(_wh(spark, sf_dir).yp_autumn_full)


def q_profile_coverage(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return oi.profile_coverage(wh.yp_autumn_full, wh.ogr_po)


def q_profile_orders(spark, sf_dir):
    return oi.profile_shipping_orders(_wh(spark, sf_dir).yp_autumn_full)


def q_profile_latest_order(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return oi.profile_latest_order(wh.yp_autumn_full, wh.ogr_po)


def q_profile_reasons(spark, sf_dir):
    return oi.profile_replacement_reasons(_wh(spark, sf_dir).yp_autumn_full)


def q_profile_columns(spark, sf_dir):
    """Rows, nulls, distinct values and range of the annotation columns, in one pass."""
    return profile_columns(_wh(spark, sf_dir).yp_autumn_full, list(ANNOTATION_COLUMNS))


def _issue_view(wh, variant):
    return rp.issue_replacements(wh.ogr_po, wh.yp_autumn_full, wh.order_group_reservation,
                                 wh.barcode_sku_style_type, variant=variant)


def q_issue_replacements(spark, sf_dir):
    return _issue_view(_wh(spark, sf_dir), "rpl")


def q_same_style_share(spark, sf_dir):
    return rp.same_style_share(_issue_view(_wh(spark, sf_dir), "style"), AS_OF_ORDERS)


def q_recent_issues(spark, sf_dir):
    return rp.recent_delivery_issues(_issue_view(_wh(spark, sf_dir), "style"), AS_OF_ORDERS)


def q_replacement_weekday(spark, sf_dir):
    return rp.replacement_by_weekday(_wh(spark, sf_dir).v_ci_oi_resolution_report, AS_OF_ORDERS)


AVL_YEARS = (1995, 1996, 1997, 1998)
MIN_AVL_YEAR = 1990


def _revenue(wh):
    return wcr.sku_month_revenue(wh.profitability_sku_monthly_revenue_cogs, wh.products,
                                 wcr.replenishment_styles(wh.master_replenish_style, wh.products_master), MIN_AVL_YEAR)


def _cohort(wh):
    return wcr.sku_cohort(_revenue(wh), AVL_YEARS)


def q_sku_revenue(spark, sf_dir):
    return _revenue(_wh(spark, sf_dir))


def q_sku_cohort(spark, sf_dir):
    return _cohort(_wh(spark, sf_dir))


def q_wcr_cumulative(spark, sf_dir):
    return wcr.wcr(_cohort(_wh(spark, sf_dir)))


CART_LO, CART_HI = "2024-01-01", "2024-02-01"
CONVERSION_LO, CONVERSION_HI = "2024-01-05", "2024-02-01"
SWITCH_BEGIN_FROM = "2024-01-01"
FIRST_LAST_LO, FIRST_LAST_HI = "2024-01-05", "2024-01-12"


def _cart(wh):
    return cart.cart_bookings(wh.reservation_booking, wh.users,
                              lambda held: wh.holding(bookings=held).reservation_booking_detail,
                              lambda held: wh.holding(bookings=held).order_group_reservation,
                              wh.uc_orders, wh.products_master_iid,
                              wh.size_scales, wh.product_prices, CART_LO, CART_HI)


def _sessions(wh):
    return cart.cart_sessions(_cart(wh), wh.dates, BOT_UIDS)


def q_cart_bookings(spark, sf_dir):
    return _cart(_cart_wh(spark, sf_dir))


def q_cart_sessions(spark, sf_dir):
    return _sessions(_cart_wh(spark, sf_dir))


def q_bookings_per_week(spark, sf_dir):
    wh = _cart_wh(spark, sf_dir)
    return cart.bookings_per_week(wh.reservation_booking, wh.dates)


def q_cart_conversion(spark, sf_dir):
    wh = _cart_wh(spark, sf_dir)
    return cart.cart_conversion(_sessions(wh), cart.bookings_per_week(wh.reservation_booking, wh.dates),
                                wh.dates, CONVERSION_LO, CONVERSION_HI)


def q_log_coverage(spark, sf_dir):
    wh = _cart_wh(spark, sf_dir)
    return cart.log_coverage(_cart(wh), wh.products_master_iid, wh.pixel_raw2)


def q_log_missing(spark, sf_dir):
    return cart.log_missing(q_log_coverage(spark, sf_dir))


def q_user_devices(spark, sf_dir):
    wh = _cart_wh(spark, sf_dir)
    return cart.user_devices(_sessions(wh), wh.pixel_raw2, wh.browser_device, wh.devices, wh.uc_orders)


def q_session_devices(spark, sf_dir):
    wh = _cart_wh(spark, sf_dir)
    return cart.session_devices(_sessions(wh), wh.pixel_raw2, wh.browser_device, wh.devices)


def q_first_last_device(spark, sf_dir):
    wh = _cart_wh(spark, sf_dir)
    return cart.first_last_device(_sessions(wh), wh.pixel_raw2, wh.browser_device, wh.devices,
                                  FIRST_LAST_LO, FIRST_LAST_HI)


def q_action_devices(spark, sf_dir):
    wh = _cart_wh(spark, sf_dir)
    return cart.action_devices(_sessions(wh), wh.pixel_raw2, wh.browser_device, wh.devices)


def _switch(wh):
    dc = cart.device_checkout(wh.browser_orders, wh.order_group_reservation, wh.reservation_booking,
                              wh.browser_device, wh.devices, SWITCH_BEGIN_FROM)
    return wh.pixel_raw2, wh.products_master_iid, dc, wh.browser_device, wh.devices


def q_profile_cart(spark, sf_dir):
    wh = _cart_wh(spark, sf_dir)
    return cart.profile_cart(_cart(wh), _sessions(wh), wh.devices)


def q_device_switch(spark, sf_dir):
    return cart.device_switch(*_switch(_cart_wh(spark, sf_dir)))


def q_device_switch_summary(spark, sf_dir):
    return cart.device_switch_summary(*_switch(_cart_wh(spark, sf_dir)))


def _unit_loc(wh):
    return rs.unit_location(wh.inventory_unit, wh.inventory_unit_seq)


def _canceled_temp(wh):
    return rs.reservation_fact(
        wh.uc_orders, wh.users, lambda orders: wh.holding(orders=orders).order_groups, lambda groups: wh.holding(groups=groups).reservation_booking,
        lambda held: wh.holding(bookings=held).reservation_booking_detail,
        wh.products_iid, wh.products, wh.fulfillment, wh.fulfillment_seq,
        rs.barcode_unit_match(wh.inventory_history), wh.reservation_fulfillment,
        rs.transit_fallback(wh.shipping_method_time), wh.queue_rf_end_date_consolidation,
        rs.unit_barcode_lookup(wh.inventory_unit), _unit_loc(wh))


def _canceled(wh):
    return rs.unit_usage(_canceled_temp(wh))


def _reserved(wh):
    return lambda held: wh.holding(bookings=held).order_group_reservation


def _extras(wh, ogr=None, held=None):
    return rs.reservation_extras(_reserved(wh) if ogr is None else ogr, wh.fulfillment, wh.fulfillment_seq,
                                 lambda near: wh.holding(bookings=near).reservation_booking,
                                 wh.products_iid, wh.products, rs.unit_barcode_lookup(wh.inventory_unit),
                                 _unit_loc(wh), held)


def q_last_two_status(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return rs.last_two_status(wh.fulfillment, wh.fulfillment_seq)


def q_transit_fallback(spark, sf_dir):
    return rs.transit_fallback(_wh(spark, sf_dir).shipping_method_time)


def q_unit_maps(spark, sf_dir):
    return rs.barcode_unit_match(_wh(spark, sf_dir).inventory_history)


def q_unit_lookup(spark, sf_dir):
    return rs.unit_barcode_lookup(_wh(spark, sf_dir).inventory_unit)


def q_unit_location(spark, sf_dir):
    return _unit_loc(_wh(spark, sf_dir))


def q_reservation_fact(spark, sf_dir):
    return _canceled_temp(_wh(spark, sf_dir))


def q_unit_usage(spark, sf_dir):
    return _canceled(_wh(spark, sf_dir))


def q_return_shift(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return rs.return_shift(wh.reservation_booking, wh.reservation_booking_detail, wh.order_groups,
                           rs.transit_fallback(wh.shipping_method_time))


def q_tz_eastern(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return rs.eastern_order_times(wh.uc_orders, wh.order_groups)


def q_reservation_extras(spark, sf_dir):
    return _extras(_wh(spark, sf_dir))


#: What the subscription branch takes from reservations and from add-ons.
PO_COLS = [c for c in po.SUB_COLS if c not in ("child_sku", "cancel_flag")] + ["order_type"]


def _po_asked_classic(wh):
    return stage(po.classic_candidates(wh.autumn_report_raw_data, AS_OF_ORDERS))


def _po_asked_subscription(wh):
    # The branch's own, shorter look-back goes before the rows are written, as it would reach the scan without that.
    asked = po.subscription_candidates(wh.order_group_reservation, AS_OF_ORDERS)
    return stage(po.reported(asked, AS_OF_ORDERS).select(*PO_COLS))


def _po_extras(wh, *asked):
    """The add-on fact of the report's bookings; only they are looked up."""
    ids = reduce(DataFrame.unionAll, [a.select("reservation_booking_id") for a in asked])
    held = key_bits(ids, "reservation_booking_id")
    return _extras(wh, lambda near: _reserved(wh)(near).join(ids, "reservation_booking_id", "left_semi"), held).select(
        *PO_COLS, "child_sku")


def _po_classic(wh, asked, extras):
    return po.classic_rows(asked, wh.products_master_iid, extras, AS_OF_ORDERS, INTERNAL_DOMAIN)


def _po_subscription(wh, asked, extras):
    src = po.subscription_sources(_canceled(wh), asked, extras, AS_OF_ORDERS)
    return po.subscription_rows(src, wh.unlimited_po_sources, wh.products_master_iid, AS_OF_ORDERS, INTERNAL_DOMAIN)


def q_problem_orders_classic(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    asked = _po_asked_classic(wh)
    return _po_classic(wh, asked, _po_extras(wh, asked)).distinct()


def q_problem_orders_subscription(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    asked = _po_asked_subscription(wh)
    return _po_subscription(wh, asked, _po_extras(wh, asked)).distinct()


def q_problem_orders(spark, sf_dir):
    """Both branches look their add-ons up in one fact, written once; their rows are made distinct together."""
    wh = _wh(spark, sf_dir)
    classic, subscription = _po_asked_classic(wh), _po_asked_subscription(wh)
    extras = stage(_po_extras(wh, classic, subscription))
    return po.problem_orders(_po_classic(wh, classic, extras), _po_subscription(wh, subscription, extras))


LEAK_DETAIL_LO, LEAK_DETAIL_HI = "1998-01-25", "1998-02-21"
LEAK_LO, LEAK_HI = "1998-01-01", "1998-05-31"
LEAK_BEGIN_FROM = "1995-01-01"


def q_leakage_detail(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    prof = leakage.order_profile(wh.invoice_order, wh.invoice_group, wh.invoice_booking,
                                 wh.reservation_booking, wh.reservation_booking_detail)
    return leakage.leakage_detail(wh.financial_line_item, prof, wh.showroom_order, wh.showroom,
                                  LEAK_DETAIL_LO, LEAK_DETAIL_HI, LEAK_BEGIN_FROM)


def _leak(grain):
    def q(spark, sf_dir):
        wh = _wh(spark, sf_dir)
        return leakage.leakage_by_reason(wh.ow_transaction_summary, wh.financial_line_item, wh.v_ot_orderdata,
                                         wh.dates, LEAK_LO, LEAK_HI, LEAK_BEGIN_FROM, grain)
    return q


def q_tax_entries(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return tax.tax_entries(wh.order_groups, wh.uc_zones, wh.order_group_reservation,
                           wh.finance_current_view_inventory, wh.shipment, wh.dates)


BOT_UIDS = (11141040,)  # accounts of click bots
PREVIEW_ROWS = 200


def q_preview(spark, sf_dir):
    """First rows of the priced cart adds by booking id (a preview is a top-k)."""
    rows = _cart(_cart_wh(spark, sf_dir))
    return rows.orderBy("id", "price", *[c for c in rows.columns if c not in ("id", "price")]).limit(PREVIEW_ROWS)


QUERIES = {
    "q_ageing_bins": q_ageing_bins,
    "q_published_ageing": q_published_ageing,
    "q_next_state": q_next_state,
    "q_idle_days": q_idle_days,
    "q_refund_delta": q_refund_delta,
    "q_order_issues": q_order_issues,
    "q_issue_rollup": q_issue_rollup,
    "q_issue_summary": q_issue_summary,
    "q_loyalty_all": _loyalty(None),
    "q_loyalty_po": _loyalty("po"),
    "q_loyalty_quality": _loyalty("quality"),
    "q_loyalty_fit": _loyalty("fit"),
    "q_unreplaced": q_unreplaced,
    "q_profile_contact": q_profile_contact,
    "q_profile_coverage": q_profile_coverage,
    "q_profile_orders": q_profile_orders,
    "q_profile_latest_order": q_profile_latest_order,
    "q_profile_reasons": q_profile_reasons,
    "q_profile_columns": q_profile_columns,
    "q_issue_replacements": q_issue_replacements,
    "q_same_style_share": q_same_style_share,
    "q_recent_issues": q_recent_issues,
    "q_replacement_weekday": q_replacement_weekday,
    "q_sku_revenue": q_sku_revenue,
    "q_sku_cohort": q_sku_cohort,
    "q_wcr_cumulative": q_wcr_cumulative,
    "q_cart_bookings": q_cart_bookings,
    "q_cart_sessions": q_cart_sessions,
    "q_bookings_per_week": q_bookings_per_week,
    "q_cart_conversion": q_cart_conversion,
    "q_log_coverage": q_log_coverage,
    "q_log_missing": q_log_missing,
    "q_user_devices": q_user_devices,
    "q_session_devices": q_session_devices,
    "q_device_switch": q_device_switch,
    "q_device_switch_summary": q_device_switch_summary,
    "q_first_last_device": q_first_last_device,
    "q_action_devices": q_action_devices,
    "q_profile_cart": q_profile_cart,
    "q_last_two_status": q_last_two_status,
    "q_transit_fallback": q_transit_fallback,
    "q_unit_maps": q_unit_maps,
    "q_unit_lookup": q_unit_lookup,
    "q_unit_location": q_unit_location,
    "q_reservation_fact": q_reservation_fact,
    "q_unit_usage": q_unit_usage,
    "q_reservation_extras": q_reservation_extras,
    "q_return_shift": q_return_shift,
    "q_tz_eastern": q_tz_eastern,
    "q_problem_orders_classic": q_problem_orders_classic,
    "q_problem_orders_subscription": q_problem_orders_subscription,
    "q_problem_orders": q_problem_orders,
    "q_leakage_detail": q_leakage_detail,
    "q_leakage_calendar": _leak("calendar"),
    "q_leakage_fiscal": _leak("fiscal"),
    "q_tax_entries": q_tax_entries,
    "q_preview": q_preview,
}
