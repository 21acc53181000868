"""Reservation facts for subscription orders and for add-on ("extra") items.

last_two_status       newest two fulfillment statuses, previous status per booking
transit_fallback      transit days per ZIP: ground, else carrier, else 5
unit_maps             barcode -> newest unit id; distinct (unit id, barcode) pairs
unit_location         newest scan of every unit (pointer-table join)
reservation_fact      wide fact of subscription bookings of canceled / paid orders
shift_return_date     return date adjusted for transit time and begin weekday
unit_usage            usage rank and total per physical unit
reservation_extras    the same fact for add-on items

Windows that the analyses run per group or per unit (dresses per group,
usage rank per unit) are computed as grouped aggregates joined back, so a
large group is pre-aggregated map-side instead of landing whole in one
window task; the previous-status LAG is split by day for bookings with many
rows (see ``operators.seqlog.shift_split``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.temporal import day_boundaries, epoch_to_ntz, to_eastern
from ..operators import stage
from ..operators.keybits import Asked, KeyBits, asked, key_bits, may_meet, stored_with_bits
from ..operators.seqlog import current_row, heavy_slots, last_k_by_seq, null_safe_keys, shift_split

# Fixed values of the analysis.
GROUND_METHOD = 2
CARRIER_METHOD = 6
DEFAULT_TRANSIT_DAYS = 5
ORDER_STATUSES = ("canceled", "payment_received")
LIMBO = "ITEM_LIMBO"
BARCODE_LENGTH = 8


def last_two_status(fulfillment: DataFrame, fulfillment_seq: DataFrame, rb: DataFrame | None = None,
                    extras_only: bool = False, wanted: DataFrame | None = None,
                    held: KeyBits | None = None) -> DataFrame:
    """The newest two status rows of every fulfillment with the previous status of the booking.

    The previous status is LAG over the *booking* ordered by time (it can come
    from another fulfillment of the booking, as in the analysis).  With ``wanted``
    (booking_id) only the log of those bookings is read.  With ``held``, the bitmap of the wanted
    bookings, other bookings' rows are left out before they move, as are the pointers of fulfillments left out.
    The bookings' rows ``rb`` are joined when the log is in their order, for its window.
    """
    f = fulfillment.filter(F.col("child_sku").isNotNull()) if extras_only else fulfillment
    if held is not None:
        f = may_meet(f, "booking_id", held)
    if held is not None or extras_only:
        fulfillment_seq = may_meet(fulfillment_seq, "fulfillment_id", key_bits(f, "id"))
    heavy = heavy_slots(f, ["booking_id"])
    if wanted is not None:
        f = f.join(wanted, "booking_id", "left_semi")
    cols = [F.col("booking_id"), F.col("id").alias("fulfillment_id")]
    x = last_k_by_seq(f, fulfillment_seq, k=2, key="id", seq="seq", ptr_key="fulfillment_id", ptr_seq="seq")
    if rb is not None:
        r = rb.select(F.col("id").alias("_rbid"), F.col("sku"))
        x = x.join(r, x["booking_id"] == r["_rbid"], "inner").drop("_rbid")
        cols += ["sku", "child_sku"]
    x = shift_split(x, ["booking_id"], ["updated_on", "id", "seq"],
                    {"last2nd_fulfillment_status": "status", "_prev_on": "updated_on"},
                    "lag", F.to_date("updated_on"), heavy)
    return x.select(*cols,
                    F.col("status").alias("last_fulfillment_status"), "barcode",
                    to_eastern("updated_on").alias("last_fulfillment_updated_on"),
                    F.col("seq").alias("fulfillment_seq"), "last_seq",
                    "last2nd_fulfillment_status", to_eastern("_prev_on").alias("last2nd_fulfillment_updated_on")
                    ).withColumnRenamed("last_seq", "last_fulfillment_seq")


def transit_fallback(smt: DataFrame, default_days: int = DEFAULT_TRANSIT_DAYS) -> DataFrame:
    zips = smt.select("destination_zip_code").distinct()
    car = smt.filter(F.col("shipping_method_id") == CARRIER_METHOD).select(
        F.col("destination_zip_code").alias("_cz"), F.col("transit_days").alias("_car"))
    gnd = smt.filter(F.col("shipping_method_id") == GROUND_METHOD).select(
        F.col("destination_zip_code").alias("_gz"), F.col("transit_days").alias("_gnd"))
    return (zips.join(car, zips["destination_zip_code"] == car["_cz"], "left")
            .join(gnd, zips["destination_zip_code"] == gnd["_gz"], "left")
            .select("destination_zip_code",
                    F.coalesce("_gnd", "_car", F.lit(default_days)).cast("bigint").alias("transit_days")))


def barcode_unit_match(inventory_history: DataFrame) -> DataFrame:
    return inventory_history.groupBy("barcode").agg(F.max("unit_id").alias("id"))


def unit_barcode_lookup(inventory_unit: DataFrame) -> DataFrame:
    return inventory_unit.select("id", "barcode").distinct()


def unit_location(inventory_unit: DataFrame, inventory_unit_seq: DataFrame) -> DataFrame:
    return current_row(inventory_unit, inventory_unit_seq).select(
        "id", "barcode", "status", "action", "location_station", "updated_on", "sku")


def _units_by_barcode(unit_lookup: DataFrame, unit_loc: DataFrame) -> DataFrame:
    """The units of each barcode with their newest scan, put together before bookings meet them:
    the bookings then move for the barcode only, not for the unit id as well."""
    iul = unit_lookup.select(F.col("barcode").alias("_iulbc"), F.col("id").alias("_iulid"))
    iull = unit_loc.select(F.col("id").alias("_locid"), F.col("status").alias("unit_current_status"),
                           F.col("action").alias("unit_last_action"),
                           F.col("location_station").alias("unit_current_location"),
                           F.col("updated_on").alias("unit_last_updated_on"))
    return iul.join(iull, iul["_iulid"] == iull["_locid"], "left").drop("_iulid")


def shift_return_date(transit, begin_ts, end_ts, expected_begin, expected_end):
    """Expected return date moved for short transit and 3-day rentals by begin weekday (1 = Sunday)."""
    three_day = day_boundaries(begin_ts, end_ts) == 3
    dow = F.dayofweek(expected_begin)
    return (F.when((transit == 1) & three_day & (dow != 2), F.date_sub(expected_end, 1))
            .when((transit >= 2) & three_day & (dow == 7), F.date_add(expected_end, 2))
            .when((transit >= 2) & three_day & (dow == 2), F.date_add(expected_end, 1))
            .otherwise(expected_end))


#: What the fact takes from orders, their customer and group, and from bookings.
FACT_ORDER_COLS = ["uid", "order_id", "created", "billing_postal_code", "order_status", "order_type", "mail",
                   "user_create_date", "group_id", "delivery_postal_code", "_gcreated"]
FACT_BOOKING_COLS = ["id", "creation_date", "expected_begin_date", "expected_end_date", "earliest_possible_begin_date",
                     "last_possible_begin_date", "primary_booking_id"]


def reservation_fact(uco: DataFrame, users: DataFrame, rog: Asked, rb: Asked, rbd: Asked,
                     products_iid: DataFrame, products: DataFrame, fulfillment: DataFrame,
                     fulfillment_seq: DataFrame, unit_match: DataFrame, rf: DataFrame, transit: DataFrame,
                     qrf: DataFrame, unit_lookup: DataFrame, unit_loc: DataFrame) -> DataFrame:
    """Wide fact of active subscription bookings of canceled or paid orders (distinct rows).

    Groups of qualifying orders and their bookings are written once each; order groups, bookings, their
    details and the fulfillment log leave rows of other orders out before they move (``operators.keybits``);
    bookings and details given as views are asked for the rows of those groups and bookings.
    The log is then reduced to the bookings (semi-join); the status LAG is partitioned by booking, so this
    is exact and keeps the status window off every other booking.
    """
    o = uco.filter(F.col("order_status").isin(*ORDER_STATUSES) & (F.col("order_type") == "QUEUE"))
    u = users.select(F.col("uid").alias("_uuid"), "mail", F.col("create_date").alias("user_create_date"))
    pi = products_iid.select(F.lower("sku").alias("_pisku"), F.col("style"))
    p = products.select(F.col("style").alias("_pstyle"), F.col("type").alias("product_type"))
    wanted = key_bits(o, "order_id")
    g = asked(rog, wanted).select(F.col("order_id").alias("_goid"), "group_id", F.col("postal_code").alias("delivery_postal_code"),
                                  F.col("created_at").alias("_gcreated"))
    g = may_meet(g, "_goid", wanted)
    ordered, groups = stored_with_bits(o.join(u, o["uid"] == u["_uuid"], "inner")
                                       .join(g, o["order_id"] == g["_goid"], "inner").select(*FACT_ORDER_COLS), "group_id")
    r = (may_meet(asked(rb, groups).filter((F.col("status") == 1) & (F.col("type") == 0)), "order_group_id", groups)
         .select("order_group_id", F.col("merchandise_category").alias("_mc"), F.col("sku").alias("_rbsku"), *FACT_BOOKING_COLS))
    # Bookings meet their products, and the log's rows their units, while they are narrow.
    r = (r.join(pi, F.lower(F.col("_rbsku")) == pi["_pisku"], "inner")
         .join(p, F.col("style") == p["_pstyle"], "inner").drop("_pisku", "_pstyle"))
    booked = stage(ordered.join(r, F.col("group_id") == F.col("order_group_id"), "inner").drop("order_group_id"))
    held = key_bits(booked, "id")
    d = asked(rbd, held).select(F.col("reservation_booking_id").alias("_dbid"), F.col("rental_begin_date").alias("_rbd"),
                                F.col("rental_end_date").alias("_red"), F.col("customer_shipment_date").alias("_csd"),
                                F.col("warehouse_received_date").alias("_wrd"), F.col("item_available_date").alias("_iad"))
    last_status = last_two_status(fulfillment, fulfillment_seq, wanted=booked.select(F.col("id").alias("booking_id")), held=held)
    f = last_status.filter(F.col("fulfillment_seq") == F.col("last_fulfillment_seq")).select(
        F.col("booking_id").alias("_fbid"), "barcode", "fulfillment_id", "last_fulfillment_status",
        "last_fulfillment_updated_on", "last2nd_fulfillment_status", "last2nd_fulfillment_updated_on")
    ut = unit_match.select(F.col("barcode").alias("_utbc"), F.col("id").alias("unit_id"))
    rfe = rf.select(F.col("reservation_booking_id").alias("_rfbid"), F.col("end_date").alias("_rfend"))
    gz = transit.select(F.col("destination_zip_code").alias("_zip"), F.col("transit_days").alias("ups_ground_shipping_zone"))
    q = qrf.select(F.col("reservation_booking_id").alias("_qbid"), "new_rf_end_date")
    units = _units_by_barcode(unit_lookup, unit_loc).drop("_locid")
    d, rfe, q = may_meet(d, "_dbid", held), may_meet(rfe, "_rfbid", held), may_meet(q, "_qbid", held)
    f = f.join(ut, F.col("barcode") == ut["_utbc"], "left").join(units, F.col("barcode") == units["_iulbc"], "left")
    # Joins on one key follow each other, so that the wide rows move once for it; copies of the key stay behind.
    x = (booked.join(d, F.col("id") == d["_dbid"], "inner")
         .join(f, F.col("id") == f["_fbid"], "inner")
         .join(rfe, F.col("id") == rfe["_rfbid"], "left")
         .join(q, F.col("id") == q["_qbid"], "left")
         .join(F.broadcast(gz), F.col("delivery_postal_code") == gz["_zip"], "left")
         .withColumn("_aeed", shift_return_date(F.col("ups_ground_shipping_zone"), F.col("_rbd"), F.col("_red"),
                                                F.col("expected_begin_date"), F.col("expected_end_date")))
         .withColumns({c: F.to_date(to_eastern(c)) for c in ("_rbd", "_red", "_csd", "_wrd", "_iad")})
         .withColumn("_rfend", F.coalesce(F.col("new_rf_end_date"), F.to_date("_rfend")))
         .drop("_dbid", "_fbid", "_rfbid", "_qbid", "_zip", "_utbc", "_iulbc", "new_rf_end_date"))
    # Dresses per group: counted over the joined rows (before de-duplication), as a grouped count.  No row is
    # without a group (an inner join found it), and rows that met their count are made distinct where they are.
    dress = (F.col("product_type") == "D") & (F.col("last_fulfillment_status") != LIMBO)
    x = stage(x)
    x = x.join(x.groupBy("group_id").agg(F.count(F.when(dress, F.col("id"))).alias("dresses_in_group")), "group_id")
    return x.select(
        "uid", "order_id", to_eastern(epoch_to_ntz("created")).alias("order_datetime_est"),
        "billing_postal_code", "order_status", "order_type", "mail", "user_create_date", "group_id",
        "delivery_postal_code", to_eastern("_gcreated").alias("group_created_est"),
        "ups_ground_shipping_zone",
        F.col("id").alias("reservation_booking_id"), F.col("creation_date").alias("reservation_created"),
        "expected_begin_date", "expected_end_date",
        F.col("_aeed").alias("actual_expected_end_date"),
        "earliest_possible_begin_date", "last_possible_begin_date",
        F.col("_rbsku").alias("sku"), F.col("_mc").alias("merchandise_category"), "primary_booking_id",
        F.col("_rbd").alias("rental_begin_date"), F.col("_red").alias("rental_end_date"),
        F.col("_csd").alias("customer_shipment_date"), F.col("_wrd").alias("warehouse_received_date"),
        F.col("_iad").alias("item_available_date"),
        "style", "product_type", "barcode", "fulfillment_id", "last_fulfillment_status",
        "last_fulfillment_updated_on", "last2nd_fulfillment_status", "last2nd_fulfillment_updated_on",
        F.col("_rfend").alias("rf_end_date"),
        "unit_id", "dresses_in_group", "unit_current_status", "unit_last_action",
        "unit_current_location", "unit_last_updated_on",
    ).distinct()


def unit_usage(fact: DataFrame) -> DataFrame:
    """Usage rank (bookings of the unit begun on or before this one) and total per unit.

    Only rows of a unit have a rank, so rows without one, however many, take no part in any
    shuffle.  The others are counted per (unit, begin date); the running sum takes one row per
    unit and date, and the join back is on both, left to adaptive execution to split.
    """
    x = stage(fact)
    ok = F.col("unit_id").isNotNull() & (F.length("barcode") == BARCODE_LENGTH)
    per_day, nk = null_safe_keys(x.filter(F.col("unit_id").isNotNull()).groupBy("unit_id", "rental_begin_date").agg(
        F.count("reservation_booking_id").alias("_n")), ["rental_begin_date"])
    of_unit = Window.partitionBy("unit_id")
    upto = of_unit.orderBy(F.col("rental_begin_date").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranks = per_day.select(F.col("unit_id").alias("_unit"), *nk, F.sum("_n").over(upto).alias("_rank"),
                           F.sum("_n").over(of_unit).alias("_total"))
    used, _ = null_safe_keys(x.filter(ok), ["rental_begin_date"])
    used = used.join(ranks, [F.col("unit_id") == F.col("_unit"), *[used[c] == ranks[c] for c in nk]], "inner")
    cols = [F.col(c) for c in fact.columns]
    none = F.lit(None).cast("bigint")
    return used.select(*cols, F.col("_rank").cast("bigint").alias("unit_usage_rank"),
                       F.col("_total").cast("bigint").alias("unit_total_usage")).unionByName(
        x.filter(~F.coalesce(ok, F.lit(False))).select(*cols, none.alias("unit_usage_rank"), none.alias("unit_total_usage")))


EXTRA_OGR_COLS = ["uid", "order_id", "order_datetime_est", "billing_postal_code", "order_status", "order_type",
                  "mail", "user_create_date", "group_id", "delivery_postal_code", "ups_ground_shipping_zone",
                  "reservation_booking_id", "reservation_created", "expected_begin_date", "expected_end_date",
                  "actual_expected_end_date", "earliest_possible_begin_date", "last_possible_begin_date", "sku"]


def reservation_extras(ogr: Asked, fulfillment: DataFrame, fulfillment_seq: DataFrame, rb: Asked,
                       products_iid: DataFrame, products: DataFrame, unit_lookup: DataFrame,
                       unit_loc: DataFrame, held: KeyBits | None = None) -> DataFrame:
    """Bookings joined to the newest add-on fulfillment, its unit and the unit's last scan.

    Bookings without an add-on are left out before they move (``operators.keybits``).  Callers that need a
    subset of bookings pass it as ``ogr`` and its bitmap as ``held``: add-ons of other bookings then stay out of
    the status window, whole bookings at a time, so that it is exact; without ``held`` the last join drops them.
    """
    added = fulfillment.filter(F.col("child_sku").isNotNull())
    near = key_bits(added if held is None else may_meet(added, "booking_id", held), "booking_id")
    ogr = may_meet(asked(ogr, near), "reservation_booking_id", near)
    rb = may_meet(asked(rb, near), "id", near)
    last_status_extra = last_two_status(fulfillment, fulfillment_seq, rb=rb, extras_only=True, held=held)
    f = last_status_extra.filter(F.col("fulfillment_seq") == F.col("last_fulfillment_seq"))
    f = f.select(*[F.col(c).alias(f"f_{c}") for c in f.columns])
    pi = products_iid.select(F.lower("sku").alias("_pisku"), F.col("style").alias("_pistyle"))
    p = products.select(F.col("style").alias("_pstyle"))
    units = _units_by_barcode(unit_lookup, unit_loc).withColumnRenamed("_locid", "unit_id")
    # Products and units are the add-on's, so its narrow rows look for them and the wide bookings move once;
    # what these joins moved is off the disks before the bookings move.
    f = stage(f.join(pi, F.lower(f["f_sku"]) == pi["_pisku"], "inner")
              .join(p, F.col("_pistyle") == p["_pstyle"], "inner")
              .join(units, F.col("f_barcode") == units["_iulbc"], "left")
              .drop("_pisku", "_pistyle", "_pstyle", "_iulbc", "f_sku", "f_fulfillment_seq"))
    x = ogr.join(f, ogr["reservation_booking_id"] == f["f_booking_id"], "inner")
    return x.select(
        *[ogr[c] for c in EXTRA_OGR_COLS],
        F.col("f_child_sku").alias("child_sku"),
        ogr["merchandise_category"], ogr["primary_booking_id"], ogr["rental_begin_date"], ogr["rental_end_date"],
        ogr["customer_shipment_date"], ogr["warehouse_received_date"], ogr["item_available_date"],
        ogr["style"], ogr["product_type"], ogr["barcode"].alias("order_barcode"),
        F.col("f_barcode").alias("barcode"), F.col("f_fulfillment_id").alias("fulfillment_id"),
        F.col("f_last_fulfillment_status").alias("last_fulfillment_status"),
        F.col("f_last_fulfillment_updated_on").alias("last_fulfillment_updated_on"),
        F.col("f_last_fulfillment_seq").alias("last_fulfillment_seq"),
        F.col("f_last2nd_fulfillment_status").alias("last2nd_fulfillment_status"),
        F.col("f_last2nd_fulfillment_updated_on").alias("last2nd_fulfillment_updated_on"),
        "unit_id", ogr["dresses_in_group"], "unit_current_status", "unit_last_action",
        "unit_current_location", "unit_last_updated_on",
        ogr["rf_end_date"], ogr["unit_usage_rank"], ogr["unit_total_usage"])


def return_shift(rb: DataFrame, rbd: DataFrame, rog: DataFrame, transit: DataFrame) -> DataFrame:
    """Every order booking with its transit days and the shifted expected return date."""
    r = rb.filter(F.col("type") == 0).select("id", "order_group_id", "expected_begin_date", "expected_end_date")
    d = rbd.select(F.col("reservation_booking_id").alias("_dbid"), F.col("rental_begin_date").alias("_rbd"),
                   F.col("rental_end_date").alias("_red"))
    g = rog.select(F.col("group_id").alias("_gid"), F.col("postal_code").alias("_zip"))
    t = transit.select(F.col("destination_zip_code").alias("_tz"), F.col("transit_days").alias("transit_days"))
    x = (r.join(d, r["id"] == d["_dbid"], "inner")
         .join(g, r["order_group_id"] == g["_gid"], "inner")
         .join(F.broadcast(t), F.col("_zip") == t["_tz"], "left"))  # a row a ZIP: the bookings stay where they are
    return x.select(F.col("id").alias("reservation_booking_id"), "expected_begin_date", "expected_end_date",
                    "transit_days",
                    day_boundaries("_rbd", "_red").cast("bigint").alias("rental_days"),
                    shift_return_date(F.col("transit_days"), F.col("_rbd"), F.col("_red"),
                                      F.col("expected_begin_date"), F.col("expected_end_date"))
                    .alias("actual_expected_end_date"))


def eastern_order_times(uco: DataFrame, rog: DataFrame) -> DataFrame:
    """Order and order-group creation times in US Eastern wall clock (epoch seconds read as UTC)."""
    g = rog.select(F.col("order_id").alias("_goid"), "group_id", "created_at")
    x = uco.join(g, uco["order_id"] == g["_goid"], "inner")
    return x.select("order_id", "group_id", "created",
                    to_eastern(epoch_to_ntz("created")).alias("order_datetime_est"),
                    F.to_date(to_eastern(epoch_to_ntz("created"))).alias("order_date_est"),
                    to_eastern("created_at").alias("group_created_est"))
