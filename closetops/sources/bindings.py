"""Bindings: the driver's parquet tables re-shaped into the rental warehouse.

The analyses read ~45 warehouse tables (inventory scan log, fulfillment log,
bookings, ledger, click log, ...).  The test data is a TPC-H-like star plus an
``events`` log, so every warehouse table is *derived* here with plain Spark
expressions.  Each binding is a lazy DataFrame: columns nobody selects are
pruned by Catalyst, filters reach the parquet scan.

Derivation rules (mirrored one-for-one by ``closetops.oracle.bindings_sql``):

* events  -> inventory unit scan log, click log, cart bookings
* lineitem x orders x part x customer -> order-group reservations, ledger,
  fulfillment log, annotations, invoices, profitability fact
* part    -> product masters, size scales, price book
* supplier -> shipping-method transit times
* nation  -> tax zones, showrooms

Only the calendar, the 5 device kinds and the price-window grid are fixed-size
dimensions; everything else, models, units and browsers included, grows with the input.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keybits import KeyBits, may_meet
from .calendar import calendar

# Fixed values of the synthetic warehouse (shared with the SQL twin).
INTERNAL_DOMAIN = "staff.example.com"
PUBLIC_DOMAIN = "mail.example.org"
DEVICE_NAMES = ["Desktop", "Mobile", "Tablet", "App", "Suspected Bots"]
FULFILLMENT_STATUSES = ["RESERVED", "SHIPPED", "ITEM_LIMBO", "PROBLEM_ITEM",
                        "DELIVERED", "PROBLEM_IN_PROGRESS"]


def _s(c) -> Column:
    return c.cast("string") if isinstance(c, Column) else F.col(c).cast("string")


def barcode_expr(unit_seed: Column, slot: Column) -> Column:
    """8-digit unit barcode from a unit seed and a 0..3 slot."""
    return _s(F.lit(10000000) + (unit_seed * 7919917 + slot * 1299709) % 90000000)


def sku_expr(partkey: Column, size: Column) -> Column:
    """SS<p> / XX<n>_ONE SIZE|One Size for the two special families, else P<p>_<size>."""
    fam = partkey % 10
    n = F.floor(partkey / 10)
    xx = F.concat(F.lit("XX"), _s(n),
                  F.when(n % 2 == 0, F.lit("_ONE SIZE")).otherwise(F.lit("_One Size")))
    return (F.when(fam == 0, F.concat(F.lit("SS"), _s(partkey)))
            .when(fam == 1, xx)
            .otherwise(F.concat(F.lit("P"), _s(partkey), F.lit("_"), _s(size))))


def order_type_expr(priority: Column) -> Column:
    return (F.when(priority == "1-URGENT", "QUEUE")
            .when(priority == "5-LOW", "STORE_PICKUP")
            .when(priority == "4-NOT SPECIFIED", "CLASSIC_POSH")
            .otherwise("CLASSIC"))


def mail_expr(custkey: Column) -> Column:
    dom = F.when(custkey % 9 == 0, F.lit(INTERNAL_DOMAIN)).otherwise(F.lit(PUBLIC_DOMAIN))
    return F.concat(F.lit("user"), _s(custkey), F.lit("@"), dom)


def brand_no(brand: Column) -> Column:
    return F.substring(brand, 7, 4).cast("int")


def product_type_expr(brand: Column) -> Column:
    return F.when(brand_no(brand) % 4 == 0, F.lit("A")).otherwise(F.lit("D"))


def booking_id_expr() -> Column:
    """Unique booking key: the five lineitem columns that are unique together."""
    return F.concat_ws("-", _s("l_orderkey"), _s("l_linenumber"), _s("l_partkey"),
                       _s("l_suppkey"),
                       _s(F.datediff(F.to_date("l_shipdate"), F.lit("1970-01-01").cast("date"))))


def browser_expr(user: Column, seed: Column) -> Column:
    """Each user has three browsers."""
    return user * 3 + seed % 3


EVENT_ORDER_BASE = 1000000000


def hours(n) -> Column:
    n = n if isinstance(n, Column) else F.lit(n)
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def days(n) -> Column:
    n = n if isinstance(n, Column) else F.lit(n)
    return F.make_dt_interval(n.cast("int"))


class Warehouse:
    """Lazy, cached bindings over one scale-factor directory.

    With ``merged`` the orders and parts of the lines, which grow with the shop, are merged and
    never broadcast, however small their files are: for reports that need few of the lines.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, merged: bool = False,
                 bookings: KeyBits | None = None, groups: KeyBits | None = None, orders: KeyBits | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.merged = merged
        self.bookings, self.groups, self.orders = bookings, groups, orders
        self.stored = False

    def holding(self, bookings: KeyBits | None = None, groups: KeyBits | None = None,
                orders: KeyBits | None = None) -> Warehouse:
        """The bindings of single bookings (reservations, bookings and their details) without rows whose booking
        or order group is surely none of the bitmap's (``operators.keybits``), or invoices and order groups
        without those of other orders.

        Spark pushes no semi-join beneath a projection that computes its key, so the lines and events are
        left out here, before they move to their orders and parts.  A stored binding joins nothing.
        """
        if self.stored or not (bookings or groups or orders):
            return self
        part = Warehouse(self.spark, self.sf_dir, self.merged, bookings, groups, orders)
        part.__dict__["_parts"] = self._parts
        return part

    def _ordered(self, lines: DataFrame) -> DataFrame:
        return lines if self.orders is None else may_meet(lines, "l_orderkey", self.orders)

    def _asked(self, rows: DataFrame, booking: Column, group: Column) -> DataFrame:
        for key, held in ((booking, self.bookings), (group, self.groups)):
            if held is not None:
                rows = may_meet(rows.withColumn("_asked", key), "_asked", held).drop("_asked")
        return rows

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def materialize(self, names, folder: str) -> dict[str, float]:
        """Write each named binding once as parquet under ``folder`` and read it back.

        This turns the derived warehouse tables into stored tables (as the
        analyses' own inputs are), cutting their lineage; ``folder`` should be
        the cluster's shared checkpoint location.  Names are processed in
        order, so later bindings are derived from already-stored ones.
        """
        import time
        timings = {}
        for n in names:
            t0 = time.perf_counter()
            path = f"{folder.rstrip('/')}/{n}"
            getattr(self, n).write.mode("overwrite").parquet(path)
            self.__dict__[n] = self.spark.read.parquet(path)
            timings[n] = round(time.perf_counter() - t0, 3)
        self.stored = True
        return timings

    @cached_property
    def _parts(self) -> int:
        """The largest part key: models are as many as parts."""
        return int(self.raw("part").agg(F.max("p_partkey")).first()[0] or 1)

    def event_part(self) -> Column:
        """Part (model) an event refers to: each user browses three models."""
        return (F.col("user_id") * 7 + F.col("event_id") % 3) % self._parts

    # ------------------------------------------------------------------ dims
    @cached_property
    def dates(self) -> DataFrame:
        return calendar(self.spark)

    @cached_property
    def devices(self) -> DataFrame:
        rows = [(i, n) for i, n in enumerate(DEVICE_NAMES)]
        return self.spark.createDataFrame(rows, "device_id bigint, device string")

    @cached_property
    def browser_device(self) -> DataFrame:
        seen = (self.raw("events").select(browser_expr(F.col("user_id"), F.col("event_id")).alias("browser_id"))
                .unionByName(self.raw("orders").select(browser_expr(F.col("o_custkey"), F.col("o_orderkey")).alias("browser_id"))))
        return seen.distinct().select("browser_id", (F.col("browser_id") % len(DEVICE_NAMES)).alias("device_id"))

    # ---------------------------------------------------------------- events
    @cached_property
    def inventory_unit(self) -> DataFrame:
        """etl.inventory_unit: one row per unit scan; seq is the global event id."""
        e = self.raw("events")
        slot = F.col("event_id") % 4
        return e.select(
            (F.col("user_id") * 4 + slot).alias("id"),
            F.col("event_id").alias("seq"),
            F.when(F.col("event_type") == "error", "INACTIVE").otherwise("ACTIVE").alias("status"),
            barcode_expr(F.col("user_id"), slot).alias("barcode"),
            F.col("ts").alias("updated_on"),
            F.col("event_type").alias("action"),
            F.concat(F.lit("SITE_"), _s(F.col("user_id") % 3)).alias("location_site"),
            (F.when(F.col("event_type") == "view", "RACK")
             .when(F.col("event_type") == "signup", "CUSTOMER")
             .otherwise(F.upper("event_type"))).alias("location_station"),
            F.concat(F.lit("C"), _s((F.col("user_id") * 4 + slot) % 50)).alias("sku"),
        )

    @cached_property
    def inventory_unit_seq(self) -> DataFrame:
        """etl.inventory_unit_seq: newest seq per unit (pointer table)."""
        return (self.inventory_unit.groupBy(F.col("id").alias("unit_id"))
                .agg(F.max("seq").alias("seq")))

    @cached_property
    def inventory_history(self) -> DataFrame:
        """inventory_history: barcode <-> unit id pairs."""
        return self.inventory_unit.select("barcode", F.col("id").alias("unit_id")).distinct()

    @cached_property
    def pixel_raw2(self) -> DataFrame:
        """etl.pixel_raw2: click log."""
        e = self.raw("events")
        return e.select(
            F.col("user_id").alias("uid"),
            browser_expr(F.col("user_id"), F.col("event_id")).alias("browser_id"),
            F.concat(F.lit("M"), _s(self.event_part())).alias("style_name"),
            (F.when(F.col("event_type") == "purchase", "checkout_complete")
             .when(F.col("event_type") == "click", "rezo_add_to_cart")
             .otherwise(F.col("event_type"))).alias("action_type"),
            F.col("ts").alias("datetime_cst"),
            F.date_add(F.to_date("ts"), (F.col("event_id") % 5 + 10).cast("int"))
            .cast("timestamp_ntz").alias("rent_begin_date"),
            F.when(F.col("event_id") % 2 == 0, "web").otherwise("app").alias("log_source"),
        )

    def _cart_events(self) -> DataFrame:
        e = self._asked(self.raw("events").filter(F.col("event_type").isin("click", "purchase")),
                        F.concat(F.lit("E"), _s("event_id")),
                        F.when(F.col("event_type") == "purchase", (F.lit(EVENT_ORDER_BASE) + F.col("event_id")) * 2)
                        .otherwise(F.lit(0)))
        p = self.raw("part").select("p_partkey", "p_size", "p_brand", "p_type").hint("merge")  # grows: not to the driver
        return e.join(p, self.event_part() == F.col("p_partkey"), "inner")

    # -------------------------------------------------------------- lineitem
    def _lines(self) -> DataFrame:
        """lineitem x orders x part x customer, the grain of one booking."""
        l = self._asked(self.raw("lineitem"), booking_id_expr(), F.col("l_orderkey") * 2 + F.col("l_linenumber") % 2)
        o, p = (self.raw(t).hint("merge") if self.merged else self.raw(t) for t in ("orders", "part"))
        return (l.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
                .join(p, F.col("l_partkey") == F.col("p_partkey"), "inner"))

    @cached_property
    def order_group_reservation(self) -> DataFrame:
        """order_group_reservation (also analytics.ogr_po): one row per booking.

        Bookings of order lines, plus one booking per purchase event (the
        click log's checkouts), so click and order data meet.
        """
        return self._line_bookings.unionByName(self._event_bookings)

    @cached_property
    def _event_bookings(self) -> DataFrame:
        c = self._cart_events().filter(F.col("event_type") == "purchase")
        oid = F.lit(EVENT_ORDER_BASE) + F.col("event_id")
        rbd = F.date_add(F.to_date("ts"), (F.col("event_id") % 5 + 10).cast("int"))
        bid = F.concat(F.lit("E"), _s("event_id"))
        return c.select(
            bid.alias("reservation_booking_id"),
            (oid * 2).alias("group_id"),
            oid.alias("order_id"),
            F.col("user_id").alias("uid"),
            sku_expr(F.col("p_partkey"), F.col("p_size")).alias("sku"),
            F.col("p_brand").alias("style"),
            F.lit("CLASSIC").alias("order_type"),
            F.lit("RENTAL").alias("merchandise_category"),
            F.col("ts").alias("order_datetime_est"),
            F.col("ts").alias("group_created_est"),
            F.col("ts").alias("reservation_created"),
            rbd.alias("rental_begin_date"),
            F.date_add(rbd, 3).alias("rental_end_date"),
            F.date_add(rbd, (F.col("event_id") % 3 - 1).cast("int")).alias("last_possible_begin_date"),
            (F.col("event_id") % 4 + 1).alias("ups_ground_shipping_zone"),
            mail_expr(F.col("user_id")).alias("mail"),
            mail_expr(F.col("user_id")).alias("email"),
            product_type_expr(F.col("p_brand")).alias("type"),
            product_type_expr(F.col("p_brand")).alias("product_type"),
            barcode_expr(F.col("user_id"), F.col("event_id") % 4).alias("barcode"),
            F.concat(F.lit("F"), bid).alias("fulfillment_id"),
            F.lit("DELIVERED").alias("last_fulfillment_status"),
            F.lit("SHIPPED").alias("last2nd_fulfillment_status"),
            (F.col("ts") + hours(48)).alias("last_fulfillment_updated_on"),
            (F.col("ts") + hours(24)).alias("last2nd_fulfillment_updated_on"),
            F.lit(None).cast("string").alias("po_category"),
            F.lit(None).cast("string").alias("po_reason"),
            F.col("p_type").alias("sub_type"),
            *self._fact_extras(F.col("user_id"), oid * 2, rbd, F.date_add(rbd, 3), bid, F.col("event_id") % 5),
        )

    @cached_property
    def _line_bookings(self) -> DataFrame:
        x = self._lines()
        rbd = F.to_date("l_shipdate")
        ln = F.col("l_linenumber")
        po_cat = (F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "Warehouse")
                  .when(F.col("l_returnflag") == "R", "Predicted"))
        po_reason = F.when(
            F.col("l_returnflag") == "R",
            F.when(F.col("l_suppkey") % 4 == 0, "Late delivery")
            .when(F.col("l_suppkey") % 4 == 1, "Item missing")
            .when(F.col("l_suppkey") % 4 == 2, "Allogator mismatch")
            .otherwise("Predicted"))
        n = F.lit(1) + F.col("l_orderkey") % 3
        last_i = n - 1
        st = F.array(*[F.lit(s) for s in FULFILLMENT_STATUSES])

        def status_at(i: Column) -> Column:
            return F.element_at(st, ((F.col("l_partkey") + i * F.col("l_suppkey")) % 6 + 1).cast("int"))

        return x.select(
            booking_id_expr().alias("reservation_booking_id"),
            (F.col("l_orderkey") * 2 + ln % 2).alias("group_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("o_custkey").alias("uid"),
            sku_expr(F.col("l_partkey"), F.col("p_size")).alias("sku"),
            F.col("p_brand").alias("style"),
            order_type_expr(F.col("o_orderpriority")).alias("order_type"),
            F.when(F.col("p_type") == "PROMO", "CLEARANCE").otherwise("RENTAL").alias("merchandise_category"),
            F.col("o_orderdate").alias("order_datetime_est"),
            (F.col("o_orderdate") + hours(ln)).alias("group_created_est"),
            (F.col("o_orderdate") + hours(ln)).alias("reservation_created"),
            rbd.alias("rental_begin_date"),
            F.date_add(rbd, (ln % 2 + 3).cast("int")).alias("rental_end_date"),
            F.date_add(rbd, (ln % 3 - 1).cast("int")).alias("last_possible_begin_date"),
            (F.col("l_suppkey") % 4 + 1).alias("ups_ground_shipping_zone"),
            mail_expr(F.col("o_custkey")).alias("mail"),
            mail_expr(F.col("o_custkey")).alias("email"),
            product_type_expr(F.col("p_brand")).alias("type"),
            product_type_expr(F.col("p_brand")).alias("product_type"),
            barcode_expr(F.col("l_partkey"), F.col("l_suppkey") % 4).alias("barcode"),
            F.concat(F.lit("F"), booking_id_expr()).alias("fulfillment_id"),
            status_at(last_i).alias("last_fulfillment_status"),
            F.when(n > 1, status_at(last_i - 1)).alias("last2nd_fulfillment_status"),
            (F.col("l_shipdate") + hours(last_i * 30 + ln)).alias("last_fulfillment_updated_on"),
            F.when(n > 1, F.col("l_shipdate") + hours((last_i - 1) * 30 + ln)).alias("last2nd_fulfillment_updated_on"),
            po_cat.alias("po_category"),
            po_reason.alias("po_reason"),
            F.col("p_type").alias("sub_type"),
            *self._fact_extras(F.col("o_custkey"), F.col("l_orderkey") * 2 + ln % 2, rbd,
                               F.date_add(rbd, (ln % 2 + 3).cast("int")), booking_id_expr(),
                               F.col("l_suppkey") % 5),
        )

    @staticmethod
    def _fact_extras(uid, gid, rbd, red, bid, k):
        """Reservation-fact columns the add-on report carries through."""
        return [
            _s(uid % 25).alias("billing_postal_code"),
            F.lit("payment_received").alias("order_status"),
            F.date_add(F.lit("1994-01-01").cast("date"), (uid % 3000).cast("int")).alias("user_create_date"),
            _s(gid % 25).alias("delivery_postal_code"),
            rbd.alias("expected_begin_date"),
            red.alias("expected_end_date"),
            red.alias("actual_expected_end_date"),
            F.date_sub(rbd, 2).alias("earliest_possible_begin_date"),
            bid.alias("primary_booking_id"),
            F.date_sub(rbd, 2).alias("customer_shipment_date"),
            F.date_add(rbd, 6).alias("warehouse_received_date"),
            F.date_add(rbd, 8).alias("item_available_date"),
            (gid % 3 + 1).alias("dresses_in_group"),
            F.date_add(rbd, 5).alias("rf_end_date"),
            (k + 1).alias("unit_usage_rank"),
            (k + 3).alias("unit_total_usage"),
        ]

    @cached_property
    def ogr_po(self) -> DataFrame:
        return self.order_group_reservation

    @cached_property
    def autumn_report_raw_data(self) -> DataFrame:
        """autumn_report_raw_data: problem-order source rows."""
        return self.order_group_reservation.select(
            "group_id", "mail", "merchandise_category", "order_type", "po_category", "po_reason",
            "rental_begin_date", "reservation_booking_id", "sku", "sub_type", "type")

    @cached_property
    def yp_autumn_full(self) -> DataFrame:
        """etl.yp_autumn_full: one annotation per discounted line."""
        l = self.raw("lineitem").filter(F.col("l_discount") >= 0.04)
        ln = F.col("l_linenumber")
        sk = F.col("l_suppkey") % 5
        return l.select(
            booking_id_expr().alias("annotation_id"),
            (F.when(ln % 4 == 0, "REPLACEMENT").when(ln % 4 == 1, "RFF")
             .when(ln % 4 == 2, "QUALITY_ISSUE").otherwise("SHIPPING")).alias("annotation_group"),
            F.lit("BOOKING").alias("annotation_target"),
            booking_id_expr().alias("annotation_target_id"),
            F.when(F.col("l_quantity") < 40, "reason").otherwise("fitOverall").alias("detail_name"),
            (F.when(sk == 0, "FIT").when(sk == 1, "MINOR_QUALITY").when(sk == 2, "CARRIER_ISSUE")
             .when(sk == 3, "OPERATION_ISSUE").otherwise("PO_SWAP")).alias("detail_value"),
            F.col("l_orderkey").alias("order_id"),
            (F.when(F.col("l_tax") < 0.02, "AUTOMATED").when(F.col("l_tax") < 0.05, "EMAIL")
             .otherwise("PHONE")).alias("contact_method"),
            (F.col("l_shipdate") + hours(ln)).alias("transaction_created"),
        )

    @cached_property
    def financial_line_item(self) -> DataFrame:
        """etl.financial_line_item: one ledger line per lineitem; money is decimal."""
        l = self.raw("lineitem")
        ln = F.col("l_linenumber")
        price = F.col("l_extendedprice").cast("decimal(18,2)")
        disc = F.col("l_discount").cast("decimal(4,2)")
        taxr = F.col("l_tax").cast("decimal(4,2)")
        subtotal = (price * (F.lit(1).cast("decimal(1,0)") - disc)).cast("decimal(20,4)")
        created = F.col("l_shipdate") + hours(ln * 3)
        return l.select(
            booking_id_expr().alias("id"),
            F.col("l_orderkey").alias("order_id"),
            (F.col("l_orderkey") * 2 + ln % 2).alias("group_id"),
            (F.col("l_orderkey") * 10 + ln % 2).alias("invoice_id"),
            F.when(F.col("l_returnflag") == "R", "OUT").otherwise("IN").alias("direction"),
            F.when(F.col("l_linestatus") == "F", "CONFIRMED").otherwise("PENDING").alias("status"),
            subtotal.alias("subtotal"),
            (subtotal * taxr).cast("decimal(22,6)").alias("tax"),
            (subtotal + subtotal * taxr).cast("decimal(22,6)").alias("total"),
            F.col("l_tax").cast("decimal(9,4)").alias("tax_rate"),
            F.when(F.col("l_returnflag") == "R", "MERCHANDISE_CREDIT").otherwise("CHARGE").alias("type"),
            created.alias("created_at"),
            (created + hours(F.col("l_orderkey") % 48)).alias("updated_at"),
        )

    @cached_property
    def fli_status_history(self) -> DataFrame:
        return self.financial_line_item.select(F.col("id").alias("fli_id"),
                                               F.col("status").alias("to_status"))

    @cached_property
    def invoice_order(self) -> DataFrame:
        l = self._ordered(self.raw("lineitem")).join(self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"), "inner")
        k = F.col("l_linenumber") % 2
        return l.select(
            (F.col("l_orderkey") * 10 + k).alias("id"),
            F.col("l_orderkey").alias("order_id"),
            k.alias("seq"),
            (F.col("o_orderdate") + days(k)).alias("created_at"),
            order_type_expr(F.col("o_orderpriority")).alias("order_type"),
        ).distinct()

    @cached_property
    def invoice_group(self) -> DataFrame:
        l = self.raw("lineitem")
        k = F.col("l_linenumber") % 2
        gid = F.col("l_orderkey") * 2 + k
        return l.select(
            gid.alias("id"),
            (F.col("l_orderkey") * 10 + k).alias("invoice_order_id"),
            F.when(F.col("l_orderkey") % 50 == 0, F.lit(-1).cast("bigint")).otherwise(gid).alias("group_id"),
        ).distinct()

    @cached_property
    def invoice_booking(self) -> DataFrame:
        l = self.raw("lineitem")
        return l.select((F.col("l_orderkey") * 2 + F.col("l_linenumber") % 2).alias("invoice_group_id"),
                        booking_id_expr().alias("booking_id"))

    @cached_property
    def reservation_booking(self) -> DataFrame:
        """etl.reservation_booking: order bookings (from lines) plus cart adds (from events)."""
        ogr = self._line_bookings
        orders_rb = ogr.select(
            F.col("reservation_booking_id").alias("id"),
            F.col("group_id").alias("order_group_id"),
            "uid", "sku", "merchandise_category",
            F.col("reservation_created").alias("creation_date"),
            F.when(F.col("reservation_booking_id").contains("-1-"), 0).otherwise(1).alias("status"),
            F.lit(0).alias("type"),
            F.col("rental_begin_date").alias("expected_begin_date"),
            F.col("rental_end_date").alias("expected_end_date"),
            F.date_sub("rental_begin_date", 2).alias("earliest_possible_begin_date"),
            "last_possible_begin_date",
            F.col("reservation_booking_id").alias("primary_booking_id"),
        )
        c = self._cart_events()
        d = F.to_date("ts")
        cart_rb = c.select(
            F.concat(F.lit("E"), _s("event_id")).alias("id"),
            F.when(F.col("event_type") == "purchase", (F.lit(EVENT_ORDER_BASE) + F.col("event_id")) * 2)
            .otherwise(F.lit(0)).alias("order_group_id"),
            F.col("user_id").alias("uid"),
            sku_expr(F.col("p_partkey"), F.col("p_size")).alias("sku"),
            F.lit("RENTAL").alias("merchandise_category"),
            F.col("ts").alias("creation_date"),
            F.when(F.col("event_id") % 4 == 0, 0).otherwise(1).alias("status"),
            F.when(F.col("event_type") == "purchase", 0).otherwise(2).alias("type"),
            F.date_add(d, (F.col("event_id") % 5 + 10).cast("int")).alias("expected_begin_date"),
            F.date_add(d, (F.col("event_id") % 5 + 13).cast("int")).alias("expected_end_date"),
            F.date_add(d, 1).alias("earliest_possible_begin_date"),
            F.date_add(d, (F.col("event_id") % 20).cast("int")).alias("last_possible_begin_date"),
            F.concat(F.lit("E"), _s("event_id")).alias("primary_booking_id"),
        )
        return orders_rb.unionByName(cart_rb)

    @cached_property
    def reservation_booking_detail(self) -> DataFrame:
        x = self._lines()
        ln = F.col("l_linenumber")
        begin = F.col("l_shipdate") + hours(ln * 4)
        lines = x.select(
            booking_id_expr().alias("reservation_booking_id"),
            begin.alias("rental_begin_date"),
            (begin + days(ln % 2 + 3)).alias("rental_end_date"),
            (begin - days(2)).alias("customer_shipment_date"),
            (begin + days(6)).alias("warehouse_received_date"),
            (begin + days(8)).alias("item_available_date"),
        )
        c = self._cart_events()
        b = F.date_add(F.to_date("ts"), (F.col("event_id") % 5 + 10).cast("int")).cast("timestamp_ntz")
        carts = c.select(
            F.concat(F.lit("E"), _s("event_id")).alias("reservation_booking_id"),
            b.alias("rental_begin_date"),
            (b + days(F.col("event_id") % 2 + 3)).alias("rental_end_date"),
            (b - days(2)).alias("customer_shipment_date"),
            (b + days(6)).alias("warehouse_received_date"),
            (b + days(8)).alias("item_available_date"),
        )
        return lines.unionByName(carts)

    @cached_property
    def fulfillment(self) -> DataFrame:
        """etl.fulfillment: 1..3 status rows per booking, seq 1..n in time order."""
        l = self.raw("lineitem")
        n = F.lit(1) + F.col("l_orderkey") % 3
        st = F.array(*[F.lit(s) for s in FULFILLMENT_STATUSES])
        ex = l.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)).alias("i"))
        return ex.select(
            F.concat(F.lit("F"), booking_id_expr()).alias("id"),
            booking_id_expr().alias("booking_id"),
            (F.col("i") + 1).alias("seq"),
            F.element_at(st, ((F.col("l_partkey") + F.col("i") * F.col("l_suppkey")) % 6 + 1).cast("int")).alias("status"),
            barcode_expr(F.col("l_partkey"), F.col("l_suppkey") % 4).alias("barcode"),
            (F.col("l_shipdate") + hours(F.col("i") * 30 + F.col("l_linenumber"))).alias("updated_on"),
            F.when(F.col("l_partkey") % 3 == 0, F.concat(F.lit("C"), _s(F.col("l_partkey") % 50))).alias("child_sku"),
        )

    @cached_property
    def fulfillment_seq(self) -> DataFrame:
        """etl.fulfillment_seq: newest seq per fulfillment (the log has 1 + orderkey % 3 rows)."""
        l = self.raw("lineitem")
        return l.select(F.concat(F.lit("F"), booking_id_expr()).alias("fulfillment_id"),
                        (F.lit(1) + F.col("l_orderkey") % 3).alias("seq"))

    @cached_property
    def reservation_fulfillment(self) -> DataFrame:
        l = self.raw("lineitem").filter(F.col("l_linenumber") % 2 == 0)
        return l.select(booking_id_expr().alias("reservation_booking_id"),
                        (F.col("l_shipdate") + days(5)).alias("end_date"))

    @cached_property
    def queue_rf_end_date_consolidation(self) -> DataFrame:
        l = self.raw("lineitem").filter(F.col("l_linenumber") == 3)
        return l.select(booking_id_expr().alias("reservation_booking_id"),
                        F.date_add(F.to_date("l_shipdate"), 7).alias("new_rf_end_date"))

    @cached_property
    def unlimited_po_sources(self) -> DataFrame:
        l = self.raw("lineitem").filter((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"))
        return l.select(F.concat(F.lit("F"), booking_id_expr()).alias("fulfillment_id"),
                        F.lit("Warehouse").alias("po_category"),
                        F.lit("Damaged").alias("po_reason"))

    @cached_property
    def order_groups(self) -> DataFrame:
        """etl order groups: one row per (order, line parity)."""
        # The groups come first: lines of a group would only be joined to be dropped again.
        l = self._ordered(self.raw("lineitem")).select("l_orderkey", (F.col("l_linenumber") % 2).alias("_k")).distinct()
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        c = self.raw("customer").select("c_custkey", "c_nationkey")
        x = (l.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
             .join(c, F.col("o_custkey") == F.col("c_custkey"), "inner"))
        k = F.col("_k")
        gid = F.col("l_orderkey") * 2 + k
        return x.select(
            gid.alias("group_id"),
            F.col("l_orderkey").alias("order_id"),
            _s(gid % 25).alias("postal_code"),
            F.col("c_nationkey").cast("bigint").alias("state"),
            F.concat(F.lit("City"), _s(F.col("c_nationkey") % 5)).alias("city"),
            (F.col("o_orderdate") + hours(k)).alias("created_at"),
        ).distinct()

    @cached_property
    def uc_orders(self) -> DataFrame:
        o = self.raw("orders")
        created = (F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
                   + F.col("o_orderkey") % 86400)
        return o.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("uid"),
            created.alias("created"),
            (F.when(F.col("o_orderstatus") == "F", "payment_received")
             .when(F.col("o_orderstatus") == "O", "canceled").otherwise("processing")).alias("order_status"),
            order_type_expr(F.col("o_orderpriority")).alias("order_type"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("order_total"),
            mail_expr(F.col("o_custkey")).alias("primary_email"),
            _s(F.col("o_custkey") % 25).alias("billing_postal_code"),
        )

    @cached_property
    def users(self) -> DataFrame:
        c = self.raw("customer")
        return c.select(
            F.col("c_custkey").alias("uid"),
            F.date_add(F.lit("1994-01-01").cast("date"), (F.col("c_custkey") % 3000).cast("int")).alias("create_date"),
            mail_expr(F.col("c_custkey")).alias("mail"),
        )

    # ------------------------------------------------------------------ part
    @cached_property
    def products_master_iid(self) -> DataFrame:
        p = self.raw("part")
        return p.select(
            sku_expr(F.col("p_partkey"), F.col("p_size")).alias("sku"),
            F.concat(F.lit("M"), _s("p_partkey")).alias("model"),
            _s("p_size").alias("size"),
            F.col("p_type").alias("sizescalename"),
            F.when(F.col("p_partkey") % 13 == 0, "X").otherwise("N").alias("special_type"),
            F.col("p_brand").alias("style_out"),
            F.col("p_type").alias("sub_type"),
        )

    @cached_property
    def products_iid(self) -> DataFrame:
        p = self.raw("part")
        sku = sku_expr(F.col("p_partkey"), F.col("p_size"))
        return p.select(F.when(F.col("p_partkey") % 2 == 0, F.lower(sku)).otherwise(sku).alias("sku"),
                        F.col("p_brand").alias("style"))

    @cached_property
    def barcode_sku_style_type(self) -> DataFrame:
        p = self.raw("part")
        return p.select(sku_expr(F.col("p_partkey"), F.col("p_size")).alias("sku"),
                        F.col("p_brand").alias("style"))

    @cached_property
    def products(self) -> DataFrame:
        """analytics.products: one row per style (brand)."""
        p = self.raw("part")
        return p.groupBy(F.col("p_brand").alias("style")).agg(
            F.min(product_type_expr(F.col("p_brand"))).alias("type"),
            F.concat(F.lit("Designer"), _s(F.min(brand_no(F.col("p_brand"))) % 7)).alias("designer"),
            F.min("p_name").alias("title"),
            F.min("p_type").alias("sub_type"),
        )

    @cached_property
    def size_scales(self) -> DataFrame:
        p = self.raw("part")
        return p.select(_s("p_size").alias("psize"), F.col("p_type").alias("size_scale"),
                        (F.col("p_size") % 12).cast("bigint").alias("standard_size"))

    @cached_property
    def product_prices(self) -> DataFrame:
        """product_prices: each model priced in 3 order windows x 2 rent windows."""
        p = self.raw("part")
        grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"))
                         for i in range(3) for j in range(2)])
        x = p.select("p_partkey", "p_retailprice", F.explode(grid).alias("g"))
        i, j = F.col("g.i"), F.col("g.j")
        o_start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + days(i * 10)
        return x.select(
            F.concat(F.lit("M"), _s("p_partkey")).alias("style_name"),
            F.lit("RENTAL").alias("merchandise_category"),
            o_start.alias("order_date_start"),
            (o_start + days(10)).alias("order_date_end"),
            F.when(j == 0, F.lit("2024-01-01").cast("date")).otherwise(F.lit("2024-01-26").cast("date")).alias("rent_begin_start"),
            F.when(j == 0, F.lit("2024-01-25").cast("date")).otherwise(F.lit("2024-03-31").cast("date")).alias("rent_begin_end"),
            (F.col("p_retailprice").cast("decimal(18,2)") + i * 10 + j * 5).cast("decimal(18,2)").alias("price"),
        )

    @cached_property
    def browser_orders(self) -> DataFrame:
        o = self.raw("orders").select(browser_expr(F.col("o_custkey"), F.col("o_orderkey")).alias("browser_id"),
                                      F.col("o_orderkey").alias("order_id"))
        e = (self.raw("events").filter(F.col("event_type") == "purchase")
             .select(browser_expr(F.col("user_id"), F.col("event_id")).alias("browser_id"),
                     (F.lit(EVENT_ORDER_BASE) + F.col("event_id")).alias("order_id")))
        return o.unionByName(e)

    # -------------------------------------------------------------- supplier
    @cached_property
    def shipping_method_time(self) -> DataFrame:
        s = self.raw("supplier")
        m = F.col("s_suppkey") % 3
        method = F.when(m == 0, 2).when(m == 1, 6).otherwise(9).cast("bigint")
        return (s.select(_s("s_nationkey").alias("destination_zip_code"),
                         method.alias("shipping_method_id"),
                         (F.col("s_suppkey") % 7 + 1).alias("transit_days"))
                .groupBy("destination_zip_code", "shipping_method_id")
                .agg(F.min("transit_days").alias("transit_days")))

    # ---------------------------------------------------------------- nation
    @cached_property
    def uc_zones(self) -> DataFrame:
        n = self.raw("nation")
        return n.select(F.col("n_nationkey").cast("bigint").alias("zone_id"),
                        F.when(F.col("n_nationkey") == 7, "IL").otherwise(F.col("n_name")).alias("zone_code"))

    @cached_property
    def showroom(self) -> DataFrame:
        n = self.raw("nation")
        return n.select(F.col("n_nationkey").cast("bigint").alias("id"),
                        F.when(F.col("n_nationkey") % 6 == 3, F.lit("")).otherwise(F.col("n_name")).alias("name"))

    @cached_property
    def showroom_order(self) -> DataFrame:
        o = self.raw("orders").filter(F.col("o_orderkey") % 5 == 0)
        return o.select(F.col("o_orderkey").alias("order_id"),
                        (F.col("o_custkey") % 25).alias("showroom_id"),
                        F.when(F.col("o_orderkey") % 10 == 5, 1).otherwise(0).alias("deleted"))

    # ------------------------------------------------------------ aggregates
    @cached_property
    def ow_transaction_summary(self) -> DataFrame:
        """ow_transaction_summary: refund transactions per order group."""
        f = self.financial_line_item.filter(F.col("direction") == "OUT")
        return f.select(
            F.col("id").alias("transaction_id"),
            "order_id", "group_id",
            (-F.col("total")).cast("decimal(22,6)").alias("fli_total"),
            (-F.col("tax")).cast("decimal(22,6)").alias("fli_tax_total"),
            (-F.col("subtotal")).cast("decimal(22,6)").alias("fli_pretax_total"),
            F.when(F.col("order_id") % 3 == 0, "DAMAGED").when(F.col("order_id") % 3 == 1, "LATE")
            .otherwise("FIT").alias("annotation_type_summary"),
            F.when(F.col("order_id") % 2 == 0, "QUALITY").otherwise("SHIPPING").alias("annotation_group_summary"),
        )

    @cached_property
    def v_ot_orderdata(self) -> DataFrame:
        """v_ot_orderdata: booking begin dates with the order's rank per customer."""
        from ..operators.seqlog import row_number_within
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        # Rank of the order among the customer's orders, split per order year (skew-safe).
        nth = (row_number_within(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.year("o_orderdate"), "_nth")
               .select(F.col("o_orderkey").alias("order_id"), F.col("_nth").cast("bigint").alias("nth_order")))
        l = self.raw("lineitem").select(F.col("l_orderkey").alias("order_id"),
                                        F.to_date("l_shipdate").alias("rental_begin_date"))
        return l.join(nth, "order_id", "inner")

    @cached_property
    def finance_current_view_inventory(self) -> DataFrame:
        l = self.raw("lineitem").select("l_partkey", "l_suppkey")
        u, k = F.col("l_partkey") % 150, F.col("l_suppkey") % 4  # of the unit's age and cost only
        return l.select(
            barcode_expr(F.col("l_partkey"), k).alias("barcode"),
            (F.lit("2017-06-01 00:00:00").cast("timestamp_ntz") + days(u * 5 + k * 3)).alias("activated_on"),
            (u * 3 + 100).cast("decimal(18,2)").alias("cost"),
        ).distinct()

    @cached_property
    def shipment(self) -> DataFrame:
        l = self.raw("lineitem")
        return l.select((F.col("l_orderkey") * 2 + F.col("l_linenumber") % 2).alias("shipper_reference"),
                        F.col("l_shipdate").alias("ship_date")).distinct()

    @cached_property
    def v_ci_oi_resolution_report(self) -> DataFrame:
        """rpt.v_ci_oi_resolution_report: resolved issues with their replacement booking."""
        a = self.yp_autumn_full.filter(F.col("annotation_group") == "REPLACEMENT")
        g = self.order_group_reservation
        x = a.join(g, a["annotation_target_id"] == g["reservation_booking_id"], "inner")
        return x.select(g["rental_begin_date"], g["order_type"],
                        a["annotation_target_id"].alias("replacement_booking_id"),
                        F.date_add(F.to_date(a["transaction_created"]), 2).alias("oi_resolution_date"))

    # ------------------------------------------------------------- SKU month
    @cached_property
    def profitability_sku_monthly_revenue_cogs(self) -> DataFrame:
        """profitability_sku_monthly_revenue_cogs: SKU x fiscal month x order type.

        The rental month is the fiscal month of the ship date; the availability
        month is the fiscal month of the part's first ship date.
        """
        x = self._lines()
        cal = self.dates.select("asofdate", "fiscal_year", "fiscal_month", "fiscal_month_start")
        rbd = F.to_date("l_shipdate")
        first = (self.raw("lineitem").groupBy(F.col("l_partkey").alias("_fp"))
                 .agg(F.min(F.to_date("l_shipdate")).alias("_first")))
        avl = first.join(F.broadcast(cal.select(
            F.col("asofdate").alias("_ad"), F.col("fiscal_year").alias("fiscal_year_avl"),
            F.col("fiscal_month").alias("fiscal_month_avl"),
            F.col("fiscal_month_start").alias("fiscal_month_start_avl"))), F.col("_first") == F.col("_ad"))
        y = (x.join(F.broadcast(cal), rbd == F.col("asofdate"), "inner")
             .join(avl, F.col("l_partkey") == F.col("_fp"), "inner"))
        price = F.col("l_extendedprice").cast("decimal(18,2)")
        return (y.groupBy(
            sku_expr(F.col("l_partkey"), F.col("p_size")).alias("sku"),
            F.col("p_brand").alias("style"),
            order_type_expr(F.col("o_orderpriority")).alias("order_type"),
            F.col("fiscal_year").alias("fiscal_year_rbd"),
            F.col("fiscal_month").alias("fiscal_month_rbd"),
            F.col("fiscal_month_start").alias("fiscal_month_start_rbd"),
            "fiscal_year_avl", "fiscal_month_avl", "fiscal_month_start_avl",
            F.col("p_retailprice").cast("decimal(18,2)").alias("cost"),
            F.col("p_size").cast("bigint").alias("current_total_units"))
            .agg(F.sum(price).cast("decimal(18,2)").alias("product_total_sku"),
                 F.sum(price * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(20,4)")
                 .alias("queue_subscription_revenue_sku"),
                 F.sum(price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(20,4)")
                 .alias("queue_ttb_revenue_sku"),
                 F.count(F.lit(1)).alias("total_booking"),
                 F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(18,2)")
                 .alias("queue_monthly_athome_days_sku")))

    @cached_property
    def master_replenish_style(self) -> DataFrame:
        p = self.raw("part").filter((F.col("p_type") == "PROMO") & (F.col("p_size") == 50))
        return p.select(F.col("p_brand").alias("style")).distinct()

    @cached_property
    def products_master(self) -> DataFrame:
        p = self.raw("part")
        return p.select(F.col("p_brand").alias("model"),
                        F.when((F.col("p_brand") == "Brand#13") & (F.col("p_size") < 10), 1)
                        .otherwise(0).cast("bigint").alias("is_replenishment_style"))
