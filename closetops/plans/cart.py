"""Cart conversion and device attribution.

cart_bookings         priced rental cart adds with size and new-customer flag
cart_sessions         one session per user x fiscal week of the last possible begin date
bookings_per_week     order bookings per user-week
cart_conversion       session conversion facts (lead weeks, days to order, checkout flag)
log_coverage          cart adds matched to the click log
user_devices          devices per user and ever-ordered flag
session_devices       devices seen inside each session's date span
device_switch         checkout device vs add-to-cart device for the same item (pair counts)
first_last_device     first and last device inside each session
action_devices        add-to-cart / checkout clicks inside each session with the session's device count

Session x click matching is "same user and click date within the session's
date span".  Instead of a range join per user (every session against every
click of the user), each session is expanded to its days and equi-joined on
(user, day) against clicks pre-reduced per (user, day) to exactly what the
report needs (distinct devices, or the first/last device of the day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import flag
from ..operators import stage
from ..operators.aggs import pair_counts
from ..operators.intervals import interval_join
from ..operators.keybits import Asked, asked, may_meet, stored_with_bits
from ..sources.calendar import on_calendar
from ..functions.temporal import elapsed_days, epoch_to_ntz, to_eastern

# Fixed values of the analysis.
BOT_DEVICE = "Suspected Bots"
ADD_TO_CART = "rezo_add_to_cart"
CHECKOUT = "checkout_complete"
MAX_RENTAL_DAYS = 730

RB_COLS = ["id", "order_group_id", "uid", "sku", "merchandise_category", "creation_date", "status",
           "type", "expected_begin_date", "expected_end_date", "earliest_possible_begin_date",
           "last_possible_begin_date", "primary_booking_id"]

SESSION_COLS = ["uid", "LPD_week_start", "adding_to_SC", "style_count", "sku_count", "min_price",
                "max_price", "cart_price", "new_flg", "order_total", "max_size", "min_size", "avg_size",
                "placing_order", "first_addto_SC", "last_addto_SC", "cancel_rbs", "first_order",
                "last_order", "reservation_booking_id"]


def first_order_dates(uc_orders: DataFrame) -> DataFrame:
    """First order time per user, epoch seconds read as UTC and shown in US Eastern."""
    return uc_orders.groupBy("uid").agg(F.min(to_eastern(epoch_to_ntz("created"))).alias("first_order_date"))


def cart_bookings(rb: DataFrame, users: DataFrame, rbd: Asked, ogr: Asked, uco: DataFrame,
                  pm: DataFrame, size_scales: DataFrame, prices: DataFrame, lo: str, hi: str) -> DataFrame:
    """Rental cart adds created in [lo, hi) priced by model and the two price windows.

    Users, orders and products grow with the shop and their rows, unlike the files they come from,
    don't fit the driver: they are merged, never broadcast.  The window's bookings are written once;
    details and reservations of other bookings are left out before they move (``operators.keybits``).
    """
    r, held = stored_with_bits(rb.filter((F.col("merchandise_category") == "RENTAL")
                                         & (F.col("creation_date") >= F.lit(lo).cast("timestamp_ntz"))
                                         & (F.col("creation_date") < F.lit(hi).cast("timestamp_ntz"))
                                         & (F.col("uid") > 1)), "id")
    u = users.select(F.col("uid").alias("_uid"), F.col("create_date").alias("user_create_date")).hint("merge")
    d = asked(rbd, held).select(F.col("reservation_booking_id").alias("_rbid"), "rental_begin_date", "rental_end_date")
    g = asked(ogr, held).select(F.col("reservation_booking_id").alias("_gbid"), F.col("order_id").alias("_goid"))
    d, g = may_meet(d, "_rbid", held), may_meet(g, "_gbid", held)
    o = uco.select(F.col("order_id").alias("_ooid"), "order_total").hint("merge")
    m = pm.select(F.col("sku").alias("_msku"), "model", F.col("size").alias("_size"),
                  F.col("sizescalename").alias("_scale"), "style_out").hint("merge")
    ss = (size_scales.groupBy("psize", "size_scale").agg(F.min("standard_size").alias("_std")))
    pp = prices.filter(F.col("merchandise_category") == "RENTAL").select(
        F.col("style_name").alias("_pmodel"), "order_date_start", "order_date_end",
        "rent_begin_start", "rent_begin_end", "price")
    fo = first_order_dates(uco).withColumnRenamed("uid", "_fuid").hint("merge")
    x = (r.join(u, r["uid"] == u["_uid"], "inner")
         .join(d, r["id"] == d["_rbid"], "inner")
         .filter(elapsed_days("rental_end_date", "rental_begin_date") < MAX_RENTAL_DAYS)
         .join(g, r["id"] == g["_gbid"], "left")
         .join(o, F.col("_goid") == o["_ooid"], "left")
         .join(m, r["sku"] == m["_msku"], "left")
         .join(ss, (F.col("_size") == ss["psize"]) & (F.col("_scale") == ss["size_scale"]), "left")
         .join(fo, r["uid"] == fo["_fuid"], "left"))
    x = interval_join(x, pp, ("model", "_pmodel"), [("creation_date", "order_date_start", "order_date_end"),
                                                    ("rental_begin_date", "rent_begin_start", "rent_begin_end")])
    # Smallest standard size among the result rows of the same size label.
    x = stage(x)
    std = x.groupBy(F.col("psize").alias("_spsize")).agg(F.min("_std").alias("standard_size"))
    x = x.join(std, x["psize"].eqNullSafe(std["_spsize"]), "left")
    return x.select(
        "user_create_date",
        F.when(F.col("creation_date") > F.col("first_order_date"), 0).otherwise(1).alias("new_flg"),
        "order_total", "rental_begin_date", "rental_end_date", "standard_size", "style_out", "model",
        "price", *RB_COLS)


def cart_sessions(rcr: DataFrame, dates: DataFrame, bot_uids) -> DataFrame:
    """Cart adds grouped per user x fiscal week of the last possible begin date."""
    cal = dates.select("asofdate", "fiscal_week_start")
    x = on_calendar(rcr.filter((F.col("uid") > 0) & ~F.col("uid").isin(*bot_uids)), cal, "last_possible_begin_date")
    t0 = F.col("type") == 0
    return x.groupBy("uid", F.col("fiscal_week_start").alias("LPD_week_start")).agg(
        F.count(F.lit(1)).alias("adding_to_SC"),
        F.countDistinct("model").alias("style_count"),
        F.countDistinct("sku").alias("sku_count"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        (F.sum("price").cast("double") / F.count("price")).alias("cart_price"),
        F.min("new_flg").alias("new_flg"),
        F.max("order_total").alias("order_total"),
        F.max("standard_size").alias("max_size"),
        F.min("standard_size").alias("min_size"),
        F.floor(F.avg("standard_size")).cast("bigint").alias("avg_size"),
        F.sum(F.when(t0, 1)).cast("bigint").alias("placing_order"),
        F.min("creation_date").alias("first_addto_SC"),
        F.max("creation_date").alias("last_addto_SC"),
        F.sum(F.when((F.col("status") == 1) & (F.col("type") == 2), 1).otherwise(0)).cast("bigint").alias("cancel_rbs"),
        F.min(F.when(t0, F.col("creation_date"))).alias("first_order"),
        F.max(F.when(t0, F.col("creation_date"))).alias("last_order"),
        F.min(F.when(t0, F.col("id"))).alias("reservation_booking_id"),
    )


def bookings_per_week(rb: DataFrame, dates: DataFrame) -> DataFrame:
    cal = dates.select("asofdate", "fiscal_week_start")
    x = on_calendar(rb, cal, "last_possible_begin_date")
    return x.groupBy("uid", F.col("fiscal_week_start").alias("LPD_week_start")).agg(
        F.sum(flag((F.col("order_group_id") > 0) & (F.col("merchandise_category") == "RENTAL")))
        .cast("bigint").alias("booking_count"))


def cart_conversion(sc: DataFrame, per_week: DataFrame, dates: DataFrame, lo: str, hi: str) -> DataFrame:
    """Sessions whose first add falls in [lo, hi) with lead weeks, days to order and bookings."""
    cal = dates.select("asofdate", F.col("fiscal_week_start").alias("first_addto_SC_week_start"))
    s = sc.filter((F.col("first_addto_SC") >= F.lit(lo).cast("timestamp_ntz"))
                  & (F.col("first_addto_SC") < F.lit(hi).cast("timestamp_ntz")))
    pw = per_week.select(F.col("uid").alias("_wuid"), F.col("LPD_week_start").alias("_wk"), "booking_count")
    x = (on_calendar(s, cal, "first_addto_SC")
         .join(pw, (s["uid"] == pw["_wuid"]) & (s["LPD_week_start"] == pw["_wk"]), "left"))
    placed = F.col("placing_order") > 0
    return x.select(
        *[s[c] for c in SESSION_COLS], "first_addto_SC_week_start",
        (F.datediff("LPD_week_start", "first_addto_SC_week_start") / 7).alias("LPD_SC_dif_week"),
        F.when(placed, elapsed_days("first_order", "first_addto_SC")).cast("bigint").alias("order_SC_dif_day"),
        flag(placed).alias("classic_checkout_flag"),
        F.col("booking_count").alias("booking_count_classic_unlimited"))


def log_coverage(rcr: DataFrame, pm: DataFrame, pr: DataFrame) -> DataFrame:
    """Cart adds with the log source of matching add-to-cart clicks (same user, model, begin date)."""
    m = pm.select(F.col("sku").alias("_msku"), F.col("model").alias("_mmodel")).hint("merge")  # grows: not to the driver
    clicks = (pr.filter(F.col("action_type") == ADD_TO_CART)
              .select(F.col("style_name").alias("_cmodel"), F.col("uid").alias("_cuid"),
                      F.to_date("rent_begin_date").alias("_cday"), "log_source").distinct())
    x = (rcr.filter(F.col("uid") > 0)
         .join(m, rcr["sku"] == m["_msku"], "left")
         .join(clicks, (F.col("_mmodel") == clicks["_cmodel"]) & (rcr["uid"] == clicks["_cuid"])
               & (rcr["rental_begin_date"] == clicks["_cday"].cast("timestamp_ntz")), "inner"))
    return x.select(*[rcr[c] for c in rcr.columns], "log_source").distinct()


def _device_clicks(pr: DataFrame, bd: DataFrame, devices: DataFrame) -> DataFrame:
    dev = bd.join(devices, "device_id", "inner").select("browser_id", "device")
    return pr.join(dev, "browser_id", "inner")


def click_days(pr: DataFrame) -> DataFrame:
    """The click log with the day of each click as ``click_day``, its partition column when it is stored by day."""
    return pr if "click_day" in pr.columns else pr.withColumn("click_day", F.to_date("datetime_cst"))


def _session_clicks(sc: DataFrame, pr: DataFrame) -> DataFrame:
    """Clicks of the sessions' users on the sessions' days.

    The days come first, as a semi-join whose right side has at most one row per day of the
    sessions' span (so it may be broadcast): a log stored by day reads no other partitions.
    """
    wanted = _session_days(sc).select(F.col("uid").alias("_wuid"), F.col("_day").alias("_wday")).distinct()
    days = wanted.select(F.col("_wday").alias("_dday")).distinct()
    c = click_days(pr)
    c = c.join(F.broadcast(days), F.col("click_day") == F.col("_dday"), "left_semi")
    return c.join(wanted, (F.col("uid") == F.col("_wuid")) & (F.col("click_day") == F.col("_wday")), "left_semi")


def user_devices(sc: DataFrame, pr: DataFrame, bd: DataFrame, devices: DataFrame, uco: DataFrame) -> DataFrame:
    users = sc.select("uid").distinct()
    ud = (_device_clicks(pr.join(users, "uid", "left_semi").select("uid", "browser_id").distinct(), bd, devices)
          .select("uid", "device").distinct())
    fo = first_order_dates(uco)
    return (ud.join(fo, "uid", "left")
            .select("uid", "device", F.when(F.col("first_order_date").isNull(), 0).otherwise(1)
                    .alias("checkout_flag")))


def _session_days(sc: DataFrame) -> DataFrame:
    """Each session expanded to the dates of its span [first add, last order or last add]."""
    end = F.when(F.col("first_order").isNotNull(), F.to_date("last_order")).otherwise(F.to_date("last_addto_SC"))
    start = F.to_date("first_addto_SC")
    return (sc.withColumn("_s", start).withColumn("_e", end)
            .filter(F.col("_s") <= F.col("_e"))
            .withColumn("_day", F.explode(F.sequence("_s", "_e")))
            .drop("_s", "_e"))


def session_devices(sc: DataFrame, pr: DataFrame, bd: DataFrame, devices: DataFrame) -> DataFrame:
    seen = _session_clicks(sc, pr).select("uid", "click_day", "browser_id").distinct()
    days = (_device_clicks(seen, bd, devices)
            .select(F.col("uid").alias("_cuid"), F.col("click_day").alias("_cday"), "device").distinct())
    x = _session_days(sc).join(days, (F.col("uid") == days["_cuid"]) & (F.col("_day") == days["_cday"]), "inner")
    return x.select("device", *SESSION_COLS).distinct()


def first_last_device(sc: DataFrame, pr: DataFrame, bd: DataFrame, devices: DataFrame,
                      lo: str, hi: str) -> DataFrame:
    """First and last (non-bot) device of each session whose first add is in [lo, hi]."""
    s = sc.filter(F.col("first_addto_SC").between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")))
    # First and last click per browser first, then per device; clicks at one time are told apart by device.
    seen = _session_clicks(s, pr).groupBy("uid", "click_day", "browser_id").agg(
        F.min("datetime_cst").alias("_lo"), F.max("datetime_cst").alias("_hi"))
    c = _device_clicks(seen, bd, devices).filter(F.col("device") != BOT_DEVICE)
    per_day = c.groupBy(F.col("uid").alias("_cuid"), F.col("click_day").alias("_cday")).agg(
        F.min(F.struct(F.col("_lo").alias("at"), "device")).alias("_first"),
        F.max(F.struct(F.col("_hi").alias("at"), "device")).alias("_last"))
    x = _session_days(s).join(per_day, (F.col("uid") == per_day["_cuid"]) & (F.col("_day") == per_day["_cday"]),
                              "inner")
    keys = ["uid", "LPD_week_start", "style_count", "first_order", "first_addto_SC"]
    return (x.groupBy(*keys)
            .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
            .select(F.col("_first.device").alias("start_device"), F.col("_last.device").alias("last_device"), *keys))


def action_devices(sc: DataFrame, pr: DataFrame, bd: DataFrame, devices: DataFrame) -> DataFrame:
    """Add-to-cart / checkout clicks inside each session, with the session's distinct device count."""
    seen = (_session_clicks(sc, pr.filter(F.col("action_type").isin(ADD_TO_CART, CHECKOUT)))
            .select("uid", "click_day", "browser_id", "action_type", "datetime_cst").distinct())
    c = (_device_clicks(seen, bd, devices)
         .select(F.col("uid").alias("_cuid"), F.col("click_day").alias("_cday"), "device", "action_type", "datetime_cst")
         .distinct())
    vf = (_session_days(sc).join(c, (F.col("uid") == c["_cuid"]) & (F.col("_day") == c["_cday"]), "inner")
          .select("device", "action_type", "datetime_cst", *SESSION_COLS).distinct())
    cnt = (vf.groupBy(F.col("uid").alias("_auid"), F.col("LPD_week_start").alias("_awk"))
           .agg(F.countDistinct("device").alias("device_count")))
    x = vf.join(cnt, (vf["uid"] == cnt["_auid"]) & (vf["LPD_week_start"] == cnt["_awk"]), "left")
    return x.select("device", "action_type", "datetime_cst", "uid", "LPD_week_start", "device_count",
                    "style_count", "first_order", "first_addto_SC")


def device_checkout(bo: DataFrame, ogr: DataFrame, rb: DataFrame, bd: DataFrame, devices: DataFrame,
                    begin_from: str) -> DataFrame:
    g = ogr.filter(F.col("rental_begin_date") >= F.lit(begin_from).cast("date")).select(
        F.col("order_id").alias("_goid"), "reservation_booking_id", "rental_begin_date", "uid")
    r = rb.select(F.col("id").alias("_rbid"), "sku")
    dev = bd.join(devices, "device_id", "inner").select("browser_id", "device")
    return (bo.join(g, bo["order_id"] == g["_goid"], "inner")
            .join(r, F.col("reservation_booking_id") == r["_rbid"], "inner")
            .join(dev, "browser_id", "inner")
            .select("sku", "device", "rental_begin_date", "uid"))


def _switch_sides(pr: DataFrame, pmi: DataFrame, dc: DataFrame, bd: DataFrame,
                  devices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add-to-cart clicks counted per (user, begin date, model, device) and checkouts per (user, begin
    date, sku, its models, device).  Clicks are never expanded to the skus of their model."""
    adds = (_device_clicks(pr.filter(F.col("action_type") == ADD_TO_CART), bd, devices)
            .groupBy("uid", F.to_date("rent_begin_date").alias("rental_begin_date"), F.col("style_name").alias("model"), "device")
            .agg(F.count(F.lit(1)).alias("n")))
    models = pmi.groupBy(F.col("sku").alias("_sku"), "model").agg(F.count(F.lit(1)).alias("_nm")).hint("merge")
    chk = (dc.groupBy("uid", "rental_begin_date", "sku", "device").agg(F.count(F.lit(1)).alias("_nc"))
           .join(models, F.col("sku") == F.col("_sku"), "inner")
           .select("uid", "rental_begin_date", "sku", "model", "device", (F.col("_nc") * F.col("_nm")).alias("n")))
    return adds, chk


def device_switch(pr: DataFrame, pmi: DataFrame, dc: DataFrame, bd: DataFrame, devices: DataFrame) -> DataFrame:
    """Add-to-cart x checkout pairs for the same user, item and begin date, as counts per device pair.

    Both sides are counted before they meet on (user, begin date, model); the pair count of two
    matching groups is the product of their counts.
    """
    adds, chk = _switch_sides(pr, pmi, dc, bd, devices)
    adds = adds.select("uid", "rental_begin_date", "model", F.col("device").alias("add_to_cart_device"), F.col("n").alias("_na"))
    return (chk.withColumnRenamed("device", "checkout_device").join(adds, ["uid", "rental_begin_date", "model"])
            .groupBy("uid", "rental_begin_date", "sku", "checkout_device", "add_to_cart_device")
            .agg(F.sum(F.col("n") * F.col("_na")).cast("bigint").alias("pairs")))


def device_switch_summary(pr: DataFrame, pmi: DataFrame, dc: DataFrame, bd: DataFrame, devices: DataFrame) -> DataFrame:
    """All pairs of :func:`device_switch` and those whose devices differ, from the counts of the two sides alone."""
    adds, chk = _switch_sides(pr, pmi, dc, bd, devices)
    pairs = pair_counts(adds, chk, ["uid", "rental_begin_date", "model"], "device", "n")
    return pairs.agg(F.coalesce(F.sum("pairs"), F.lit(0)).cast("bigint").alias("pairs_total"),
                     F.coalesce(F.sum("pairs_differing"), F.lit(0)).cast("bigint").alias("pairs_switched"))


def log_missing(coverage: DataFrame) -> DataFrame:
    """Cart adds whose matching click has no log source."""
    return coverage.filter(F.col("log_source").isNull())


def profile_cart(rcr: DataFrame, sessions: DataFrame, devices: DataFrame) -> DataFrame:
    """Data-profile probes of the cart report: staged row counts and the device domain (one row)."""
    parts = (rcr.agg(F.lit("cart_rows").alias("m"), F.count(F.lit(1)).alias("v"))
             .unionByName(sessions.agg(F.lit("session_rows").alias("m"), F.count(F.lit(1)).alias("v")))
             .unionByName(devices.agg(F.lit("device_values").alias("m"), F.countDistinct("device").alias("v"))))
    return parts.agg(*[F.max(F.when(F.col("m") == n, F.col("v"))).cast("bigint").alias(n)
                       for n in ("cart_rows", "session_rows", "device_values")])
