"""Rewrites that avoid large intermediates, against the literal forms they replace."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from closetops.functions.temporal import CENTRAL, raw_bounds, shift_zone
from closetops.operators import intervals, profile, ranged, seqlog, sweep
from closetops.operators.aggs import pair_counts
from closetops.plans import ageing, reservations
from closetops.sources.calendar import calendar, on_calendar, spanning
from closetops.sources.sinks import publish

from conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------- factorised pair counts
def test_pair_counts_equal_the_join(spark):
    rng = random.Random(1)

    def side(n):
        return [(rng.choice([1, 2, 3, None]), rng.choice(["m", "n", None]), rng.choice(["a", "b", "c", None]), rng.randint(1, 4))
                for _ in range(n)]
    schema = "u int, k string, device string, n bigint"
    left, right = spark.createDataFrame(side(60), schema), spark.createDataFrame(side(50) + [(9, "m", "a", 1)], schema)
    b = right.select("u", "k", F.col("device").alias("d2"), F.col("n").alias("n2"))
    want = (left.join(b, ["u", "k"]).groupBy("u", "k")
            .agg(F.sum(F.col("n") * F.col("n2")).alias("p"),
                 F.coalesce(F.sum(F.when(F.col("device") != F.col("d2"), F.col("n") * F.col("n2"))), F.lit(0)).alias("q")))
    got = pair_counts(left, right, ["u", "k"], "device", "n")
    assert rows(got.select("u", "k", F.col("pairs").cast("long"), F.col("pairs_differing").cast("long"))) == rows(want)
    assert "Join" not in plan(got)


def test_pairs_of_a_hot_key_are_two_sums(spark):
    hot = spark.range(200_000).select(F.lit(1).alias("u"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("device"),
                                      F.lit(1).cast("bigint").alias("n"))
    r = pair_counts(hot, hot, ["u"], "device", "n").first()
    assert (int(r.pairs), int(r.pairs_differing)) == (200_000 ** 2, 2 * 50_000 * 150_000)


# ------------------------------------------------------------- sweep line
def stretches(spark, n=200):
    rng = random.Random(2)
    day = dt.date(2024, 1, 1)
    got = []
    for i in range(n):
        lo = day + dt.timedelta(rng.randrange(60))
        got.append((rng.choice(["x", "y", None]), lo, lo + dt.timedelta(rng.randrange(-2, 40)), rng.randrange(400)))
    return spark.createDataFrame(got + [("z", day, None, 1), ("z", None, day, 1)], "site string, lo date, hi date, h int")


def test_daily_cover_equals_expanding(spark):
    x, cal = stretches(spark), calendar(spark, "2023-12-01", "2024-06-30")
    counts = {"total": F.lit(True), "long": F.col("h") >= 200, "never": F.col("h").isNull()}
    got = sweep.daily_cover(x, "site", "lo", "hi", counts, cal)
    want = (x.where("lo <= hi").withColumn("asofdate", F.explode(F.sequence("lo", "hi"))).groupBy("asofdate", "site")
            .agg(F.count("*").alias("total"), F.count(F.when(counts["long"], 1)).alias("long"), F.lit(0).alias("never")))
    assert rows(got) == rows(want.select(*got.columns)) and got.count() > 100
    with pytest.raises(Exception, match="no calendar row for 2024"):
        sweep.daily_cover(x, "site", "lo", "hi", counts, calendar(spark, "2023-12-01", "2024-02-01")).collect()
    assert sweep.daily_cover(x.limit(0), "site", "lo", "hi", counts, cal).count() == 0


def test_ageing_report_has_no_row_per_stretch_and_day(spark):
    """Only one row per site is expanded, after the stretches are grouped."""
    text = plan(entry.queries()["q_ageing_bins"](spark, SF_SMALL))
    at = text.index("Generate explode(sequence(_lo")
    assert text.count("Generate") == 1 and "HashAggregate" in text[at:at + 400]


def test_histogram_equals_counting_expanded_days(spark):
    from closetops.registry import AS_OF_EVENTS, IDLE_SINCE, _wh
    wh = _wh(spark, SF_SMALL)
    s = ageing.idle_stretches(seqlog.next_state(wh.inventory_unit, as_of=AS_OF_EVENTS), IDLE_SINCE)
    old = ageing.ageing_bins(ageing.expand_days(s, wh.dates, AS_OF_EVENTS))
    new = ageing.ageing_histogram(s, wh.dates, AS_OF_EVENTS)
    assert rows(new.select(*old.columns)) == rows(old)


# ------------------------------------------------------------- neighbours with one exchange
@pytest.mark.parametrize("direction", ["lead", "lag"])
def test_shift_exchanges_the_log_once(spark, direction):
    rng = random.Random(3)
    log = spark.createDataFrame([(rng.choice([1, 1, 1, 2, None]), i, f"v{i}") for i in range(300)], "k int, o int, v string")
    got = seqlog.shift_within(log, ["k"], ["o"], {"x": "v"}, direction, F.floor(F.col("o") / 16))
    fn = F.lead if direction == "lead" else F.lag
    assert rows(got) == rows(log.withColumn("x", fn("v").over(Window.partitionBy("k").orderBy("o"))))
    # besides the window's, exchanges hold edge rows: below each there is an aggregate
    below = [x for x in re.split(r"\n.*Exchange ", plan(got).split("== Initial Plan ==")[-1])[1:]]
    assert sum("Scan" in x and "Aggregate" not in x.split("Scan")[0] for x in below) == 1


# ------------------------------------------------------------- interval index
def boxes(spark, n, key=lambda i: i % 3):
    rng = random.Random(4)
    day = dt.datetime(2020, 1, 1)
    got = []
    for i in range(n):
        a, b = day + dt.timedelta(hours=rng.randrange(20_000)), dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(900))
        got.append((f"m{key(i)}", a, a + dt.timedelta(hours=rng.choice([-1, 0, 30, 500, 9000])), b,
                    b + dt.timedelta(rng.choice([0, 10, 700])), i))
    return spark.createDataFrame(got, "bm string, alo timestamp_ntz, ahi timestamp_ntz, blo date, bhi date, box int")


def test_interval_join_equals_the_plain_join(spark):
    rng = random.Random(5)
    day = dt.datetime(2019, 12, 1)
    pts = [(rng.choice(["m0", "m1", "m7", None]), day + dt.timedelta(hours=rng.randrange(24_000)),
            (day + dt.timedelta(days=rng.randrange(1000))).date(), i) for i in range(300)]
    pts = spark.createDataFrame(pts + pts[:3] + [("m0", None, None, -1)], "m string, a timestamp_ntz, b date, i int")
    bx = boxes(spark, 400)
    got = intervals.interval_join(pts, bx, ("m", "bm"), [("a", "alo", "ahi"), ("b", "blo", "bhi")])
    want = pts.join(bx, (F.col("m") == F.col("bm")) & F.col("a").between(F.col("alo"), F.col("ahi"))
                    & F.col("b").between(F.col("blo"), F.col("bhi")))
    assert rows(got.select("m", "i", "box")) == rows(want.select("m", "i", "box")) and got.count() > 100


def test_windows_of_one_key_spread_over_cells(spark, monkeypatch):
    """10,000 windows of one model: no join key holds more than a few of them."""
    start = dt.date(2000, 1, 1)
    bx = spark.range(10_000).select(
        F.lit("m").alias("bm"), F.date_add(F.lit(start), F.col("id").cast("int")).alias("lo"),
        F.date_add(F.lit(start), F.col("id").cast("int") + 5).alias("hi"), F.col("id").alias("box"))
    pts = spark.range(10_000).select(F.lit("m").alias("m"), F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    got = intervals.interval_join(pts, bx, ("m", "bm"), [("d", "lo", "hi")])
    assert got.count() == 10_000 * 6 - 15
    held = {}
    for r in bx.select(F.unix_date("lo").alias("lo"), F.unix_date("hi").alias("hi")).collect():
        for c in range(r.lo // intervals.CELL, r.hi // intervals.CELL + 1):
            held[c] = held.get(c, 0) + 1
    assert max(held.values()) <= 2 * intervals.CELL and "_ic0" in plan(got)


# ------------------------------------------------------------- usage rank and row numbers
def test_usage_of_a_table_mostly_without_units(spark):
    rng = random.Random(6)
    day = dt.date(2024, 1, 1)
    got = [(None if i % 10 else rng.randrange(4), rng.choice(["12345678", "1", None]), i,
            rng.choice([None, *[day + dt.timedelta(d) for d in range(5)]])) for i in range(1000)]
    fact = spark.createDataFrame(got, "unit_id int, barcode string, reservation_booking_id int, rental_begin_date date")
    ok = F.col("unit_id").isNotNull() & (F.length("barcode") == 8)
    w = Window.partitionBy("unit_id")
    order = w.orderBy(F.col("rental_begin_date").asc_nulls_first()).rangeBetween(Window.unboundedPreceding, 0)
    want = fact.select("*", F.when(ok, F.count("reservation_booking_id").over(order)).alias("r"),
                       F.when(ok, F.count("reservation_booking_id").over(w)).alias("t"))
    u = reservations.unit_usage(fact)
    assert rows(u) == rows(want)
    join_inputs = plan(u)
    assert "isnotnull(unit_id" in join_inputs and "REPARTITION" not in join_inputs


def test_row_numbers_are_cut_where_the_rows_are(spark):
    """One key with nearly all rows, all in one year."""
    x = spark.range(40_000).select(
        F.when(F.col("id") % 100 == 0, F.col("id") % 7).when(F.col("id") % 100 == 1, None).otherwise(-1).alias("k"),
        F.date_add(F.lit("2017-01-01").cast("date"), (F.col("id") % 360).cast("int")).alias("d"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces, nk = ranged.range_pieces(x, ["k"], ["d", "id"])
        most = pieces.groupBy(ranged._PART).count().agg(F.max("count")).first()[0]
        assert most < 40_000 / 4 and ranged.counts_ahead(pieces, nk).count() < 8
        got = ranged.row_number_ranged(x, ["k"], ["d", "id"], "n")
        want = x.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("d", "id")))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        one = x.withColumn("v", F.col("id") % 5)
        got = ranged.running_sum_ranged(one, ["k"], ["d", "id"], "v", "s", "t")
        w = Window.partitionBy("k")
        want = one.withColumn("s", F.sum("v").over(w.orderBy("d", "id").rowsBetween(Window.unboundedPreceding, 0))).withColumn(
            "t", F.sum("v").over(w))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


# ------------------------------------------------------------- bounds, calendar, profile, publish
def test_window_on_a_shifted_time_reaches_the_scan(spark, tmp_path):
    hours = spark.range(24 * 400).select(
        (F.lit("2016-12-01 00:30:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("t"))
    hours.write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    lo, hi = "2017-01-01", "2017-11-06"
    edge = lambda d: F.lit(d).cast("date").cast("timestamp_ntz")
    exact = shift_zone("t", CENTRAL, "UTC").between(edge(lo), edge(hi))
    got = log.filter(raw_bounds("t", lo, hi)).filter(exact)
    assert got.count() == log.filter(exact).count() > 7000
    pushed = [x for x in plan(got).splitlines() if "PushedFilters" in x][0]
    assert "GreaterThanOrEqual(t,2016-12-31T00:00" in pushed and "LessThanOrEqual(t,2017-11-07T00:00" in pushed


def test_a_date_outside_the_calendar_fails(spark):
    facts = spark.createDataFrame([(1, dt.date(2035, 5, 5)), (2, dt.date(2020, 1, 1)), (3, None)], "i int, d date")
    with pytest.raises(Exception, match="no calendar row for 2035-05-05"):
        on_calendar(facts, calendar(spark), "d").collect()
    full = on_calendar(facts, spanning(facts, "d"), "d")
    assert rows(full.select("i", "calendar_year")) == [(1, 2035), (2, 2020)]
    assert spanning(facts.limit(0), "d").count() == calendar(spark).count()


def test_profile_of_columns(spark):
    x = spark.createDataFrame([("a", 1), ("a", None), (None, 3), ("b", 3)], "s string, `n.x` int")
    assert rows(profile.profile_columns(x)) == [("n.x", 4, 1, 2, "1", "3"), ("s", 4, 1, 2, "a", "b")]
    assert profile.profile_columns(x.limit(0)).count() == 0


def test_publish_swaps_a_finished_report_in(spark, tmp_path):
    path = f"{tmp_path}/report"
    publish(spark.range(5), path=path)
    with pytest.raises(Exception, match="stop"):
        publish(spark.range(3).select(F.raise_error(F.lit("stop")).alias("id")), path=path)
    assert spark.read.parquet(path).count() == 5
    publish(spark.read.parquet(path).where("id > 1"), path=path)  # a report may read what it replaces
    assert rows(spark.read.parquet(path)) == [(2,), (3,), (4,)]
    assert [p.name for p in tmp_path.iterdir() if ".replaced" in p.name] == []


def test_publish_replaces_only_its_partitions(spark, tmp_path):
    path = f"{tmp_path}/months"
    month = spark.range(4).select("id", (F.col("id") % 2).alias("m"))
    publish(month, path=path, partition_by=["m"])
    publish(spark.createDataFrame([(9, 1)], "id long, m long"), path=path, partition_by=["m"], replace="partitions")
    assert rows(spark.read.parquet(path).select("id", "m")) == [(0, 0), (2, 0), (9, 1)]
    with pytest.raises(ValueError):
        publish(month, path=path, replace="partitions")


def test_warehouse_dimensions_grow_with_the_input(spark):
    """No fixed number of models, units or browsers."""
    from closetops.registry import _wh
    small, large = (_wh(spark, f"/root/testdata/{d}") for d in ("sf0.001", "sf0.01"))
    for table, col in (("pixel_raw2", "style_name"), ("browser_device", "browser_id"), ("order_group_reservation", "barcode"),
                       ("fulfillment", "barcode"), ("finance_current_view_inventory", "barcode")):
        n, m = (getattr(w, table).select(col).distinct().count() for w in (small, large))
        assert m > 4 * n, (table, n, m)


# ------------------------------------------------------------- rollup and click log
def test_rollup_equals_the_rollup_of_the_joined_facts(spark):
    from closetops import registry
    from closetops.plans import order_issues as oi
    wh = registry._wh(spark, SF_SMALL)
    want = oi.issue_rollup(registry._order_issues(wh))
    got = registry._rollup(wh).select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() > 1000


def test_rollup_of_orders_with_several_groups(spark):
    """Bookings, annotations and replacements of one order in all combinations of groups."""
    from closetops.plans import order_issues as oi
    po, af, ogr = [], [], []
    for o in range(64):
        for g in range(3):
            if o >> g & 1:
                po.append((o, 1, g, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1), f"b{o}-{g}", dt.datetime(2020, 1, 1), "e", "D",
                           dt.date(2020, 1, 2), dt.date(2020, 1, 1 + o % 2 * g), "x" if (o + g) % 3 else None, "CLASSIC", "RENTAL", "P1"))
            if o >> (3 + g) & 1:
                ogr.append((f"r{o}-{g}", g, "P1"))
                af.append((o, "REPLACEMENT", "reason", f"r{o}-{g}", ["PO_SWAP", "FIT", None][(o + g) % 3]))
        af.append((o, ["RFF", "SHIPPING", "QUALITY_ISSUE", "OTHER"][o % 4], "reason", None, None))
    po = spark.createDataFrame(po, "order_id long, uid int, group_id long, order_datetime_est timestamp_ntz, group_created_est "
                               "timestamp_ntz, reservation_booking_id string, reservation_created timestamp_ntz, email string, type string, "
                               "last_possible_begin_date date, rental_begin_date date, po_category string, order_type string, "
                               "merchandise_category string, sku string")
    af = spark.createDataFrame(af, "order_id long, annotation_group string, detail_name string, annotation_target_id string, detail_value string")
    ogr = spark.createDataFrame(ogr, "reservation_booking_id string, group_id long, sku string")
    fli = spark.createDataFrame([(1, 3, "OUT", 2), (2, 3, "IN", 9), (3, 7, "OUT", 4)], "id int, order_id long, direction string, subtotal int")
    fsh = spark.createDataFrame([(1, "CONFIRMED"), (1, "CONFIRMED"), (2, "CONFIRMED")], "fli_id int, to_status string")
    none = spark.createDataFrame([], "order_id long, refund decimal(38,6)")
    want = oi.issue_rollup(oi.order_issues(po, af, ogr, fli, fsh, none))
    got = oi.order_rollup(po, af, ogr, fli, fsh).select(*want.columns)
    assert rows(got) == rows(want) and got.where("rpl_po_order_id IS NOT NULL").count() > 5


def test_a_click_log_stored_by_day_is_read_for_session_days_only(spark, tmp_path):
    from closetops import registry
    from closetops.plans import cart
    wh = registry._wh(spark, SF_SMALL)
    cart.click_days(wh.pixel_raw2).write.partitionBy("click_day").parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    registry._sessions(wh).write.parquet(f"{tmp_path}/sessions")
    sessions = spark.read.parquet(f"{tmp_path}/sessions").where("uid % 7 = 1")
    got = cart.session_devices(sessions, log, wh.browser_device, wh.devices)
    assert "dynamicpruning" in plan(got)
    assert rows(got) == rows(cart.session_devices(sessions, wh.pixel_raw2, wh.browser_device, wh.devices))
