"""Rewrites equal their literal forms (checked inside Spark on hand-written and random rows)."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from closetops.operators.aggs import count_distinct_ifs, cumulative, horizon_counts
from closetops.operators.seqlog import last_k_by_seq, row_number_within
from closetops.plans import ageing
from closetops.plans.reservations import shift_return_date, transit_fallback
from closetops.sources.calendar import calendar


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))


def test_horizon_counts_equal_pairwise(spark):
    base = dt.date(2020, 3, 1)
    rows = []
    oid = 0
    # edges: day 0, 30, 31, 365, 366, exact midnight of day N and a second after
    for uid, offs in ((1, [0, 30, 31, 365, 366]), (2, [0.0, 30.0, 30.00001, 29.99])):
        for o in offs:
            rows.append((uid, oid, dt.datetime.combine(base, dt.time()) + dt.timedelta(days=o)))
            oid += 1
    rng = random.Random(7)
    for _ in range(300):
        rows.append((rng.randint(3, 8), oid, dt.datetime(2020, 1, 1) + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 500))))
        oid += 1
    # orders with several times count once in a window
    several = [(u, o, t + dt.timedelta(days=d)) for u, o, t in rows[::9] for d in (3, 3, 45, 170)]
    rows += [(1, None, rows[0][2]), (None, 1, rows[0][2]), (1, 0, None), *several]
    orders = spark.createDataFrame(rows, "uid bigint, order_id bigint, ts timestamp_ntz")
    probes = spark.createDataFrame([(u, base + dt.timedelta(days=d)) for u in range(1, 10) for d in (0, 17, 200)]
                                   + [(None, base), (4, None)], "uid bigint, rbd date")
    hz = horizon_counts(probes, orders, "uid", "rbd", "order_id", "ts")
    got = {(r.uid, r.rbd): tuple(r[f"orders_in_{n}d"] for n in (30, 60, 90, 180, 270, 365)) for r in hz.collect()}
    pairs = probes.alias("p").join(orders.alias("o"), "uid", "left")
    lit = pairs.groupBy("uid", "rbd").agg(*[
        F.countDistinct(F.when(F.col("ts").between(F.col("rbd"), F.date_add("rbd", n)), F.col("order_id")))
        .alias(f"n{n}") for n in (30, 60, 90, 180, 270, 365)])
    for r in lit.collect():
        want = tuple(r[f"n{n}"] for n in (30, 60, 90, 180, 270, 365))
        assert got.get((r.uid, r.rbd), (0,) * 6) == want, (r.uid, r.rbd)
    # nested horizons never decrease
    assert all(list(v) == sorted(v) for v in got.values())


def test_cumulative_equals_triangular_join(spark):
    rows = [("a", 0, 1.0), ("a", 0, 2.0), ("a", 2, None), ("a", 5, 4.0), ("b", 1, 3.0), (None, 1, 9.0)]
    df = spark.createDataFrame(rows, "sku string, m int, v double")
    win = cumulative(df.filter(F.col("sku").isNotNull()), "sku", "m", F.col("v"), "run")
    a, a1 = df.alias("a"), df.alias("a1")
    lit = (a.join(a1, (F.col("a.sku") == F.col("a1.sku")) & (F.col("a.m") <= F.col("a1.m")))
           .groupBy("a1.sku", "a1.m", "a1.v").agg(F.sum("a.v").alias("run")))
    assert _rows(win.select("sku", "m", "v", "run")) == _rows(lit)


def test_count_distinct_ifs(spark):
    df = spark.createDataFrame([(1, "x", True), (1, "y", True), (2, "x", False), (None, "x", True)],
                               "id int, g string, c boolean")
    got = count_distinct_ifs(df, {"all_c": (F.col("c"), F.col("id")), "gx": (F.col("g") == "x", F.col("id")),
                                  "none": (F.lit(False), F.col("id"))}).first()
    assert (got.all_c, got.gx, got["none"]) == (1, 2, 0)


def test_row_number_within_equals_window(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), dt.date(2019, 1, 1) + dt.timedelta(days=rng.randint(0, 900)), i)
            for i in range(200)]
    df = spark.createDataFrame(rows, "k string, d date, i int")
    got = row_number_within(df, ["k"], ["d", "i"], F.year("d"), "rn")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("d", "i")))
    assert _rows(got) == _rows(want)


def test_last_k_by_seq(spark):
    log = spark.createDataFrame([("f1", 1), ("f1", 2), ("f1", 3), ("f2", 1)], "id string, seq bigint")
    ptr = spark.createDataFrame([("f1", 3), ("f2", 1)], "fulfillment_id string, seq bigint")
    got = _rows(last_k_by_seq(log, ptr).select("id", "seq"))
    assert got == [("f1", 2), ("f1", 3), ("f2", 1)]


def test_expand_days_equals_calendar_range_join(spark):
    t = dt.datetime
    rows = [  # (id, aging_date, next_updated_on)
        (1, t(2024, 1, 1, 10, 0), t(2024, 1, 3, 10, 0)),     # boundaries exactly at 10:00
        (2, t(2024, 1, 1, 10, 0, 1), t(2024, 1, 3, 9, 59)),  # just after / before
        (3, t(2024, 1, 5, 0, 0), t(2024, 1, 4, 0, 0)),       # lo > hi
        (4, t(2024, 1, 28, 0, 0), t(2024, 2, 10, 0, 0)),     # capped by as_of
    ]
    df = spark.createDataFrame(rows, "id int, aging_date timestamp_ntz, next_updated_on timestamp_ntz") \
        .withColumn("cur_location_station", F.lit("CLICK")).withColumn("barcode", F.lit("91234567"))
    cal = calendar(spark, "2023-12-01", "2024-03-31")
    got = _rows(ageing.expand_days(df, cal, as_of="2024-02-01").select("id", "asofdate"))
    ten = F.make_dt_interval(F.lit(0), F.lit(10))
    lit = (df.join(cal, ((F.col("asofdate").cast("timestamp_ntz") + ten) >= F.col("aging_date"))
                   & ((F.col("asofdate").cast("timestamp_ntz") + ten) <= F.col("next_updated_on")))
           .filter(F.col("asofdate") < F.lit("2024-02-01").cast("date")).select("id", "asofdate"))
    assert got == _rows(lit)


def test_ageing_bin_edges(spark):
    hours = [47, 48, 71, 72, 239, 240, 719, 720, 4319, 4320]
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "S", h) for h in hours],
                               "asofdate date, cur_location_site string, time_to_next_scan bigint")
    r = ageing.ageing_bins(df).first()
    assert (r.total, r.days_2_3, r.days_3_10, r.days_10_30, r.days_30_180, r.days_180_plus) == (10, 2, 2, 2, 2, 1)
    assert sum(r[n] for n in ageing.BIN_NAMES) == r.total - 1  # 47 h falls in no bin


def test_transit_fallback_priority(spark):
    smt = spark.createDataFrame([("a", 2, 1), ("b", 6, 3), ("c", 2, 2), ("c", 6, 4), ("d", 9, 7)],
                                "destination_zip_code string, shipping_method_id bigint, transit_days bigint")
    got = dict((r[0], r[1]) for r in transit_fallback(smt).collect())
    assert got == {"a": 1, "b": 3, "c": 2, "d": 5}


def test_shift_return_date(spark):
    t = dt.datetime
    # expected_begin weekday: 2024-01-06 Saturday (7), 2024-01-08 Monday (2), 2024-01-10 Wednesday (4)
    rows = [(1, t(2024, 1, 6), t(2024, 1, 9), dt.date(2024, 1, 10), "sat/1"),
            (2, t(2024, 1, 6), t(2024, 1, 9), dt.date(2024, 1, 6), "sat/2"),
            (2, t(2024, 1, 6), t(2024, 1, 9), dt.date(2024, 1, 8), "mon/2"),
            (2, t(2024, 1, 6), t(2024, 1, 10), dt.date(2024, 1, 6), "4day"),
            (None, t(2024, 1, 6), t(2024, 1, 9), dt.date(2024, 1, 6), "null")]
    df = spark.createDataFrame(rows, "tr int, b timestamp_ntz, e timestamp_ntz, eb date, tag string")
    df = df.withColumn("ee", F.lit(dt.date(2024, 1, 20)))
    got = {r.tag: r.v for r in df.select("tag", shift_return_date(F.col("tr"), F.col("b"), F.col("e"), F.col("eb"),
                                                                   F.col("ee")).alias("v")).collect()}
    assert got == {"sat/1": dt.date(2024, 1, 19), "sat/2": dt.date(2024, 1, 22), "mon/2": dt.date(2024, 1, 21),
                   "4day": dt.date(2024, 1, 20), "null": dt.date(2024, 1, 20)}


def test_anti_join_null_keys(spark):
    left = spark.createDataFrame([(1,), (None,), (2,)], "g int")
    right = spark.createDataFrame([(1,), (None,)], "g int")
    anti = _rows(left.join(right, "g", "left_anti"))
    lit = _rows(left.alias("l").join(right.alias("r"), F.col("l.g") == F.col("r.g"), "left")
                .filter(F.col("r.g").isNull()).select("l.g"))
    assert anti == lit


def test_last_two_status_interleaved_fulfillments(spark):
    """Previous status is LAG over the booking: it can come from the booking's other fulfillment."""
    from closetops.plans.reservations import last_two_status
    t = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([
        ("F1", "B", 1, "RESERVED", "1", t, None),
        ("F1", "B", 2, "SHIPPED", "1", t + dt.timedelta(hours=2), None),
        ("F2", "B", 1, "RESERVED", "2", t + dt.timedelta(hours=1), None),
        ("F2", "B", 2, "ITEM_LIMBO", "2", t + dt.timedelta(hours=3), None),
        ("F3", "C", 1, "RESERVED", "3", t, None),                  # one row only
    ], "id string, booking_id string, seq bigint, status string, barcode string, updated_on timestamp_ntz, "
       "child_sku string")
    ptr = spark.createDataFrame([("F1", 2), ("F2", 2), ("F3", 1)], "fulfillment_id string, seq bigint")
    got = {(r.fulfillment_id, r.fulfillment_seq): r.last2nd_fulfillment_status
           for r in last_two_status(log, ptr).collect()}
    assert got == {("F1", 1): None, ("F2", 1): "RESERVED", ("F1", 2): "RESERVED", ("F2", 2): "SHIPPED",
                   ("F3", 1): None}


def test_group_count_back_matches_window_with_null_keys(spark):
    from closetops.operators.seqlog import group_count_back
    df = spark.createDataFrame([("g1", 1), ("g1", None), ("g1", 3), (None, 4), (None, 5), ("g2", None)],
                               "g string, v int")
    got = _rows(group_count_back(df, ["g"], F.col("v"), "n"))
    want = _rows(df.withColumn("n", F.count("v").over(Window.partitionBy("g"))))
    assert got == want
