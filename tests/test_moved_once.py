"""Rows that used to be written, exploded or exchanged again and again move once."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from closetops.operators import seqlog
from closetops.operators.aggs import horizon_counts
from closetops.plans import reservations

from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


@pytest.fixture()
def log(spark):
    rng = random.Random(7)
    day = dt.datetime(2024, 1, 1)
    made = [(rng.choice(["hot"] * 6 + ["a", "b", None]), None if i % 17 == 0 else day + dt.timedelta(hours=i), i, f"s{i % 5}")
            for i in range(200)]
    return spark.createDataFrame(made, "k string, at timestamp_ntz, seq bigint, status string")


@pytest.mark.parametrize("limit", [0, 30, 1 << 17])
def test_split_of_heavy_keys_equals_the_window(log, limit):
    heavy = seqlog.heavy_slots(log, ["k"], limit)
    assert (heavy is None) == (limit > 200)
    if limit == 30:
        assert heavy.count() == 1
    got = seqlog.shift_split(log, ["k"], ["at", "seq"], {"prev": "status", "prev_at": "at"}, "lag", F.to_date("at"), heavy)
    w = Window.partitionBy("k").orderBy("at", "seq")
    assert rows(got) == rows(log.withColumn("prev", F.lag("status").over(w)).withColumn("prev_at", F.lag("at").over(w)))


def test_status_log_moves_for_its_join_and_its_window_only(spark, no_broadcast):
    at = dt.datetime(2024, 1, 1)
    f = spark.createDataFrame([("F1", "b", i, f"s{i}", "x", at + dt.timedelta(days=i), None) for i in range(1, 4)],
                              "id string, booking_id string, seq bigint, status string, barcode string, updated_on timestamp_ntz, child_sku string")
    got = reservations.last_two_status(f, spark.createDataFrame([("F1", 3)], "fulfillment_id string, seq bigint"))
    assert plan(got).count("Exchange hashpartitioning") == 3
    assert [(r.fulfillment_seq, r.last2nd_fulfillment_status) for r in got.orderBy("fulfillment_seq").collect()] == [(2, None), (3, "s2")]


def test_fact_rows_stay_where_they_are_for_the_zip(spark, no_broadcast, monkeypatch):
    import closetops.registry as registry
    plans = []
    keep = reservations.stage
    monkeypatch.setattr(reservations, "stage", lambda df: plans.append(plan(df)) or keep(df))
    registry.q_reservation_fact(spark, SF_SMALL)
    assert len(plans) == 2 and not any("hashpartitioning(delivery_postal_code" in p for p in plans)


def test_return_shift_keeps_bookings_where_they_are_for_the_zip(spark, no_broadcast):
    import closetops.registry as registry
    assert "hashpartitioning(_zip" not in plan(registry.q_return_shift(spark, SF_SMALL))


def test_horizons_count_without_a_row_per_probe_and_edge(spark):
    day = dt.date(2024, 1, 1)
    probes = spark.createDataFrame([(1, day), (1, day + dt.timedelta(days=30)), (2, day), (None, day), (1, None)], "u int, d date")
    orders = [(1, i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=12 * i)) for i in range(-3, 200)]
    events = spark.createDataFrame(orders, "u int, o int, t timestamp_ntz")
    got = horizon_counts(probes, events, "u", "d", "o", "t", horizons=(1, 30))
    assert "Generate" not in plan(got)

    def n(u, d, h):
        lo = dt.datetime.combine(d, dt.time())
        return sum(k == u and lo <= t <= lo + dt.timedelta(days=h) for k, _, t in orders)
    want = [(u, d, n(u, d, 1), n(u, d, 30)) for u, d in [(1, day), (1, day + dt.timedelta(days=30)), (2, day)]]
    assert sorted(map(tuple, got.collect())) == want


def test_order_groups_are_told_apart_before_their_joins(spark, no_broadcast, tmp_path):
    from closetops.sources.bindings import Warehouse
    at = dt.datetime(2024, 1, 1)
    made = {"lineitem": ([(1, 1), (1, 3), (1, 2), (2, None), (2, None), (None, 1), (9, 1)], "l_orderkey bigint, l_linenumber int"),
            "orders": ([(1, 5, at), (1, 6, at), (2, 5, at)], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"),
            "customer": ([(5, 3), (5, 3), (6, None)], "c_custkey bigint, c_nationkey int")}
    for name, (r, schema) in made.items():
        spark.createDataFrame(r, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = Warehouse(spark, str(tmp_path)).order_groups
    assert sorted((str(r.group_id), r.order_id, str(r.state)) for r in got.collect()) == [
        ("2", 1, "3"), ("2", 1, "None"), ("3", 1, "3"), ("3", 1, "None"), ("None", 2, "3")]
    assert plan(got).index("HashAggregate") < plan(got).index("Join") < plan(got).rindex("HashAggregate")


def test_coverage_takes_no_join_and_only_orders_of_both_sides(spark, no_broadcast):
    from closetops.plans.order_issues import profile_coverage
    at = lambda d: dt.datetime(2024, 1, d)
    af = spark.createDataFrame(
        [(o, at(d) if d else None, "RFF", "reason", "BOOKING") for o, d in [(1, 5), (1, 3), (2, 9), (None, 1), (4, None), (5, 2)]]
        + [(1, at(30), "SHIPPING", "reason", "BOOKING"), (1, at(1), "RFF", "other", "BOOKING")],
        "order_id bigint, transaction_created timestamp_ntz, annotation_group string, detail_name string, annotation_target string")
    po = spark.createDataFrame(
        [(o, at(d) if d else None, kind, "RENTAL", "P1_2") for o, d, kind in [
            (1, 6, "CLASSIC"), (1, 6, "CLASSIC"), (3, 20, "CLASSIC"), (None, 25, "CLASSIC"), (4, 10, "CLASSIC"), (2, 8, "QUEUE"), (5, None, "CLASSIC")]],
        "order_id bigint, order_datetime_est timestamp_ntz, order_type string, merchandise_category string, sku string")
    got = profile_coverage(af, po)
    assert "Join" not in plan(got)
    assert [tuple(r) for r in got.collect()] == [(at(5), at(2), at(10))]
    assert [tuple(r) for r in profile_coverage(af.limit(0), po).collect()] == [(None, None, None)]


def test_wide_bookings_move_for_the_barcode_not_for_unit_ids(spark, no_broadcast, monkeypatch):
    import closetops.registry as registry
    plans = []
    keep = reservations.stage
    monkeypatch.setattr(reservations, "stage", lambda df: plans.append(plan(df)) or keep(df))
    registry.q_reservation_fact(spark, SF_SMALL)
    joins = [x for p in plans for x in p.splitlines() if "SortMergeJoin [" in x]
    of = lambda key: [i for i, x in enumerate(joins) if f"SortMergeJoin [{key}#" in x]
    assert of("_iulid") and of("barcode")[0] < of("_iulid")[0]
    # Bookings meet their add-ons last, when these have their product and unit.
    extras = [x for x in plan(registry.q_reservation_extras(spark, SF_SMALL)).splitlines() if "SortMergeJoin [" in x]
    assert "[reservation_booking_id#" in extras[0] and "[f_booking_id#" in extras[0]
