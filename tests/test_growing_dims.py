"""Tables that grow with the shop aren't gathered at the driver, however small their files are."""

import datetime as dt

from closetops.operators.intervals import interval_join
from closetops.sources.bindings import Warehouse

from conftest import SF_SMALL


def joins(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("SortMergeJoin"), plan.count("BroadcastExchange")


def test_price_windows_are_merged(spark):
    day = dt.date(2024, 1, 5)
    points = spark.createDataFrame([("m", day), ("n", day), (None, day)], "k string, d date")
    boxes = spark.createDataFrame([("m", day, day, 1), ("m", day, day, 2), ("n", dt.date(2024, 1, 6), day, 3)],
                                  "kk string, lo date, hi date, v int")
    got = interval_join(points, boxes, ("k", "kk"), [("d", "lo", "hi")])
    assert joins(got) == (2, 0)
    assert sorted(r.v for r in got.collect()) == [1, 2]


def test_models_of_cart_events_are_merged(spark):
    assert joins(Warehouse(spark, SF_SMALL)._cart_events()) == (1, 0)


def test_cart_reports_broadcast_no_orders_or_parts(spark):
    from closetops import registry
    wh = registry._cart_wh(spark, SF_SMALL)
    assert joins(wh.reservation_booking_detail) == (3, 0)
    assert joins(wh.order_group_reservation) == (3, 0)
    for name in ("q_log_coverage", "q_device_switch"):
        plan = registry.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().sparkPlan().toString()
        assert [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "sku" in x] == []


def test_stored_bindings_serve_the_cart_reports(spark, tmp_path, monkeypatch):
    from closetops import registry
    monkeypatch.setattr(registry, "_WAREHOUSES", {})
    assert registry._cart_wh(spark, SF_SMALL) is not registry._wh(spark, SF_SMALL)
    registry._wh(spark, SF_SMALL).materialize(["users"], str(tmp_path))
    assert registry._cart_wh(spark, SF_SMALL) is registry._wh(spark, SF_SMALL)
