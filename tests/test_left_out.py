"""Rows of other bookings are left out of the views beneath their joins; those asked for all stay."""

import datetime as dt

import pytest

from closetops import registry
from closetops.operators import keybits, stage
from closetops.plans import cart, order_issues, reservations
from closetops.sources.bindings import Warehouse

from conftest import SF_SMALL
from test_moved_once import no_broadcast, rows  # noqa: F401


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Lines, orders, parts and events with null keys and with keys that come twice."""
    at = dt.datetime(2024, 1, 3)
    lines = [(o, p, 1, n, 1.0, 10.0, 0.0, 0.0, "N", "O", at) for o in (1, 2, 3, None) for p in (12, 13, None) for n in (1, 2, 1)]
    made = {
        "lineitem": (lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "orders": ([(1, 5, "F", 1.0, at, "1-URGENT"), (2, 5, "F", 1.0, at, "2-HIGH"), (2, 6, "F", 1.0, at, None), (3, None, "O", 1.0, at, "5-LOW")],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "part": ([(p, f"n{p}", "Brand#12", "PROMO", 3, 1.0) for p in (0, 1, 2, 12, 13, 13)],
                 "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "events": ([(e, at, u, k, 1.0, None) for e, u, k in [(1, 1, "purchase"), (1, 1, "purchase"), (2, 1, "click"), (3, 2, None), (None, 2, "click"), (5, None, "purchase")]],
                   "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")}
    path = str(tmp_path_factory.mktemp("odd"))
    for name, (r, schema) in made.items():
        spark.createDataFrame(r, schema).write.parquet(f"{path}/{name}.parquet")
    return Warehouse(spark, path)


TABLES = {"order_group_reservation": ("reservation_booking_id", "group_id"), "reservation_booking": ("id", "order_group_id"),
          "reservation_booking_detail": ("reservation_booking_id", None)}


@pytest.mark.parametrize("name", TABLES)
def test_views_keep_every_row_that_is_asked_for(spark, odd, monkeypatch, name):
    monkeypatch.setattr(keybits, "LEAST_BITS", 1 << 12)
    booking, group = TABLES[name]
    whole = getattr(odd, name)
    for key, held, by in ((booking, ["1-1-12-1-19725", "2-2-13-1-19725", "E1", None], "bookings"), (group, [3, 4, 2000000002, None], "groups")):
        if key is None:
            continue
        asked = spark.createDataFrame([(k,) for k in held], f"k {dict(whole.dtypes)[key]}")
        part = getattr(odd.holding(**{by: keybits.key_bits(asked, "k")}), name)
        want = rows(whole.join(asked, whole[key] == asked["k"], "left_semi"))
        assert want and rows(part.join(asked, part[key] == asked["k"], "left_semi")) == want
        assert part.count() < whole.count()


def test_cart_details_and_reservations_stay_beneath_their_joins(spark, no_broadcast, monkeypatch):  # noqa: F811
    plans = []
    monkeypatch.setattr(cart, "stage", lambda df: plans.append(optimized(df)) or stage(df))
    got = registry.q_cart_bookings(spark, SF_SMALL)
    assert plans[0].count("Join LeftSemi") >= 8  # two tables of lines and of events each, above and beneath their joins
    wh = registry._cart_wh(spark, SF_SMALL)
    whole = cart.cart_bookings(wh.reservation_booking, wh.users, wh.reservation_booking_detail, wh.order_group_reservation, wh.uc_orders,
                               wh.products_master_iid, wh.size_scales, wh.product_prices, registry.CART_LO, registry.CART_HI)
    assert rows(got) == rows(whole) and got.count() > 0


SCANS = "Relation [l_orderkey"


def beneath(text, scan):
    """Whether each scan of lines is the left side of a semi-join that comes before any other join."""
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    lines, found = text.splitlines(), []
    for i, x in enumerate(lines):
        if scan in x:
            above, d = [], depth(x)
            for y in reversed(lines[:i]):
                if depth(y) < d:
                    d = depth(y)
                    above.append(y)
            found.append("LeftSemi" in next((y for y in above if "Join " in y), ""))
    return found


def test_lines_without_add_on_stay_beneath_the_joins(spark, no_broadcast, monkeypatch):  # noqa: F811
    plans = []
    monkeypatch.setattr(reservations, "stage", lambda df: plans.append(optimized(df)) or stage(df))
    got = registry.q_reservation_extras(spark, SF_SMALL)
    assert beneath(optimized(got), SCANS) == [True]
    assert len(plans) == 1 and beneath(plans[0], SCANS).count(True) == 2  # the pointers and the bookings; add-ons are wanted
    wh = registry._wh(spark, SF_SMALL)
    whole = reservations.reservation_extras(wh.order_group_reservation, wh.fulfillment, wh.fulfillment_seq, wh.reservation_booking, wh.products_iid,
                                            wh.products, reservations.unit_barcode_lookup(wh.inventory_unit), registry._unit_loc(wh))
    assert rows(got) == rows(whole) and got.count() > 0


def test_fact_leaves_lines_out_beneath_their_joins(spark, no_broadcast, monkeypatch):  # noqa: F811
    plans = []
    monkeypatch.setattr(reservations, "stage", lambda df: plans.append(optimized(df)) or stage(df))
    registry.q_reservation_fact(spark, SF_SMALL)
    assert all(all(beneath(p, SCANS)) for p in plans)


def test_ledger_is_of_the_asked_orders_and_written_once(spark, no_broadcast, monkeypatch):  # noqa: F811
    plans = []
    monkeypatch.setattr(order_issues, "stage", lambda df: plans.append(optimized(df)) or stage(df))
    got = registry.q_order_issues(spark, SF_SMALL)
    assert len(plans) == 1 and beneath(plans[0], SCANS) == [True, False]  # the ledger; its confirmations have no order
    wh = registry._wh(spark, SF_SMALL)
    whole = order_issues.order_issues(wh.ogr_po, wh.yp_autumn_full, wh.order_group_reservation, wh.financial_line_item,
                                      wh.fli_status_history, registry._refund_view(wh))
    assert rows(got) == rows(whole) and got.count() > 0


def test_both_branches_of_problem_orders_share_their_add_ons(spark, monkeypatch):
    asked = []
    keep = reservations.reservation_extras
    monkeypatch.setattr(registry.rs, "reservation_extras", lambda *a: asked.append(1) or keep(*a))
    got = registry.q_problem_orders(spark, SF_SMALL)
    assert len(asked) == 1
    parts = registry.q_problem_orders_classic(spark, SF_SMALL).unionByName(registry.q_problem_orders_subscription(spark, SF_SMALL))
    assert rows(got) == rows(parts.distinct()) and len(asked) == 3


def test_three_bits_of_a_key_let_few_others_pass(spark):
    held = keybits.key_bits(spark.range(10000), "id")
    assert held.bits == 1 << 18 and keybits.may_meet(spark.range(10000), "id", held).count() == 10000
    assert keybits.may_meet(spark.range(10000, 110000), "id", held).count() < 1000  # one bit: over 3000


def test_a_stage_leaves_no_shuffle_files(spark):
    def shuffled():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
        return {b for b in blocks.split() if b.startswith("shuffle_")}
    before, key = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    made = stage(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count())
    assert not shuffled() - before and spark.conf.get(key) == was
    assert made.count() == 7
