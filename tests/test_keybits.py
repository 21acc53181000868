"""Rows that can't meet a join's other side don't move for it; all others stay."""

import pytest
from pyspark.sql import functions as F

from closetops import registry
from closetops.operators import keybits, stage
from closetops.plans import order_issues, reservations

from conftest import SF_SMALL
from test_moved_once import no_broadcast, plan, rows  # noqa: F401


@pytest.mark.parametrize("of", ["bigint", "string"])
def test_rows_with_a_key_all_stay_and_most_others_go(spark, monkeypatch, of):
    monkeypatch.setattr(keybits, "LEAST_BITS", 1 << 10)
    key = F.col("id").cast(of).alias("k")
    held = keybits.key_bits(spark.range(0, 3000, 3).select(key).unionAll(spark.sql(f"SELECT CAST(NULL AS {of})")), "k")
    log = spark.range(3000).select(key).unionAll(spark.range(30).select(key)).unionAll(spark.sql(f"SELECT CAST(NULL AS {of})"))
    got = [r.k for r in keybits.may_meet(log, "k", held).collect() if r.k is not None]
    wanted = [k for k in got if int(k) % 3 == 0]
    assert len(wanted) == 1000 + 10 and len(got) - len(wanted) < 600


def test_few_bits_lose_no_row(spark, monkeypatch):
    monkeypatch.setattr(keybits, "MOST_BITS", 1 << 12)
    monkeypatch.setattr(keybits, "LEAST_BITS", 1 << 12)
    held = keybits.key_bits(spark.range(20000), "id")
    assert held.bits == 1 << 12 and keybits.may_meet(spark.range(20000), "id", held).count() == 20000


def test_empty_keys_and_keys_of_another_type(spark):
    none = keybits.key_bits(spark.range(0), "id")
    assert keybits.may_meet(spark.range(5), "id", none).count() == 0
    held = keybits.key_bits(spark.range(2), "id")
    assert keybits.may_meet(spark.range(5).select(F.col("id").cast("int")), "id", held).count() == 5
    half = spark.range(2).select(F.col("id").cast("double").alias("id"))
    assert keybits.may_meet(half, "id", keybits.key_bits(half, "id")).count() == 2


def test_fact_leaves_other_bookings_out_and_is_made_distinct_where_it_is(spark, no_broadcast, monkeypatch):  # noqa: F811
    plans = []
    monkeypatch.setattr(reservations, "stage", lambda df: plans.append(plan(df)) or stage(df))
    fact = registry.q_reservation_fact(spark, SF_SMALL)
    booked, wide = plans
    assert "_kb_block" in booked
    assert wide.count("_kb_block") >= 5  # details, log, pointers and both return dates
    assert plan(fact).count("Exchange hashpartitioning") == 2  # the rows and their counts, by group


def test_replacements_leave_other_bookings_out(spark, no_broadcast):  # noqa: F811
    wh = registry._wh(spark, SF_SMALL)
    got = order_issues.replacements(wh.yp_autumn_full, wh.order_group_reservation)
    assert "_kb_block" in plan(got)
    a = wh.yp_autumn_full.filter("annotation_group = 'REPLACEMENT' AND detail_name = 'reason'")
    g = wh.order_group_reservation
    assert rows(got) == rows(a.join(g, a["annotation_target_id"] == g["reservation_booking_id"]).select(
        a["order_id"], "group_id", "annotation_target_id", "detail_value").distinct())
