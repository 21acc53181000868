"""Hand-written rows for report rules: priority ladders, union by name, leakage dating."""

import datetime as dt

from closetops.plans import problem_orders as po

D = dt.date(2001, 8, 1)


def _apr(spark, rows):
    return spark.createDataFrame(
        [(i, f"b{i}", D, "RENTAL", "D", "u@x.org", "SUB", cat, reason, f"P{i}_1", "CLASSIC", i)
         for i, (cat, reason) in enumerate(rows)],
        "group_id bigint, reservation_booking_id string, rental_begin_date date, merchandise_category string, "
        "type string, mail string, sub_type string, po_category string, po_reason string, sku string, "
        "order_type string, k int").drop("k")


def test_classic_reason_ladder(spark):
    rows = [(None, "whatever"),            # limbo, no category -> Extra PO (booking 0 is in limbo)
            ("Predicted", "Late truck"),   # -> Lateness
            ("Warehouse", "allogator x"),  # -> ALLOGATOR UNKNOWN
            (None, "Predicted"),           # -> NULL
            ("Warehouse", "Item missing"), # -> Missing
            ("Other", "kept")]             # -> kept
    apr = _apr(spark, rows)
    pmi = spark.createDataFrame([(f"P{i}_1", "N") for i in range(len(rows))], "sku string, special_type string")
    extras = spark.createDataFrame([("b0", "C1", "ITEM_LIMBO")],
                                   "reservation_booking_id string, child_sku string, last_fulfillment_status string")
    out = {r.reservation_booking_id: r for r in
           po.problem_orders_classic(apr, pmi, extras, "2001-09-01", "staff.example.com").collect()}
    assert [out[f"b{i}"].po_reason for i in range(6)] == ["Extra PO", "Lateness", "ALLOGATOR UNKNOWN", None,
                                                          "Missing", "kept"]
    assert out["b0"].po_category == "Warehouse" and out["b0"].extra_reservation_booking_id == "b0"
    assert out["b0"].po_parent_group_id is None and out["b0"].po_parent_extra_group_id == 0
    assert out["b5"].email == "non staff_email"


def test_subscription_union_by_name(spark):
    cols = po.SUB_COLS
    base = {c: None for c in cols}
    ts = dt.datetime(2001, 8, 1)

    def frame(order, extra_rows):
        rows = []
        for r in extra_rows:
            v = dict(base, **r)
            rows.append(tuple(v[c] for c in order))
        types = {"rental_begin_date": "date", "last_fulfillment_updated_on": "timestamp_ntz",
                 "last2nd_fulfillment_updated_on": "timestamp_ntz", "cancel_flag": "int"}
        schema = ", ".join(f"{c} {types.get(c, 'string')}" for c in order)
        return spark.createDataFrame(rows, schema)

    common = dict(fulfillment_id="f", rental_begin_date=D, merchandise_category="RENTAL", product_type="D",
                  order_id="1", group_id="1", sku="s", order_type="QUEUE", last_fulfillment_updated_on=ts)
    canceled_cols = [c for c in cols if c not in ("child_sku", "cancel_flag")] + ["order_type"]
    canceled = frame(canceled_cols, [dict(common, reservation_booking_id="c", mail="m1")])
    ogr = frame(canceled_cols, [dict(common, reservation_booking_id="o", mail="m2")])
    # extras list mail and child_sku in the other order
    ex_cols = [c for c in cols if c != "cancel_flag"] + ["order_type"]
    ex_cols[ex_cols.index("child_sku")], ex_cols[ex_cols.index("mail")] = "mail", "child_sku"
    extras = frame(ex_cols, [dict(common, reservation_booking_id="e", mail="m3", child_sku="C9")])
    src = {r.reservation_booking_id: r for r in po.subscription_sources(canceled, ogr, extras, "2001-09-01").collect()}
    assert src["e"].mail == "m3" and src["e"].child_sku == "C9"
    assert src["c"].child_sku is None and src["c"].cancel_flag == 1 and src["o"].cancel_flag == 0
