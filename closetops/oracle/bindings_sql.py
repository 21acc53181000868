"""DuckDB twins of ``closetops.sources.bindings``.

Every warehouse table is written again here as one DuckDB SELECT over the raw
driver views (region nation customer supplier part orders lineitem events).
``compose`` prepends, as CTEs, exactly the bindings a query mentions (and
their own dependencies), so each oracle query is a single self-contained SQL
string.
"""

from __future__ import annotations

import re

# Fixed values of the synthetic warehouse (same as the Spark side).
INTERNAL_DOMAIN = "staff.example.com"
PUBLIC_DOMAIN = "mail.example.org"

BOOKING_ID = ("concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar), "
              "cast(l_partkey as varchar), cast(l_suppkey as varchar), "
              "cast(date_diff('day', date '1970-01-01', cast(l_shipdate as date)) as varchar))")


def _barcode(u: str, k: str) -> str:
    return f"cast(10000000 + (({u}) * 7919917 + ({k}) * 1299709) % 90000000 as varchar)"


def _sku(p: str, size: str) -> str:
    n = f"(({p}) // 10)"
    return (f"CASE WHEN ({p}) % 10 = 0 THEN 'SS' || cast({p} as varchar) "
            f"WHEN ({p}) % 10 = 1 THEN 'XX' || cast({n} as varchar) || "
            f"CASE WHEN {n} % 2 = 0 THEN '_ONE SIZE' ELSE '_One Size' END "
            f"ELSE 'P' || cast({p} as varchar) || '_' || cast({size} as varchar) END")


def _order_type(pr: str) -> str:
    return (f"CASE WHEN {pr} = '1-URGENT' THEN 'QUEUE' WHEN {pr} = '5-LOW' THEN 'STORE_PICKUP' "
            f"WHEN {pr} = '4-NOT SPECIFIED' THEN 'CLASSIC_POSH' ELSE 'CLASSIC' END")


def _mail(c: str) -> str:
    return (f"('user' || cast({c} as varchar) || '@' || CASE WHEN {c} % 9 = 0 "
            f"THEN '{INTERNAL_DOMAIN}' ELSE '{PUBLIC_DOMAIN}' END)")


def _ptype(brand: str) -> str:
    return f"CASE WHEN cast(substring({brand}, 7, 4) as integer) % 4 = 0 THEN 'A' ELSE 'D' END"


_STATUS_LIST = "['RESERVED','SHIPPED','ITEM_LIMBO','PROBLEM_ITEM','DELIVERED','PROBLEM_IN_PROGRESS']"


def _status_at(i: str) -> str:
    return f"{_STATUS_LIST}[cast((l_partkey + ({i}) * l_suppkey) % 6 + 1 as integer)]"


BINDINGS: dict[str, str] = {}

BINDINGS["dates"] = """
SELECT asofdate,
       cast(year(asofdate) as bigint) AS calendar_year,
       cast(month(asofdate) as bigint) AS calendar_month,
       cast(fiscal_year as bigint) AS fiscal_year,
       cast(q * 3 + m + 1 as bigint) AS fiscal_month,
       fy_start + cast((q * 13 + CASE m WHEN 0 THEN 0 WHEN 1 THEN 4 ELSE 9 END) * 7 as integer) AS fiscal_month_start,
       cast(wk0 + 1 as bigint) AS fiscal_week,
       fy_start + cast(wk0 * 7 as integer) AS fiscal_week_start,
       fy_start + cast(wk0 * 7 + 6 as integer) AS fiscal_week_end
FROM (
  SELECT *, CASE WHEN wk0 - q * 13 < 4 THEN 0 WHEN wk0 - q * 13 < 9 THEN 1 ELSE 2 END AS m
  FROM (
    SELECT *, least(wk0 // 13, 3) AS q
    FROM (
      SELECT asofdate, fiscal_year, fy_start, (asofdate - fy_start) // 7 AS wk0
      FROM (
        SELECT asofdate, fiscal_year,
               make_date(fiscal_year, 2, 4) - cast(dayofweek(make_date(fiscal_year, 2, 4)) as integer) AS fy_start
        FROM (
          SELECT asofdate,
                 CASE WHEN asofdate >= make_date(year(asofdate), 2, 4)
                                       - cast(dayofweek(make_date(year(asofdate), 2, 4)) as integer)
                      THEN year(asofdate) ELSE year(asofdate) - 1 END AS fiscal_year
          FROM (SELECT cast(g AS date) AS asofdate
                FROM generate_series(timestamp '1990-01-01', timestamp '2030-12-31', interval 1 day) t(g))
        )
      )
    )
  )
)"""

BINDINGS["devices"] = """
SELECT cast(device_id as bigint) AS device_id, device FROM (VALUES
  (0, 'Desktop'), (1, 'Mobile'), (2, 'Tablet'), (3, 'App'), (4, 'Suspected Bots')) v(device_id, device)"""

BINDINGS["browser_device"] = """
SELECT browser_id, browser_id % 5 AS device_id
FROM (SELECT user_id * 3 + event_id % 3 AS browser_id FROM events
      UNION SELECT o_custkey * 3 + o_orderkey % 3 FROM orders)"""

BINDINGS["inventory_unit"] = f"""
SELECT user_id * 4 + event_id % 4 AS id,
       event_id AS seq,
       CASE WHEN event_type = 'error' THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
       {_barcode('user_id', 'event_id % 4')} AS barcode,
       ts AS updated_on,
       event_type AS action,
       'SITE_' || cast(user_id % 3 as varchar) AS location_site,
       CASE WHEN event_type = 'view' THEN 'RACK' WHEN event_type = 'signup' THEN 'CUSTOMER'
            ELSE upper(event_type) END AS location_station,
       'C' || cast((user_id * 4 + event_id % 4) % 50 as varchar) AS sku
FROM events"""

BINDINGS["inventory_unit_seq"] = """
SELECT id AS unit_id, max(seq) AS seq FROM inventory_unit GROUP BY id"""

BINDINGS["inventory_history"] = """
SELECT DISTINCT barcode, id AS unit_id FROM inventory_unit"""

BINDINGS["pixel_raw2"] = """
SELECT user_id AS uid,
       user_id * 3 + event_id % 3 AS browser_id,
       'M' || cast((user_id * 7 + event_id % 3) % (SELECT max(p_partkey) FROM part) as varchar) AS style_name,
       CASE WHEN event_type = 'purchase' THEN 'checkout_complete'
            WHEN event_type = 'click' THEN 'rezo_add_to_cart' ELSE event_type END AS action_type,
       ts AS datetime_cst,
       cast(cast(ts as date) + cast(event_id % 5 + 10 as integer) as timestamp) AS rent_begin_date,
       CASE WHEN event_id % 2 = 0 THEN 'web' ELSE 'app' END AS log_source
FROM events"""

_CART_EVENTS = """(SELECT e.*, p.p_partkey, p.p_size, p.p_brand, p.p_type FROM events e
   JOIN part p ON (e.user_id * 7 + e.event_id % 3) % (SELECT max(p_partkey) FROM part) = p.p_partkey
   WHERE e.event_type IN ('click', 'purchase'))"""

_LINES = """(SELECT * FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
   JOIN part p ON l.l_partkey = p.p_partkey)"""

BINDINGS["order_group_reservation"] = f"""
SELECT * FROM line_bookings
UNION ALL BY NAME
SELECT 'E' || cast(event_id as varchar) AS reservation_booking_id,
       (1000000000 + event_id) * 2 AS group_id,
       1000000000 + event_id AS order_id,
       user_id AS uid,
       {_sku('p_partkey', 'p_size')} AS sku,
       p_brand AS style,
       'CLASSIC' AS order_type,
       'RENTAL' AS merchandise_category,
       ts AS order_datetime_est,
       ts AS group_created_est,
       ts AS reservation_created,
       cast(ts as date) + cast(event_id % 5 + 10 as integer) AS rental_begin_date,
       cast(ts as date) + cast(event_id % 5 + 10 + 3 as integer) AS rental_end_date,
       cast(ts as date) + cast(event_id % 5 + 10 + event_id % 3 - 1 as integer) AS last_possible_begin_date,
       event_id % 4 + 1 AS ups_ground_shipping_zone,
       {_mail('user_id')} AS mail,
       {_mail('user_id')} AS email,
       {_ptype('p_brand')} AS type,
       {_ptype('p_brand')} AS product_type,
       {_barcode('user_id', 'event_id % 4')} AS barcode,
       'F' || 'E' || cast(event_id as varchar) AS fulfillment_id,
       'DELIVERED' AS last_fulfillment_status,
       'SHIPPED' AS last2nd_fulfillment_status,
       ts + to_hours(48) AS last_fulfillment_updated_on,
       ts + to_hours(24) AS last2nd_fulfillment_updated_on,
       cast(NULL as varchar) AS po_category,
       cast(NULL as varchar) AS po_reason,
       p_type AS sub_type,
       cast((user_id) % 25 as varchar) AS billing_postal_code,
       'payment_received' AS order_status,
       date '1994-01-01' + cast((user_id) % 3000 as integer) AS user_create_date,
       cast(((1000000000 + event_id) * 2) % 25 as varchar) AS delivery_postal_code,
       (cast(ts as date) + cast(event_id % 5 + 10 as integer)) AS expected_begin_date,
       (cast(ts as date) + cast(event_id % 5 + 13 as integer)) AS expected_end_date,
       (cast(ts as date) + cast(event_id % 5 + 13 as integer)) AS actual_expected_end_date,
       (cast(ts as date) + cast(event_id % 5 + 10 as integer)) - 2 AS earliest_possible_begin_date,
       ('E' || cast(event_id as varchar)) AS primary_booking_id,
       (cast(ts as date) + cast(event_id % 5 + 10 as integer)) - 2 AS customer_shipment_date,
       (cast(ts as date) + cast(event_id % 5 + 10 as integer)) + 6 AS warehouse_received_date,
       (cast(ts as date) + cast(event_id % 5 + 10 as integer)) + 8 AS item_available_date,
       ((1000000000 + event_id) * 2) % 3 + 1 AS dresses_in_group,
       (cast(ts as date) + cast(event_id % 5 + 10 as integer)) + 5 AS rf_end_date,
       (event_id % 5) + 1 AS unit_usage_rank,
       (event_id % 5) + 3 AS unit_total_usage
FROM {_CART_EVENTS} WHERE event_type = 'purchase'"""

BINDINGS["line_bookings"] = f"""
SELECT {BOOKING_ID} AS reservation_booking_id,
       l_orderkey * 2 + l_linenumber % 2 AS group_id,
       l_orderkey AS order_id,
       o_custkey AS uid,
       {_sku('l_partkey', 'p_size')} AS sku,
       p_brand AS style,
       {_order_type('o_orderpriority')} AS order_type,
       CASE WHEN p_type = 'PROMO' THEN 'CLEARANCE' ELSE 'RENTAL' END AS merchandise_category,
       o_orderdate AS order_datetime_est,
       o_orderdate + to_hours(cast(l_linenumber as bigint)) AS group_created_est,
       o_orderdate + to_hours(cast(l_linenumber as bigint)) AS reservation_created,
       cast(l_shipdate as date) AS rental_begin_date,
       cast(l_shipdate as date) + cast(l_linenumber % 2 + 3 as integer) AS rental_end_date,
       cast(l_shipdate as date) + cast(l_linenumber % 3 - 1 as integer) AS last_possible_begin_date,
       l_suppkey % 4 + 1 AS ups_ground_shipping_zone,
       {_mail('o_custkey')} AS mail,
       {_mail('o_custkey')} AS email,
       {_ptype('p_brand')} AS type,
       {_ptype('p_brand')} AS product_type,
       {_barcode('l_partkey', 'l_suppkey % 4')} AS barcode,
       'F' || {BOOKING_ID} AS fulfillment_id,
       {_status_at('l_orderkey % 3')} AS last_fulfillment_status,
       CASE WHEN 1 + l_orderkey % 3 > 1 THEN {_status_at('l_orderkey % 3 - 1')} END AS last2nd_fulfillment_status,
       l_shipdate + to_hours(cast((l_orderkey % 3) * 30 + l_linenumber as bigint)) AS last_fulfillment_updated_on,
       CASE WHEN 1 + l_orderkey % 3 > 1 THEN l_shipdate + to_hours(cast((l_orderkey % 3 - 1) * 30 + l_linenumber as bigint))
            END AS last2nd_fulfillment_updated_on,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Warehouse'
            WHEN l_returnflag = 'R' THEN 'Predicted' END AS po_category,
       CASE WHEN l_returnflag = 'R' THEN
            CASE WHEN l_suppkey % 4 = 0 THEN 'Late delivery' WHEN l_suppkey % 4 = 1 THEN 'Item missing'
                 WHEN l_suppkey % 4 = 2 THEN 'Allogator mismatch' ELSE 'Predicted' END END AS po_reason,
       p_type AS sub_type,
       cast((o_custkey) % 25 as varchar) AS billing_postal_code,
       'payment_received' AS order_status,
       date '1994-01-01' + cast((o_custkey) % 3000 as integer) AS user_create_date,
       cast((l_orderkey * 2 + l_linenumber % 2) % 25 as varchar) AS delivery_postal_code,
       cast(l_shipdate as date) AS expected_begin_date,
       (cast(l_shipdate as date) + cast(l_linenumber % 2 + 3 as integer)) AS expected_end_date,
       (cast(l_shipdate as date) + cast(l_linenumber % 2 + 3 as integer)) AS actual_expected_end_date,
       cast(l_shipdate as date) - 2 AS earliest_possible_begin_date,
       {BOOKING_ID} AS primary_booking_id,
       cast(l_shipdate as date) - 2 AS customer_shipment_date,
       cast(l_shipdate as date) + 6 AS warehouse_received_date,
       cast(l_shipdate as date) + 8 AS item_available_date,
       (l_orderkey * 2 + l_linenumber % 2) % 3 + 1 AS dresses_in_group,
       cast(l_shipdate as date) + 5 AS rf_end_date,
       (l_suppkey % 5) + 1 AS unit_usage_rank,
       (l_suppkey % 5) + 3 AS unit_total_usage
FROM {_LINES}"""

BINDINGS["ogr_po"] = "SELECT * FROM order_group_reservation"

BINDINGS["autumn_report_raw_data"] = """
SELECT group_id, mail, merchandise_category, order_type, po_category, po_reason,
       rental_begin_date, reservation_booking_id, sku, sub_type, type
FROM order_group_reservation"""

BINDINGS["yp_autumn_full"] = f"""
SELECT {BOOKING_ID} AS annotation_id,
       CASE l_linenumber % 4 WHEN 0 THEN 'REPLACEMENT' WHEN 1 THEN 'RFF'
            WHEN 2 THEN 'QUALITY_ISSUE' ELSE 'SHIPPING' END AS annotation_group,
       'BOOKING' AS annotation_target,
       {BOOKING_ID} AS annotation_target_id,
       CASE WHEN l_quantity < 40 THEN 'reason' ELSE 'fitOverall' END AS detail_name,
       CASE l_suppkey % 5 WHEN 0 THEN 'FIT' WHEN 1 THEN 'MINOR_QUALITY' WHEN 2 THEN 'CARRIER_ISSUE'
            WHEN 3 THEN 'OPERATION_ISSUE' ELSE 'PO_SWAP' END AS detail_value,
       l_orderkey AS order_id,
       CASE WHEN l_tax < 0.02 THEN 'AUTOMATED' WHEN l_tax < 0.05 THEN 'EMAIL' ELSE 'PHONE' END AS contact_method,
       l_shipdate + to_hours(cast(l_linenumber as bigint)) AS transaction_created
FROM lineitem WHERE l_discount >= 0.04"""

_SUBTOTAL = ("cast(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2))) "
             "as decimal(20,4))")
_TAXR = "cast(l_tax as decimal(4,2))"

BINDINGS["financial_line_item"] = f"""
SELECT {BOOKING_ID} AS id,
       l_orderkey AS order_id,
       l_orderkey * 2 + l_linenumber % 2 AS group_id,
       l_orderkey * 10 + l_linenumber % 2 AS invoice_id,
       CASE WHEN l_returnflag = 'R' THEN 'OUT' ELSE 'IN' END AS direction,
       CASE WHEN l_linestatus = 'F' THEN 'CONFIRMED' ELSE 'PENDING' END AS status,
       {_SUBTOTAL} AS subtotal,
       cast({_SUBTOTAL} * {_TAXR} as decimal(22,6)) AS tax,
       cast({_SUBTOTAL} + {_SUBTOTAL} * {_TAXR} as decimal(22,6)) AS total,
       cast(l_tax as decimal(9,4)) AS tax_rate,
       CASE WHEN l_returnflag = 'R' THEN 'MERCHANDISE_CREDIT' ELSE 'CHARGE' END AS type,
       l_shipdate + to_hours(cast(l_linenumber * 3 as bigint)) AS created_at,
       l_shipdate + to_hours(cast(l_linenumber * 3 as bigint)) + to_hours(cast(l_orderkey % 48 as bigint)) AS updated_at
FROM lineitem"""

BINDINGS["fli_status_history"] = "SELECT id AS fli_id, status AS to_status FROM financial_line_item"

BINDINGS["invoice_order"] = f"""
SELECT DISTINCT l_orderkey * 10 + l_linenumber % 2 AS id, l_orderkey AS order_id,
       l_linenumber % 2 AS seq, o_orderdate + to_days(cast(l_linenumber % 2 as integer)) AS created_at,
       {_order_type('o_orderpriority')} AS order_type
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

BINDINGS["invoice_group"] = """
SELECT DISTINCT l_orderkey * 2 + l_linenumber % 2 AS id,
       l_orderkey * 10 + l_linenumber % 2 AS invoice_order_id,
       CASE WHEN l_orderkey % 50 = 0 THEN cast(-1 as bigint) ELSE l_orderkey * 2 + l_linenumber % 2 END AS group_id
FROM lineitem"""

BINDINGS["invoice_booking"] = f"""
SELECT l_orderkey * 2 + l_linenumber % 2 AS invoice_group_id, {BOOKING_ID} AS booking_id FROM lineitem"""

BINDINGS["reservation_booking"] = f"""
SELECT reservation_booking_id AS id, group_id AS order_group_id, uid, sku, merchandise_category,
       reservation_created AS creation_date,
       CASE WHEN contains(reservation_booking_id, '-1-') THEN 0 ELSE 1 END AS status,
       0 AS type,
       rental_begin_date AS expected_begin_date,
       rental_end_date AS expected_end_date,
       rental_begin_date - 2 AS earliest_possible_begin_date,
       last_possible_begin_date,
       reservation_booking_id AS primary_booking_id
FROM line_bookings
UNION ALL
SELECT 'E' || cast(event_id as varchar) AS id,
       CASE WHEN event_type = 'purchase' THEN (1000000000 + event_id) * 2 ELSE 0 END AS order_group_id,
       user_id AS uid,
       {_sku('p_partkey', 'p_size')} AS sku,
       'RENTAL' AS merchandise_category,
       ts AS creation_date,
       CASE WHEN event_id % 4 = 0 THEN 0 ELSE 1 END AS status,
       CASE WHEN event_type = 'purchase' THEN 0 ELSE 2 END AS type,
       cast(ts as date) + cast(event_id % 5 + 10 as integer) AS expected_begin_date,
       cast(ts as date) + cast(event_id % 5 + 13 as integer) AS expected_end_date,
       cast(ts as date) + 1 AS earliest_possible_begin_date,
       cast(ts as date) + cast(event_id % 20 as integer) AS last_possible_begin_date,
       'E' || cast(event_id as varchar) AS primary_booking_id
FROM {_CART_EVENTS}"""

_BEGIN = "(l_shipdate + to_hours(cast(l_linenumber * 4 as bigint)))"
_CBEGIN = "cast(cast(ts as date) + cast(event_id % 5 + 10 as integer) as timestamp)"

BINDINGS["reservation_booking_detail"] = f"""
SELECT {BOOKING_ID} AS reservation_booking_id,
       {_BEGIN} AS rental_begin_date,
       {_BEGIN} + to_days(cast(l_linenumber % 2 + 3 as integer)) AS rental_end_date,
       {_BEGIN} - to_days(2) AS customer_shipment_date,
       {_BEGIN} + to_days(6) AS warehouse_received_date,
       {_BEGIN} + to_days(8) AS item_available_date
FROM {_LINES}
UNION ALL
SELECT 'E' || cast(event_id as varchar),
       {_CBEGIN},
       {_CBEGIN} + to_days(cast(event_id % 2 + 3 as integer)),
       {_CBEGIN} - to_days(2),
       {_CBEGIN} + to_days(6),
       {_CBEGIN} + to_days(8)
FROM {_CART_EVENTS}"""

BINDINGS["fulfillment"] = f"""
SELECT 'F' || {BOOKING_ID} AS id,
       {BOOKING_ID} AS booking_id,
       i + 1 AS seq,
       {_status_at('i')} AS status,
       {_barcode('l_partkey', 'l_suppkey % 4')} AS barcode,
       l_shipdate + to_hours(cast(i * 30 + l_linenumber as bigint)) AS updated_on,
       CASE WHEN l_partkey % 3 = 0 THEN 'C' || cast(l_partkey % 50 as varchar) END AS child_sku
FROM (SELECT *, unnest(generate_series(0, l_orderkey % 3)) AS i FROM lineitem)"""

BINDINGS["fulfillment_seq"] = f"SELECT 'F' || {BOOKING_ID} AS fulfillment_id, 1 + l_orderkey % 3 AS seq FROM lineitem"

BINDINGS["reservation_fulfillment"] = f"""
SELECT {BOOKING_ID} AS reservation_booking_id, l_shipdate + to_days(5) AS end_date
FROM lineitem WHERE l_linenumber % 2 = 0"""

BINDINGS["queue_rf_end_date_consolidation"] = f"""
SELECT {BOOKING_ID} AS reservation_booking_id, cast(l_shipdate as date) + 7 AS new_rf_end_date
FROM lineitem WHERE l_linenumber = 3"""

BINDINGS["unlimited_po_sources"] = f"""
SELECT 'F' || {BOOKING_ID} AS fulfillment_id, 'Warehouse' AS po_category, 'Damaged' AS po_reason
FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O'"""

BINDINGS["order_groups"] = """
SELECT DISTINCT l_orderkey * 2 + l_linenumber % 2 AS group_id,
       l_orderkey AS order_id,
       cast((l_orderkey * 2 + l_linenumber % 2) % 25 as varchar) AS postal_code,
       cast(c_nationkey as bigint) AS state,
       'City' || cast(c_nationkey % 5 as varchar) AS city,
       o_orderdate + to_hours(cast(l_linenumber % 2 as bigint)) AS created_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""

BINDINGS["uc_orders"] = f"""
SELECT o_orderkey AS order_id, o_custkey AS uid,
       cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as bigint) * 86400
         + o_orderkey % 86400 AS created,
       CASE WHEN o_orderstatus = 'F' THEN 'payment_received' WHEN o_orderstatus = 'O' THEN 'canceled'
            ELSE 'processing' END AS order_status,
       {_order_type('o_orderpriority')} AS order_type,
       cast(o_totalprice as decimal(18,2)) AS order_total,
       {_mail('o_custkey')} AS primary_email,
       cast(o_custkey % 25 as varchar) AS billing_postal_code
FROM orders"""

BINDINGS["users"] = f"""
SELECT c_custkey AS uid, date '1994-01-01' + cast(c_custkey % 3000 as integer) AS create_date,
       {_mail('c_custkey')} AS mail
FROM customer"""

BINDINGS["products_master_iid"] = f"""
SELECT {_sku('p_partkey', 'p_size')} AS sku, 'M' || cast(p_partkey as varchar) AS model,
       cast(p_size as varchar) AS size, p_type AS sizescalename,
       CASE WHEN p_partkey % 13 = 0 THEN 'X' ELSE 'N' END AS special_type,
       p_brand AS style_out, p_type AS sub_type
FROM part"""

BINDINGS["products_iid"] = f"""
SELECT CASE WHEN p_partkey % 2 = 0 THEN lower({_sku('p_partkey', 'p_size')})
            ELSE {_sku('p_partkey', 'p_size')} END AS sku,
       p_brand AS style
FROM part"""

BINDINGS["barcode_sku_style_type"] = f"""
SELECT {_sku('p_partkey', 'p_size')} AS sku, p_brand AS style FROM part"""

BINDINGS["products"] = f"""
SELECT p_brand AS style, min({_ptype('p_brand')}) AS type,
       'Designer' || cast(min(cast(substring(p_brand, 7, 4) as integer)) % 7 as varchar) AS designer,
       min(p_name) AS title, min(p_type) AS sub_type
FROM part GROUP BY p_brand"""

BINDINGS["size_scales"] = """
SELECT cast(p_size as varchar) AS psize, p_type AS size_scale, cast(p_size % 12 as bigint) AS standard_size
FROM part"""

BINDINGS["product_prices"] = """
SELECT 'M' || cast(p_partkey as varchar) AS style_name,
       'RENTAL' AS merchandise_category,
       timestamp '2024-01-01 00:00:00' + to_days(cast(i * 10 as integer)) AS order_date_start,
       timestamp '2024-01-01 00:00:00' + to_days(cast(i * 10 + 10 as integer)) AS order_date_end,
       CASE WHEN j = 0 THEN date '2024-01-01' ELSE date '2024-01-26' END AS rent_begin_start,
       CASE WHEN j = 0 THEN date '2024-01-25' ELSE date '2024-03-31' END AS rent_begin_end,
       cast(cast(p_retailprice as decimal(18,2)) + i * 10 + j * 5 as decimal(18,2)) AS price
FROM part, (SELECT i, j FROM range(3) a(i), range(2) b(j)) g"""

BINDINGS["browser_orders"] = """
SELECT o_custkey * 3 + o_orderkey % 3 AS browser_id, o_orderkey AS order_id FROM orders
UNION ALL
SELECT user_id * 3 + event_id % 3 AS browser_id, 1000000000 + event_id AS order_id FROM events WHERE event_type = 'purchase'"""

BINDINGS["shipping_method_time"] = """
SELECT destination_zip_code, shipping_method_id, min(transit_days) AS transit_days FROM (
  SELECT cast(s_nationkey as varchar) AS destination_zip_code,
         cast(CASE s_suppkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 6 ELSE 9 END as bigint) AS shipping_method_id,
         s_suppkey % 7 + 1 AS transit_days
  FROM supplier)
GROUP BY destination_zip_code, shipping_method_id"""

BINDINGS["uc_zones"] = """
SELECT cast(n_nationkey as bigint) AS zone_id, CASE WHEN n_nationkey = 7 THEN 'IL' ELSE n_name END AS zone_code
FROM nation"""

BINDINGS["showroom"] = """
SELECT cast(n_nationkey as bigint) AS id, CASE WHEN n_nationkey % 6 = 3 THEN '' ELSE n_name END AS name
FROM nation"""

BINDINGS["showroom_order"] = """
SELECT o_orderkey AS order_id, o_custkey % 25 AS showroom_id,
       CASE WHEN o_orderkey % 10 = 5 THEN 1 ELSE 0 END AS deleted
FROM orders WHERE o_orderkey % 5 = 0"""

BINDINGS["ow_transaction_summary"] = """
SELECT id AS transaction_id, order_id, group_id,
       cast(-total as decimal(22,6)) AS fli_total,
       cast(-tax as decimal(22,6)) AS fli_tax_total,
       cast(-subtotal as decimal(22,6)) AS fli_pretax_total,
       CASE WHEN order_id % 3 = 0 THEN 'DAMAGED' WHEN order_id % 3 = 1 THEN 'LATE' ELSE 'FIT' END
         AS annotation_type_summary,
       CASE WHEN order_id % 2 = 0 THEN 'QUALITY' ELSE 'SHIPPING' END AS annotation_group_summary
FROM financial_line_item WHERE direction = 'OUT'"""

BINDINGS["v_ot_orderdata"] = """
SELECT l.l_orderkey AS order_id, cast(l.l_shipdate as date) AS rental_begin_date, n.nth_order
FROM lineitem l JOIN (
  SELECT o_orderkey AS order_id,
         cast(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) as bigint) AS nth_order
  FROM orders) n ON l.l_orderkey = n.order_id"""

BINDINGS["finance_current_view_inventory"] = f"""
SELECT DISTINCT {_barcode('l_partkey', 'l_suppkey % 4')} AS barcode,
       timestamp '2017-06-01 00:00:00' + to_days(cast((l_partkey % 150) * 5 + (l_suppkey % 4) * 3 as integer)) AS activated_on,
       cast((l_partkey % 150) * 3 + 100 as decimal(18,2)) AS cost
FROM lineitem"""

BINDINGS["shipment"] = """
SELECT DISTINCT l_orderkey * 2 + l_linenumber % 2 AS shipper_reference, l_shipdate AS ship_date FROM lineitem"""

BINDINGS["v_ci_oi_resolution_report"] = """
SELECT g.rental_begin_date, g.order_type, a.annotation_target_id AS replacement_booking_id,
       cast(a.transaction_created as date) + 2 AS oi_resolution_date
FROM yp_autumn_full a JOIN order_group_reservation g ON a.annotation_target_id = g.reservation_booking_id
WHERE a.annotation_group = 'REPLACEMENT'"""

BINDINGS["profitability_sku_monthly_revenue_cogs"] = f"""
SELECT {_sku('l_partkey', 'p_size')} AS sku, p_brand AS style, {_order_type('o_orderpriority')} AS order_type,
       d.fiscal_year AS fiscal_year_rbd, d.fiscal_month AS fiscal_month_rbd,
       d.fiscal_month_start AS fiscal_month_start_rbd,
       av.fiscal_year AS fiscal_year_avl, av.fiscal_month AS fiscal_month_avl,
       av.fiscal_month_start AS fiscal_month_start_avl,
       cast(p_retailprice as decimal(18,2)) AS cost, cast(p_size as bigint) AS current_total_units,
       cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(18,2)) AS product_total_sku,
       cast(sum(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2))) as decimal(20,4))
         AS queue_subscription_revenue_sku,
       cast(sum(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2))) as decimal(20,4))
         AS queue_ttb_revenue_sku,
       count(*) AS total_booking,
       cast(sum(cast(l_quantity as decimal(18,2))) as decimal(18,2)) AS queue_monthly_athome_days_sku
FROM {_LINES} x
JOIN dates d ON cast(x.l_shipdate as date) = d.asofdate
JOIN (SELECT l_partkey AS fp, min(cast(l_shipdate as date)) AS first_day FROM lineitem GROUP BY l_partkey) f
  ON x.l_partkey = f.fp
JOIN dates av ON f.first_day = av.asofdate
GROUP BY ALL"""

BINDINGS["master_replenish_style"] = """
SELECT DISTINCT p_brand AS style FROM part WHERE p_type = 'PROMO' AND p_size = 50"""

BINDINGS["products_master"] = """
SELECT p_brand AS model,
       cast(CASE WHEN p_brand = 'Brand#13' AND p_size < 10 THEN 1 ELSE 0 END as bigint) AS is_replenishment_style
FROM part"""


def _refs(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b{re.escape(n)}\b", sql)]


def compose(main: str, ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``main`` with every binding it (transitively) mentions.

    ``ctes`` are query-local CTEs placed after the bindings, in the given order.
    """
    ctes = ctes or []
    order: list[str] = []

    def visit(n: str, stack=()):
        if n in order:
            return
        for d in _refs(BINDINGS[n], [b for b in BINDINGS if b != n]):
            if d not in stack:
                visit(d, stack + (n,))
        order.append(n)

    text = main + " ".join(s for _, s in ctes)
    for n in _refs(text, BINDINGS):
        visit(n)
    parts = [f"{n} AS ({BINDINGS[n]}\n)" for n in order] + [f"{n} AS ({s}\n)" for n, s in ctes]
    if not parts:
        return main
    return "WITH " + ",\n".join(parts) + "\n" + main
