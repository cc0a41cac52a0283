"""DuckDB statements that say independently what each registered query must return.

Written as plain set logic over the given tables: no pre-aggregation, no two-level
sums, no histograms.  The named parts are put together per query, with only those a
statement needs.
"""

from __future__ import annotations

import re

from bazaarlake import fixed_values as fixed
from bazaarlake.synth.generate import CITIES, FIRST_NAMES, LAST_NAMES

SEED = 1
MADE_ON = "DATE '2025-04-15'"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _draw(label: str, key: str, slot: int = 0) -> str:
    return (f"CAST('0x' || substr(md5('{SEED}|{label}|' || CAST({key} AS VARCHAR)), "
            f"{1 + 8 * slot}, 8) AS BIGINT)")


def _one_of(label: str, key: str, values: str) -> str:
    return f"{values}[1 + {_draw(label, key)} % len({values})]"


def _weighted(label: str, key: str, value_weights) -> str:
    """The value repeated as often as its weight says, indexed by the draw."""
    repeated = [v for v, w in value_weights for _ in range(w)]
    return f"({_list(repeated)})[1 + {_draw(label, key)} % {len(repeated)}]"


def _discounts(category: str) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {_list(v)}" for name, v in fixed.DISCOUNT_PERCENTS.items())
    return f"(CASE {category} {cases} END)"


def _clock(day: str, label: str, key: str) -> str:
    return (f"strftime(CAST({day} AS TIMESTAMP) + to_hours(8 + {_draw(label, key)} % 15) "
            f"+ to_minutes({_draw(label, key, 1)} % 60), '%Y-%m-%d %H:%M:%S')")


def _signup(customer: str) -> str:
    return f"({MADE_ON} - CAST({_draw('signup', customer)} % 91 AS INTEGER))"


def _basket_steps(prefix: str, tickets: str) -> dict[str, str]:
    """Five picks; after each, the tickets of the picked product are thrown away."""
    steps = {f"{prefix}0": f"SELECT order_id, basket_size, {tickets} AS t FROM {prefix}_in"}
    for i in range(5):
        label, slot = f"basket{i // 4}", i % 4
        carried = "".join(f", p{j}" for j in range(i))
        pick = f"t[1 + {_draw(label, 'order_id', slot)} % len(t)]"
        steps[f"{prefix}{i + 1}"] = (
            f"SELECT order_id, basket_size{carried}, p{i}, list_filter(t, lambda x: x <> p{i}) AS t "
            f"FROM (SELECT *, {pick} AS p{i} FROM {prefix}{i})"
        )
    steps[f"{prefix}_out"] = (
        f"SELECT order_id, basket_size, list_slice([p0, p1, p2, p3, p4], 1, basket_size) AS basket FROM {prefix}5"
    )
    return steps


_UNIFORM = _list(range(1, 50))
_POPULAR = _list([p for p in range(1, 50) for _ in range(5 if (p - 1) % 7 < 2 else 1)])
_SIZE = _weighted("basket_size", "order_id", fixed.BASKET_SIZE_WEIGHTS)

_products = [
    (7 * c + i + 1, c + 1, name, product, fixed.PRODUCT_PRICES[name][i])
    for c, (_, name) in enumerate(fixed.CATEGORIES)
    for i, product in enumerate(fixed.PRODUCT_NAMES[name])
]

PARTS = {
    # The given tables as the retail schema, defects included
    "l": "SELECT *, (l_orderkey*31 + l_linenumber*17 + l_partkey*7 + l_suppkey*3) % 100 AS h FROM lineitem",
    "cat": """SELECT CAST(row_number() OVER (ORDER BY p_type) AS INTEGER) AS category_id, p_type AS category_name
              FROM (SELECT DISTINCT p_type FROM part)""",
    "prod": """SELECT p_partkey AS product_id, category_id, p_name AS product_name,
                      CAST(p_retailprice AS DECIMAL(18,2)) AS default_price
               FROM part JOIN cat ON p_type = category_name""",
    "cust": """SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name, n_name AS city
               FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "ord0": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
                      (['UPI', 'Cash', 'Card'])[1 + o_orderkey % 3] AS payment_method,
                      CASE WHEN o_orderkey % 20 < 14 THEN 'completed' WHEN o_orderkey % 20 < 17 THEN 'pending'
                           WHEN o_orderkey % 20 < 19 THEN 'cancelled' ELSE 'returned' END AS order_status,
                      o_orderdate AS created_at
               FROM orders""",
    "ord": """SELECT order_id, customer_id,
                     CASE WHEN order_id IN (SELECT l_orderkey FROM l WHERE h = 2) THEN DATE '2002-01-10'
                          ELSE order_date END AS order_date,
                     payment_method, order_status, created_at
              FROM ord0""",
    "it0": """SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id, p_name AS product_name,
                     CAST(l_quantity AS INTEGER) AS quantity, CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
                     CAST(round(l_discount * 100) AS INTEGER) AS discount, h
              FROM l JOIN part ON l_partkey = p_partkey""",
    "it": """SELECT order_id, line_no, CASE WHEN h = 0 THEN 999999999 ELSE product_id END AS product_id,
                    CASE WHEN h = 0 THEN 'INVALID_PRODUCT' ELSE product_name END AS product_name,
                    CAST(CASE WHEN h = 1 THEN -(1 + line_no % 5) ELSE quantity END AS INTEGER) AS quantity,
                    unit_price, discount,
                    CASE WHEN h = 1 THEN 0.00
                         ELSE CAST(round(unit_price * (100 - discount) * 0.01, 2) AS DECIMAL(18,2)) END AS final_price
             FROM it0""",
    "ord_ok": "SELECT * FROM ord WHERE order_date <= DATE '2001-12-31'",
    "it_ok": """SELECT * FROM it WHERE quantity > 0 AND product_id IN (SELECT product_id FROM prod)
                AND order_id IN (SELECT order_id FROM ord_ok)""",
    "sold": """SELECT i.*, o.customer_id, o.payment_method, strftime(o.order_date, '%Y-%m') AS order_month
               FROM it_ok i JOIN ord_ok o USING (order_id) WHERE o.order_status = 'completed'""",
    "sales": """SELECT p.product_name, c.category_name, c.category_id,
                       CAST(sum(i.quantity) AS BIGINT) AS total_units_sold,
                       CAST(round(sum(i.final_price * i.quantity), 2) AS DOUBLE) AS total_revenue_inr
                FROM it_ok i JOIN prod p USING (product_id) JOIN cat c USING (category_id)
                GROUP BY ALL""",
    "ranked": """SELECT *, CAST(rank() OVER (PARTITION BY category_id ORDER BY total_units_sold DESC) AS INTEGER)
                        AS rank_in_category FROM sales""",
    "runs": """SELECT *, '2025-04-06' AS run_date FROM ord0 UNION ALL
               SELECT * REPLACE ('returned' AS order_status), '2025-04-13' FROM ord0 WHERE order_id % 3 = 0""",
    "split": """SELECT *, CASE WHEN order_date <= DATE '1998-06-30' THEN '2025-04-06' ELSE '2025-04-13' END AS run_date
                FROM ord0""",
    "why": """SELECT order_id, line_no, product_id, quantity,
                     CASE WHEN product_id NOT IN (SELECT product_id FROM prod) THEN 'invalid_fk' END AS r1,
                     CASE WHEN quantity <= 0 THEN 'negative_qty' END AS r2,
                     CASE WHEN order_id NOT IN (SELECT order_id FROM ord_ok) THEN 'removed_order' END AS r3
              FROM it""",
    # Made tables
    "plan_size": """SELECT count(*) AS target_items, greatest(200, count(*) // 7) AS num_customers,
                           greatest(300, count(*) // 2) AS num_orders FROM lineitem""",
    "size": "SELECT count(*) // 2 AS target_items, (SELECT count(*) FROM customer) AS num_customers FROM lineitem",
    "mcust": f"""SELECT id AS customer_id, {_one_of('first_name', 'id', _list(FIRST_NAMES))} AS first_name,
                        {_one_of('last_name', 'id', _list(LAST_NAMES))} AS last_name,
                        1000 + {_draw('suffix', 'id')} % 9000 AS suffix,
                        '+91' || lpad(CAST({_draw('phone', 'id')} % 100000 AS VARCHAR), 5, '0')
                              || lpad(CAST({_draw('phone', 'id', 1)} % 100000 AS VARCHAR), 5, '0') AS phone,
                        {_one_of('city', 'id', _list(CITIES))} AS city, {_signup('id')} AS signup_date
                 FROM (SELECT c_custkey + 1 AS id FROM customer)""",
    "mord0": f"""SELECT id AS order_id, 1 + {_draw('customer', 'id')} % num_customers AS customer_id
                 FROM (SELECT o_orderkey + 1 AS id, num_customers FROM orders, size)""",
    "mord": f"""SELECT order_id, customer_id,
                       CAST(signup_date + CAST({_draw('order_date', 'order_id')} %
                            (date_diff('day', signup_date, {MADE_ON}) + 1) AS INTEGER) AS DATE) AS order_date,
                       {_one_of('payment', 'order_id', _list(fixed.PAYMENT_METHODS))} AS payment_method,
                       {_weighted('status', 'order_id', fixed.STATUS_WEIGHTS)} AS order_status
                FROM mord0 JOIN mcust USING (customer_id)""",
    "msize": f"""SELECT order_id, {_SIZE} AS basket_size FROM mord0""",
    "mrun": """SELECT *, coalesce(sum(basket_size) OVER (ORDER BY order_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS items_before FROM msize""",
    "mb_in": "SELECT order_id, basket_size FROM msize",
    **_basket_steps("mb", _UNIFORM),
    "mprod": "SELECT * FROM (VALUES " + ", ".join(
        f"({pid}, {cid}, '{c}', '{p}', {price})" for pid, cid, c, p, price in _products
    ) + ") AS v(product_id, category_id, category_name, product_name, default_price)",
    "mpick": """SELECT order_id, items_before + pos AS order_item_id, basket[pos] AS product_id
                FROM (SELECT order_id, basket, items_before, unnest(range(1, basket_size + 1)) AS pos
                      FROM mb_out JOIN mrun USING (order_id, basket_size))
                WHERE items_before + pos <= (SELECT target_items FROM size)""",
    "mit": f"""SELECT CAST(order_item_id AS BIGINT) AS order_item_id, order_id, product_id, product_name,
                      {_weighted('quantity', 'order_item_id', fixed.QUANTITY_WEIGHTS)} AS quantity,
                      CAST(default_price AS DECIMAL(18,2)) AS unit_price,
                      {_one_of('discount', 'order_item_id', _discounts('category_name'))} AS discount, order_date
               FROM mpick JOIN mprod USING (product_id) JOIN mord USING (order_id)""",
    "mit2": """SELECT *, CAST(round(unit_price * (100 - discount) * 0.01, 2) AS DECIMAL(18,2)) AS final_price
               FROM mit""",
    "mbad": f"""SELECT order_item_id, {_one_of('defect_kind', 'order_item_id', _list(fixed.DEFECT_KINDS))} AS defect
                FROM (SELECT order_item_id, row_number() OVER (ORDER BY {_draw('defect', 'order_item_id')},
                             order_item_id) AS place, count(*) OVER () AS n FROM mit)
                WHERE place <= n * 3 // 100""",
    "mdirty": f"""SELECT order_item_id, order_id,
                         CASE WHEN defect = 'invalid_fk' THEN 9999 ELSE product_id END AS product_id,
                         CASE WHEN defect = 'invalid_fk' THEN 'INVALID_PRODUCT' ELSE product_name END AS product_name,
                         CASE WHEN defect = 'negative_qty' THEN -(1 + {_draw('defect_size', 'order_item_id')} % 5)
                              ELSE quantity END AS quantity,
                         unit_price, discount,
                         CASE WHEN defect = 'negative_qty' THEN 0 ELSE final_price END AS final_price
                  FROM mit2 LEFT JOIN mbad USING (order_item_id)""",
    "mlate": """SELECT DISTINCT order_id FROM mit JOIN mbad USING (order_item_id) WHERE defect = 'future_date'""",
    "mdord": f"""SELECT order_id, CASE WHEN order_id IN (SELECT order_id FROM mlate) THEN {MADE_ON} + 10
                             ELSE order_date END AS order_date,
                        {_clock('order_date', 'order_time', 'order_id')} AS created_at
                 FROM mord""",
    "mwhy": """SELECT product_id = 9999 AS r1, quantity <= 0 AS r2,
                      order_id IN (SELECT order_id FROM mlate) AS r3 FROM mdirty""",
    # Draws on the keys of the given orders
    "ok": "SELECT o_orderkey AS order_id FROM orders",
    "u_in": f"SELECT order_id, {_SIZE} AS basket_size FROM ok",
    **_basket_steps("u", _UNIFORM),
    "w_in": f"SELECT order_id, {_SIZE} AS basket_size FROM ok",
    **_basket_steps("w", _POPULAR),
}

_ITEM = """order_id, line_no, product_id, product_name, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
           discount, CAST(final_price AS DOUBLE) AS final_price"""
_SHORT = "order_id, line_no, product_id, quantity"
_ORDER = "order_id, customer_id, strftime(order_date, '%Y-%m-%d') AS order_date, payment_method, order_status"
_CREATED = "strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at"


def _counts(**parts: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {part}"
                              for name, part in parts.items())


_RAW_COUNTS = _counts(categories="cat", products="prod", customers="cust", orders="ord", order_items="it")

STATEMENTS = {
    "q1_revenue_by_category": """
        SELECT category_name, count(DISTINCT order_id) AS total_orders,
               CAST(sum(quantity) AS BIGINT) AS total_units_sold,
               CAST(round(sum(final_price * quantity), 2) AS DOUBLE) AS total_revenue_inr
        FROM sold s JOIN (SELECT product_id, category_id FROM prod) USING (product_id) JOIN cat USING (category_id)
        GROUP BY category_name ORDER BY total_revenue_inr DESC""",
    "q2_top_customers": """
        SELECT customer_id, first_name || ' ' || last_name AS customer_name, city,
               count(DISTINCT order_id) AS total_orders,
               CAST(round(sum(final_price * quantity), 2) AS DOUBLE) AS total_spend_inr
        FROM sold JOIN cust USING (customer_id)
        GROUP BY customer_id, first_name, last_name, city
        ORDER BY total_spend_inr DESC, customer_id LIMIT 10""",
    "q3_monthly_trend": """
        SELECT order_month, count(DISTINCT order_id) AS total_orders,
               count(DISTINCT customer_id) AS unique_customers,
               CAST(round(sum(final_price * quantity), 2) AS DOUBLE) AS monthly_revenue_inr
        FROM sold GROUP BY order_month ORDER BY order_month""",
    "q4_payment_split": """
        SELECT payment_method, n AS total_orders, CAST(round(n * 100.0 / sum(n) OVER (), 2) AS DOUBLE) AS pct_of_orders,
               total_revenue_inr
        FROM (SELECT payment_method, count(DISTINCT order_id) AS n,
                     CAST(round(sum(final_price * quantity), 2) AS DOUBLE) AS total_revenue_inr
              FROM sold GROUP BY payment_method)
        ORDER BY total_orders DESC""",
    "q5_top_product": """
        SELECT product_name, category_name, total_units_sold, total_revenue_inr, rank_in_category
        FROM ranked WHERE rank_in_category = 1 ORDER BY total_revenue_inr DESC""",
    "scan_raw_csv": f"SELECT {_ORDER}, {_CREATED} FROM ord0",
    "dim_categories": f"""
        SELECT category_id, category_name, parts
        FROM (SELECT DISTINCT category_id, category_name FROM mprod)
        JOIN (SELECT 1 + p_partkey % 7 AS category_id, count(*) AS parts FROM part GROUP BY 1) USING (category_id)""",
    "dim_products": """
        SELECT product_id, category_id, category_name, product_name, CAST(default_price AS DOUBLE) AS default_price, lines
        FROM mprod JOIN (SELECT 1 + l_partkey % 49 AS product_id, count(*) AS lines FROM lineitem GROUP BY 1)
             USING (product_id)""",
    "raw_run_date": """
        SELECT run_date, count(*) AS rows, CAST(sum(order_id) AS BIGINT) AS id_sum FROM split GROUP BY run_date""",
    "scan_one_run": f"SELECT {_ORDER}, run_date FROM split",
    "source_guard": f"SELECT table_name, row_count AS rows FROM ({_RAW_COUNTS})",
    "write_raw_csv": f"SELECT {_ITEM} FROM it",
    "land_run_overwrite": f"SELECT {_ORDER}, run_date FROM split",
    "write_clean_parquet": _counts(categories="cat", products="prod", customers="cust", orders="ord_ok",
                                   order_items="it_ok"),
    "publish_run": f"SELECT {_ORDER} FROM split WHERE run_date = '2025-04-13'",
    "run_summary": f"""
        SELECT table_name, row_count,
               CASE table_name WHEN 'order_items' THEN row_count * 3 // 100 ELSE 0 END AS expected_dirty
        FROM ({_RAW_COUNTS})""",
    "clean_negative_qty": f"SELECT {_SHORT} FROM it WHERE quantity > 0",
    "clean_future_date": f"SELECT {_ORDER} FROM ord_ok",
    "clean_invalid_fk": f"SELECT {_SHORT} FROM it WHERE product_id IN (SELECT product_id FROM prod)",
    "reject_invalid_fk": f"SELECT {_SHORT} FROM it WHERE product_id NOT IN (SELECT product_id FROM prod)",
    "clean_orphans": f"SELECT {_SHORT} FROM it WHERE order_id IN (SELECT order_id FROM ord_ok)",
    "units_before_order": """
        SELECT order_id, CAST(units AS BIGINT) AS units, far_id,
               CAST(coalesce(sum(units) OVER (ORDER BY far_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS units_before
        FROM (SELECT order_id, sum(quantity) AS units,
                     CASE WHEN order_id % 3 = 0 THEN CAST(order_id AS BIGINT) * 1000003 ELSE order_id END AS far_id
              FROM it GROUP BY order_id)""",
    "processed_order_items": f"SELECT {_ITEM} FROM it_ok",
    "processed_orders": f"SELECT {_ORDER} FROM ord_ok",
    "typed_items": """
        SELECT order_id, line_no, product_id, product_name, CASE WHEN h = 3 THEN 0 ELSE quantity END AS quantity,
               CAST(unit_price AS DOUBLE) AS unit_price, discount,
               CAST(round(unit_price * (100 - discount) * 0.01, 2) AS DOUBLE) AS final_price,
               CAST(h = 3 AS INTEGER) AS malformed
        FROM it0""",
    "quarantine": """
        SELECT order_id, line_no, product_id, quantity, concat_ws(',', r1, r2, r3) AS reasons
        FROM why WHERE coalesce(r1, r2, r3) IS NOT NULL""",
    "quality_report": """
        SELECT 'orders' AS table_name, 'future_date' AS reason, count(*) AS bad_rows FROM ord
        WHERE order_date > DATE '2001-12-31' UNION ALL
        SELECT 'order_items', r, count(*) FROM (SELECT unnest([r1, r2, r3]) AS r FROM why) WHERE r IS NOT NULL GROUP BY r""",
    "validate_report": """
        SELECT check_name, CAST(bad_rows = 0 AS INTEGER) AS passed, CAST(bad_rows AS BIGINT) AS bad_rows FROM (
          SELECT 'categories has exactly 6 rows' AS check_name, abs(count(*) - 6) AS bad_rows FROM cat UNION ALL
          SELECT 'products has exactly ' || (SELECT count(*) FROM part) || ' rows',
                 abs(count(*) - (SELECT count(*) FROM part)) FROM prod UNION ALL
          SELECT 'customers is not empty', CAST(count(*) = 0 AS INTEGER) FROM cust UNION ALL
          SELECT 'customer ids are unique', count(*) - count(DISTINCT customer_id) FROM cust UNION ALL
          SELECT 'customers have first_name', count(*) - count(first_name) FROM cust UNION ALL
          SELECT 'orders is not empty', CAST(count(*) = 0 AS INTEGER) FROM ord UNION ALL
          SELECT 'order ids are unique', count(*) - count(DISTINCT order_id) FROM ord UNION ALL
          SELECT 'orders have a customer', count(*) - count(customer_id) FROM ord UNION ALL
          SELECT 'order items is not empty', CAST(count(*) = 0 AS INTEGER) FROM it UNION ALL
          SELECT 'order item ids are unique', count(*) - count(DISTINCT (order_id, line_no)) FROM it UNION ALL
          SELECT 'unit prices are not negative', count(*) FILTER (unit_price < 0) FROM it)""",
    "dup_keys": "SELECT order_id, line_no, count(*) AS copies FROM it GROUP BY ALL HAVING count(*) > 1",
    "latest_per_key": f"""
        SELECT {_ORDER}, run_date FROM
          (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY run_date DESC) AS v FROM runs) WHERE v = 1""",
    "run_scope": f"SELECT {_ORDER}, run_date FROM runs WHERE run_date = '2025-04-13'",
    "union_runs": f"SELECT {_ORDER}, run_date FROM runs",
    "incremental_batch": f"""
        SELECT order_id, order_status, {_CREATED} FROM ord0
        WHERE order_date > DATE '1998-06-30' OR (order_date = DATE '1998-06-30' AND order_id % 2 = 1)""",
    "incremental_stream": f"SELECT {_ORDER}, run_date FROM split",
    "join_items_orders": f"""
        SELECT order_id, line_no, product_id, quantity, customer_id,
               strftime(order_date, '%Y-%m-%d') AS order_date, payment_method, order_status
        FROM it JOIN ord0 USING (order_id)""",
    "join_items_products": f"""
        SELECT order_id, line_no, product_id, quantity, category_id, p.product_name,
               CAST(default_price AS DOUBLE) AS default_price
        FROM it JOIN prod p USING (product_id)""",
    "join_products_categories": """
        SELECT category_id, product_id, product_name, CAST(default_price AS DOUBLE) AS default_price, category_name
        FROM prod JOIN cat USING (category_id)""",
    "join_customers_orders": f"""
        SELECT customer_id, order_id, strftime(order_date, '%Y-%m-%d') AS order_date, payment_method, order_status,
               first_name, last_name, city
        FROM cust JOIN ord0 USING (customer_id)""",
    "star_join": """
        SELECT order_id, line_no, product_id, category_name, order_status, quantity,
               CAST(final_price AS DOUBLE) AS final_price
        FROM it JOIN ord USING (order_id) JOIN (SELECT product_id, category_id FROM prod) USING (product_id)
             JOIN cat USING (category_id)""",
    "multi_distinct": """
        SELECT order_status, count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers
        FROM ord GROUP BY order_status""",
    "decimal_revenue": """
        SELECT CAST(product_id <> 999999999 AS INTEGER) AS known, discount, count(*) AS lines,
               CAST(sum(quantity) AS BIGINT) AS total_units,
               CAST(round(sum(final_price * quantity), 2) AS DOUBLE) AS total_revenue
        FROM it GROUP BY ALL""",
    "pct_of_total": """
        SELECT order_status, count(*) AS total_orders,
               CAST(round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS DOUBLE) AS pct_of_orders
        FROM ord GROUP BY order_status""",
    "rank_in_category": """
        SELECT category_id, total_units_sold, product_name, category_name, total_revenue_inr, rank_in_category
        FROM ranked""",
    "full_name": "SELECT customer_id, first_name || ' ' || last_name AS customer_name FROM cust",
    "order_month": "SELECT substr(CAST(order_date AS VARCHAR), 1, 7) AS order_month, count(*) AS orders FROM ord GROUP BY 1",
    "draw_uniform": f"SELECT order_id, 1000 + {_draw('suffix', 'order_id')} % 9000 AS suffix FROM ok",
    "draw_choice": f"""
        SELECT order_id, category_name, {_one_of('payment', 'order_id', _list(fixed.PAYMENT_METHODS))} AS payment_method,
               {_one_of('discount', 'order_id', _discounts('category_name'))} AS discount
        FROM (SELECT order_id,
                     {_one_of('category', 'order_id', _list([n for _, n in fixed.CATEGORIES]))} AS category_name FROM ok)""",
    "draw_weighted": f"""
        SELECT order_id, {_weighted('status', 'order_id', fixed.STATUS_WEIGHTS)} AS order_status,
               {_SIZE} AS basket_size, {_weighted('quantity', 'order_id', fixed.QUANTITY_WEIGHTS)} AS quantity FROM ok""",
    "draw_basket": "SELECT order_id, array_to_string(basket, ',') AS basket FROM u_out",
    "draw_basket_weighted": "SELECT order_id, array_to_string(basket, ',') AS basket FROM w_out",
    "gen_sizes": "SELECT target_items, num_customers, num_orders FROM plan_size",
    "gen_customers": f"""
        SELECT customer_id, first_name, last_name,
               lower(first_name) || lower(last_name) || CAST(suffix AS VARCHAR) || '@example.com' AS email, phone, city,
               strftime(signup_date, '%Y-%m-%d') AS signup_date,
               {_clock('signup_date', 'customer_time', 'customer_id')} AS created_at,
               {_clock('signup_date', 'customer_time', 'customer_id')} AS updated_at
        FROM mcust""",
    "gen_orders": f"""
        SELECT {_ORDER}, {_clock('order_date', 'order_time', 'order_id')} AS created_at,
               {_clock('order_date', 'order_time', 'order_id')} AS updated_at
        FROM mord""",
    "gen_items_truncate": """
        SELECT order_id, CAST(items_before AS BIGINT) AS items_before,
               CAST(least(basket_size, target_items - items_before) AS BIGINT) AS items_kept
        FROM mrun, size WHERE items_before < target_items""",
    "gen_order_items": f"""
        SELECT order_item_id, order_id, product_id, product_name, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
               discount, CAST(final_price AS DOUBLE) AS final_price,
               {_clock('order_date', 'item_time', 'order_item_id')} AS created_at,
               {_clock('order_date', 'item_time', 'order_item_id')} AS updated_at
        FROM mit2""",
    "defect_pick": "SELECT order_item_id FROM mbad",
    "inject_invalid_fk": """
        SELECT order_item_id, product_id, product_name, CAST(unit_price AS DOUBLE) AS unit_price FROM mdirty""",
    "inject_negative_qty": """
        SELECT order_item_id, CAST(quantity AS INTEGER) AS quantity, CAST(final_price AS DOUBLE) AS final_price
        FROM mdirty""",
    "inject_future_date": "SELECT order_id, strftime(order_date, '%Y-%m-%d') AS order_date, created_at FROM mdord",
    "gen_run_summary": """
        SELECT 'categories' AS measure, count(DISTINCT category_id) AS value FROM mprod UNION ALL
        SELECT 'products', count(*) FROM mprod UNION ALL SELECT 'customers', count(*) FROM mcust UNION ALL
        SELECT 'orders', count(*) FROM mord UNION ALL SELECT 'order_items', count(*) FROM mdirty UNION ALL
        SELECT 'invalid_fk', count(*) FROM mwhy WHERE r1 UNION ALL
        SELECT 'negative_qty', count(*) FROM mwhy WHERE r2 UNION ALL
        SELECT 'removed_order', count(*) FROM mwhy WHERE r3 UNION ALL
        SELECT 'bad_items', count(*) FROM mwhy WHERE r1 OR r2 OR r3""",
}
_ARRIVED = "(run_date = '2025-04-06' AND order_id % 7 <> 0)"
_MARK_1 = f"(SELECT max(created_at) FROM split WHERE {_ARRIVED})"
_MARK_2 = "(SELECT max(created_at) FROM split)"
STATEMENTS["incremental_ledger"] = f"""
    SELECT {_ORDER}, CASE WHEN {_ARRIVED} THEN '2025-04-06' ELSE '2025-04-13' END AS run_date FROM split"""
STATEMENTS["ledger_loads"] = f"""
    SELECT CAST(load AS INTEGER) AS load, rows, late_rows, strftime(mark, '%Y-%m-%d %H:%M:%S') AS mark FROM (
      SELECT 1 AS load, count(*) AS rows, CAST(0 AS BIGINT) AS late_rows, max(created_at) AS mark FROM split WHERE {_ARRIVED} UNION ALL
      SELECT 2, count(*), count(*) FILTER (created_at < {_MARK_1}), {_MARK_2} FROM split WHERE NOT {_ARRIVED} UNION ALL
      SELECT 3, count(*), count(*) FILTER (created_at < {_MARK_2}), {_MARK_2} FROM split WHERE {_ARRIVED})"""
STATEMENTS["distinct_by_month"] = """
    SELECT coalesce(run_date, 'all') AS run_date, coalesce(order_month, 'all') AS order_month,
           count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers
    FROM (SELECT *, strftime(order_date, '%Y-%m') AS order_month FROM split)
    GROUP BY CUBE (run_date, order_month)"""
_DRIFT = {"order_id": "int", "customer_id": "int", "order_date": "date", "payment_method": "string", "order_status": "string", "created_at": "timestamp"}
_LONG = {"customer_id": "bigint"}
_RUNS = {
    "2025-04-06": [(c, "first", k, k) for c, k in _DRIFT.items()],
    "2025-04-13": [(c, "widened" if c in _LONG else "lost" if c == "payment_method" else "same" if c in ("order_id", "order_date") else "moved",
                    "" if c == "payment_method" else _LONG.get(c, k), "" if c == "payment_method" else _LONG.get(c, k)) for c, k in _DRIFT.items()]
    + [("gift", "added", "boolean", "boolean")],
    "2025-04-20": [(c, "narrowed" if c in _LONG else "added" if c == "payment_method" else "same" if c in ("order_id", "order_date") else "moved",
                    k, _LONG.get(c, k)) for c, k in _DRIFT.items()] + [("gift", "lost", "", "")],
}
STATEMENTS["schema_drift"] = "SELECT v.*, CASE found_type WHEN '' THEN 0 ELSE (SELECT count(*) FROM ord0) END AS cells FROM (VALUES " + ", ".join(
    f"('{run}', '{c}', '{change}', '{found}', '{merged}')" for run, rows in _RUNS.items() for c, change, found, merged in rows
) + ") AS v(run_date, column_name, change, found_type, merged_type)"

# What discovery must say: position, column, found type, declared type.
_TEXT, _DAY, _STAMP = "string", "date", "timestamp_ntz"
_DECLARED = {
    "categories": [("category_id", "int"), ("category_name", _TEXT)],
    "products": [("product_id", "int"), ("category_id", "int"), ("product_name", _TEXT), ("default_price", "decimal(18,2)")],
    "customers": [("customer_id", "bigint"), ("first_name", _TEXT), ("last_name", _TEXT), ("email", _TEXT), ("phone", _TEXT),
                  ("city", _TEXT), ("signup_date", _DAY), ("created_at", _STAMP), ("updated_at", _STAMP)],
    "orders": [("order_id", "bigint"), ("customer_id", "bigint"), ("order_date", _DAY), ("payment_method", _TEXT),
               ("order_status", _TEXT), ("created_at", _STAMP), ("updated_at", _STAMP)],
    "order_items": [("order_item_id", "bigint"), ("order_id", "bigint"), ("product_id", "int"), ("product_name", _TEXT),
                    ("quantity", "int"), ("unit_price", "decimal(18,2)"), ("discount", "int"), ("final_price", "decimal(18,2)"),
                    ("created_at", _STAMP), ("updated_at", _STAMP)],
}
# Inference sees small whole numbers, fractions, zoned stamps, and a phone number without its zeros.
_INFERRED = {"bigint": "int", "decimal(18,2)": "double", _STAMP: "timestamp"}


def _report(rows) -> str:
    values = ", ".join(f"('{t}', {i}, '{name}', '{found}', '{declared}')" for t, i, name, found, declared in rows)
    return f"SELECT * FROM (VALUES {values}) AS v(table_name, position, column_name, found_type, declared_type)"


STATEMENTS["discover_raw_schema"] = _report(
    (t, i, name, "int" if name == "phone" else _INFERRED.get(kind, kind), kind)
    for t, columns in _DECLARED.items() for i, (name, kind) in enumerate(columns))
STATEMENTS["discover_clean_schema"] = _report(
    (t, i, name, kind, "" if name == "reasons" else kind)
    for t, columns in _DECLARED.items() for i, (name, kind) in enumerate([*columns, ("reasons", "array<string>")]))

for _job, _same in (
    ("clean_job_items", "processed_order_items"), ("clean_job_orders", "processed_orders"), ("clean_job_quarantine", "quarantine"),
    ("sql_revenue_by_category", "q1_revenue_by_category"), ("sql_top_customers", "q2_top_customers"),
    ("sql_monthly_trend", "q3_monthly_trend"), ("sql_payment_split", "q4_payment_split"), ("sql_top_product", "q5_top_product"),
    ("sql_revenue_by_category_two_runs", "q1_revenue_by_category"), ("sql_top_customers_two_runs", "q2_top_customers"),
    ("sql_monthly_trend_two_runs", "q3_monthly_trend"), ("sql_payment_split_two_runs", "q4_payment_split"),
    ("sql_top_product_two_runs", "q5_top_product"), ("named_tables_two_runs", "q4_payment_split"),
    ("kept_revenue_by_category", "q1_revenue_by_category"), ("kept_top_customers", "q2_top_customers"),
    ("kept_monthly_trend", "q3_monthly_trend"), ("kept_payment_split", "q4_payment_split"), ("kept_top_product", "q5_top_product"),
    ("publish_by_commit", "publish_run"), ("raw_by_name", "raw_run_date"), ("multi_distinct_bitmaps", "multi_distinct"),
    ("clean_orphans_pruned", "clean_orphans"), ("q1_revenue_by_category_pruned", "q1_revenue_by_category"),
):
    STATEMENTS[_job] = STATEMENTS[_same]
STATEMENTS["write_result_csv"] = STATEMENTS["q1_revenue_by_category"]


def _needed(text: str, seen: list[str]) -> None:
    """Named parts used in ``text``, each after those it uses itself."""
    words = set(re.findall(r"\b\w+\b", re.sub(r"'[^']*'", "", text)))
    for name, part in PARTS.items():
        if name in words and name not in seen and re.search(rf"(FROM|JOIN|,)\s+{name}\b", text):
            _needed(part, seen)
            if name not in seen:
                seen.append(name)


def statements() -> dict[str, str]:
    whole = {}
    for key, text in STATEMENTS.items():
        names: list[str] = []
        _needed(text, names)
        parts = ",\n".join(f"{name} AS ({PARTS[name]})" for name in names)
        whole[key] = f"WITH {parts}\n{text.strip()}" if parts else text.strip()
    return whole
