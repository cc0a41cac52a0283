"""The five questions on the hand-made tables, raw and clean, and against SQL text."""

from conftest import ITEMS, ORDERS, PRODUCTS, hand_made, rows_of

from bazaarlake.plans import analytics
from bazaarlake.sources.catalog import as_views


def test_revenue_by_category(raw_tables, clean_tables):
    assert rows_of(analytics.revenue_by_category(clean_tables)) == [
        ("Electronics", 3, 5, "177250.00"), ("Clothing", 1, 2, "1260.00")]
    assert rows_of(analytics.revenue_by_category(raw_tables)) == [
        ("Electronics", 3, 5, "177250.00"), ("Clothing", 3, 4, "4060.00")]


def test_top_customers(raw_tables, clean_tables):
    clean = [(2, "Ravi Nair", "Kochi", 1, "85500.00"), (1, "Asha Rao", "Pune", 1, "63010.00"),
             (3, "Meera Das", "Delhi", 1, "30000.00")]
    assert rows_of(analytics.top_customers(clean_tables)) == clean
    raw = [(2, "Ravi Nair", "Kochi", 2, "89000.00"), *clean[1:]]
    assert rows_of(analytics.top_customers(raw_tables)) == raw


def test_monthly_trend(raw_tables, clean_tables):
    assert rows_of(analytics.monthly_trend(clean_tables)) == [
        ("2025-01", 2, 2, "148510.00"), ("2025-02", 1, 1, "30000.00")]
    assert rows_of(analytics.monthly_trend(raw_tables)) == [
        ("2025-01", 2, 2, "149210.00"), ("2025-02", 1, 1, "30000.00"), ("2025-04", 1, 1, "2800.00")]


def test_payment_split(raw_tables, clean_tables):
    def numbers(tables):
        return [(m, n, round(float(p), 2), r) for m, n, p, r in rows_of(analytics.payment_split(tables))]

    assert numbers(clean_tables) == [("UPI", 2, 66.67, "93010.00"), ("Card", 1, 33.33, "85500.00")]
    assert numbers(raw_tables) == [("UPI", 3, 75.0, "95810.00"), ("Card", 1, 25.0, "86200.00")]


def test_top_product_per_category(raw_tables, clean_tables):
    assert rows_of(analytics.top_product_per_category(clean_tables)) == [
        ("Laptop", "Electronics", 4, "115500.00", 1), ("T-Shirt", "Clothing", 2, "1260.00", 1)]
    assert rows_of(analytics.top_product_per_category(raw_tables)) == [
        ("Laptop", "Electronics", 4, "115500.00", 1), ("T-Shirt", "Clothing", 4, "4060.00", 1)]


def test_products_tied_on_units_are_both_returned(spark):
    items = [*ITEMS, (9, 1, 1, 1, "65000.00")]  # Smartphone reaches the Laptop's four units
    answer = rows_of(analytics.top_product_per_category(hand_made(spark, items=items)))
    assert [(name, units, rank) for name, _, units, _, rank in answer if name != "T-Shirt"] == [
        ("Smartphone", 4, 1), ("Laptop", 4, 1)]


def test_order_without_items_and_item_without_product_are_left_out(spark):
    tables = hand_made(
        spark,
        items=[*ITEMS, (9, 1, None, 7, "5.00")],
        orders=[*ORDERS, (6, 3, "2025-03-01", "UPI", "completed")])
    assert ("2025-03", ) not in [row[:1] for row in rows_of(analytics.monthly_trend(tables))]
    assert sum(row[2] for row in rows_of(analytics.revenue_by_category(tables))) == 9


def test_repeated_rows_multiply_as_joins_do(spark):
    """Tables loaded twice: sums double, distinct counts do not."""
    once = hand_made(spark)
    twice = once.having(orders=once.orders.unionByName(once.orders))
    for question in (analytics.revenue_by_category, analytics.monthly_trend):
        a, b = rows_of(question(once)), rows_of(question(twice))
        assert [r[1] for r in a] == [r[1] for r in b]
        assert [2 * float(r[-1]) for r in a] == [float(r[-1]) for r in b]
    customers = once.having(customers=once.customers.unionByName(once.customers))
    assert [(r[0], r[3], 2 * float(r[4])) for r in rows_of(analytics.top_customers(once))] == [
        (r[0], r[3], float(r[4])) for r in rows_of(analytics.top_customers(customers))]


def test_sql_on_the_registered_names_gives_the_same(spark, clean_tables):
    """The questions as plain SQL over the catalog names; text casts are STRING in Spark."""
    as_views(clean_tables)
    sql = {
        analytics.revenue_by_category: """
            SELECT category_name, count(DISTINCT order_id), sum(quantity), round(sum(final_price * quantity), 2) AS money
            FROM processed_order_items JOIN processed_orders USING (order_id)
                 JOIN processed_products USING (product_id) JOIN processed_categories USING (category_id)
            WHERE order_status = 'completed' GROUP BY category_name ORDER BY money DESC""",
        analytics.monthly_trend: """
            SELECT substr(cast(order_date AS string), 1, 7) AS m, count(DISTINCT order_id), count(DISTINCT customer_id),
                   round(sum(final_price * quantity), 2)
            FROM processed_orders JOIN processed_order_items USING (order_id)
            WHERE order_status = 'completed' GROUP BY m ORDER BY m""",
        analytics.top_customers: """
            SELECT customer_id, first_name || ' ' || last_name, city, count(DISTINCT order_id),
                   round(sum(final_price * quantity), 2) AS spend
            FROM processed_customers JOIN processed_orders USING (customer_id)
                 JOIN processed_order_items USING (order_id)
            WHERE order_status = 'completed' GROUP BY customer_id, first_name, last_name, city
            ORDER BY spend DESC, customer_id LIMIT 10""",
    }
    for question, text in sql.items():
        assert rows_of(question(clean_tables)) == rows_of(spark.sql(text))


def test_same_name_in_one_category_counts_as_one_product(spark):
    products = [*PRODUCTS, (4, 1, "Laptop", "99")]
    items = [*ITEMS, (9, 1, 4, 5, "99.00")]
    answer = rows_of(analytics.top_product_per_category(hand_made(spark, items=items, products=products)))
    assert ("Laptop", "Electronics", 9, "115995.00", 1) in answer
