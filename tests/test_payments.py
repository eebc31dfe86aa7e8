from __future__ import annotations

from collections import Counter

from rowcast.operators import payments

ORDERS = "order_id bigint, customer_id int, order_amount double"
CUSTOMERS = "customer_id int, first_name string, last_name string, city string"
PAYMENTS = "order_id bigint, paid_ratio double"


def inputs(spark):
    orders = spark.createDataFrame(
        [(1, 1, 100.01), (2, 1, 200.0), (3, 2, 50.55), (4, 9, 10.0), (5, None, 7.0)], ORDERS
    )
    customers = spark.createDataFrame([(1, "Jan", "Nowak", "A"), (2, "Ewa", "Kot", "B")], CUSTOMERS)
    paid = spark.createDataFrame([(1, 0.5), (2, 1.0), (3, 0.0), (4, 1.0)], PAYMENTS)
    return orders, customers, paid


def test_joined_rows(spark):
    rows = {r.order_id: r for r in payments.joined(*inputs(spark)).collect()}
    assert len(rows) == 5
    assert (rows[1].paid_amount, rows[1].unpaid_amount) == (50.005, 50.005)
    assert rows[1].payment_status == "PARTIALLY_PAID"
    assert rows[2].payment_status == "FULLY_PAID"
    assert rows[4].first_name is None and rows[4].payment_status == "FULLY_PAID"
    assert rows[5].paid_ratio == 0.0 and rows[5].payment_status == "UNPAID"


def test_totals_and_status_agree(spark):
    orders, _, paid = inputs(spark)
    total = payments.totals(orders, paid).first()
    assert total.orders_count == 5
    assert total.total_order_amount == 367.56
    assert round(total.total_paid_amount + total.total_unpaid_amount, 2) == 367.56
    status = payments.by_status(orders, paid).collect()
    assert [r.payment_status for r in status] == ["FULLY_PAID", "PARTIALLY_PAID", "UNPAID"]
    assert sum(r.orders_count for r in status) == 5


def test_top_reports(spark):
    top = payments.top_customers(*inputs(spark)).collect()
    assert [(r.customer_id, r.total_unpaid_amount) for r in top] == [
        (2, 50.55), (1, 50.005), (None, 7.0), (9, 0.0),
    ]
    cities = payments.top_cities(*inputs(spark)).collect()
    assert [(r.city, r.total_order_amount, r.orders_count) for r in cities] == [
        ("A", 300.01, 2), ("B", 50.55, 1), (None, 17.0, 2),
    ]


def test_repeated_payments_fan_out_the_same_way_when_salted(spark, monkeypatch):
    import rowcast.plans.sizing as sizing

    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    orders = spark.range(60).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS order_id",
        "CAST(CASE WHEN id % 2 = 0 THEN 1 ELSE id END AS int) AS customer_id",
        "id * 1.25D AS order_amount",
    )
    paid = spark.range(45).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS order_id", "0.5D AS paid_ratio"
    )
    customers = spark.range(40).selectExpr(
        "CAST(id AS int) AS customer_id", "'f' AS first_name", "'l' AS last_name", "'c' AS city"
    )
    plain = payments.joined(orders, customers, paid)
    salted = payments.joined(orders, customers, paid, force=True, min_hot_rows=5, salts=4)
    assert Counter(map(tuple, salted.collect())) == Counter(map(tuple, plain.collect()))
    assert plain.count() == 20 * 15 + 40


def test_small_amounts_add_up_and_odd_ones_are_left_out(spark):
    small = spark.range(1000).selectExpr("id AS order_id", "1 AS customer_id", "0.004D AS order_amount")
    none = spark.createDataFrame([], PAYMENTS)
    assert payments.totals(small, none).first().total_order_amount == 4.0
    odd = small.limit(1).selectExpr("-1L", "1", "double('NaN')").union(small.limit(1).selectExpr("-2L", "1", "double('Infinity')"))
    total = payments.totals(small.union(odd), none).first()
    assert (total.orders_count, total.total_order_amount) == (1002, 4.0)
    large = spark.range(3).selectExpr("id AS order_id", "1 AS customer_id", "9000000000000.01D AS order_amount")
    assert payments.totals(large, none).first().total_order_amount == 27000000000000.03
