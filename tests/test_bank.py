from __future__ import annotations

from collections import Counter, defaultdict

from rowcast.operators import bank

CUSTOMERS = "customer_id int, first_name string, last_name string, segment string"
TX = "tx_id bigint, customer_id int, amount double, channel string, country string"
ALERTS = "alert_id bigint, customer_id int, risk_score double, risk_class string"


def inputs(spark):
    customers = spark.createDataFrame(
        [(1, "Jan", "Nowak", "VIP"), (2, "Ewa", "Kot", "SME"), (3, "Ola", "Lis", "RETAIL")],
        CUSTOMERS,
    )
    tx = spark.createDataFrame(
        [
            (1, 1, 10.10, "ATM", "PL"),
            (2, 1, 20.20, "POS", "DE"),
            (3, 2, 99.99, "POS", "PL"),
            (4, 9, 5.00, "ATM", "US"),
            (5, 2, None, "ATM", "US"),
        ],
        TX,
    )
    alerts = spark.createDataFrame(
        [(1, 1, 0.9, "high"), (2, 1, 0.95, "high"), (3, 3, 0.9, "high"), (4, 2, 0.5, "medium")],
        ALERTS,
    )
    return customers, tx, alerts


def test_top_customers(spark):
    customers, tx, _ = inputs(spark)
    rows = bank.top_customers(spark, customers, tx).collect()
    assert [(r.customer_id, r.total_amount, r.tx_count) for r in rows] == [(2, 99.99, 2), (1, 30.3, 2)]


def test_high_risk_repeats_totals_and_keeps_customers_without_transactions(spark):
    customers, tx, alerts = inputs(spark)
    rows = bank.high_risk(spark, customers, tx, alerts).collect()
    assert [(r.alert_id, r.total_amount, r.tx_count) for r in rows] == [
        (2, 30.3, 2), (1, 30.3, 2), (3, None, 1),
    ]


def test_countries_and_risk_groups(spark):
    _, tx, alerts = inputs(spark)
    rows = {r.country: r for r in bank.countries(spark, tx).collect()}
    assert (rows["PL"].tx_count, rows["PL"].total_amount) == (2, 110.09)
    assert rows["US"].tx_count == 2 and rows["US"].avg_amount == 5.0
    groups = {r.customer_risk_group: r for r in bank.risk_groups(spark, tx, alerts).collect()}
    assert groups["HIGH_RISK_CUSTOMER"].tx_count == 2
    assert groups["HIGH_RISK_CUSTOMER"].avg_amount == 15.15
    assert groups["OTHER_CUSTOMER"].tx_count == 2
    assert groups["OTHER_CUSTOMER"].total_amount == 104.99


def test_views_are_registered(spark):
    bank.register_views(*inputs(spark), prefix="t_")
    assert spark.sql("SELECT COUNT(*) AS n FROM t_transactions").first().n == 5


def test_hot_customer_matches_the_plain_join(spark, monkeypatch):
    """A third of alerts and transactions on one customer, against a row-level join."""
    import rowcast.plans.sizing as sizing

    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    customers = spark.range(30).selectExpr(
        "CAST(id AS int) customer_id", "'f' first_name", "'l' last_name", "'s' segment"
    )
    tx = spark.range(90).selectExpr(
        "id tx_id", "CAST(IF(id % 3 = 0, 7, id % 40) AS int) customer_id", "id * 1.25D amount",
        "'c' channel", "'PL' country",
    )
    alerts = spark.range(60).selectExpr(
        "id alert_id", "CAST(IF(id % 3 = 0, 7, id % 40) AS int) customer_id",
        "id / 100.0D risk_score", "IF(id % 2 = 0, 'high', 'low') risk_class",
    )
    got = bank.high_risk(
        spark, customers, tx, alerts, count=1000, force=True, min_hot_rows=5, salts=4
    ).collect()
    sums, counts = defaultdict(float), Counter()
    for row in tx.collect():
        sums[row.customer_id] += row.amount
        counts[row.customer_id] += 1
    want = {
        a.alert_id: (sums.get(a.customer_id), counts.get(a.customer_id, 1))
        for a in alerts.collect()
        if a.risk_class == "high" and a.customer_id < 30
    }
    assert {r.alert_id: (r.total_amount, r.tx_count) for r in got} == want
    assert len(got) == len(want)
