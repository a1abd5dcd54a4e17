"""The marts over the hand-made edge tables."""

from __future__ import annotations

from datetime import date
from decimal import Decimal as D

import pytest
from helpers import AS_OF, frame

from basketry.operators.quality import dq_accepted_values, dq_reconcile, dq_report, dq_unique_keys, order_rollup
from basketry.plans import bronze, customer360 as c360, rfm, silver
from basketry.plans.cohorts import cohort_retention, first_purchase
from basketry.plans.reports import report_clusters, report_retention_curve, report_segments


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_customer_360(edge):
    mart = c360.customer_360(edge["customers"], edge["products"], edge["orders"], edge["items"], AS_OF)
    day = date.fromisoformat
    assert rows(mart, "customer_id") == [
        (1, day("2024-01-31"), day("2024-02-28"), 2, D("150.01"), D("75.01"), D("3.00"), D("0.0000"), 123, D("0.0000"), "Electronics"),
        (2, day("2023-01-15"), day("2024-03-15"), 2, D("10.00"), D("10.00"), D("2.50"), D("1.0000"), 107, D("0.5000"), "Home"),
        (3, None, None, 0, D("0.00"), D("0.00"), D("0.00"), D("0.0000"), None, D("0.0000"), None),
        (4, None, None, 0, D("0.00"), D("0.00"), D("0.00"), D("0.0000"), None, D("0.0000"), None),
        (5, day("2023-07-01"), day("2024-01-01"), 2, D("100.00"), D("50.00"), D("1.00"), D("0.3333"), 181, D("0.0000"), "Apparel"),
        (6, day("2023-06-30"), day("2024-06-30"), 2, D("44.44"), D("44.44"), D("1.00"), D("0.0000"), 0, D("0.5000"), "Electronics"),
        (7, day("2024-01-10"), day("2024-01-10"), 1, D("12.00"), D("12.00"), D("3.00"), D("0.0000"), 172, D("0.0000"), "Apparel"),
    ]


def test_parts_agree_with_the_mart(edge):
    mart = {r.customer_id: r for r in c360.customer_360(edge["customers"], edge["products"], edge["orders"], edge["items"], AS_OF).collect()}
    for part in (
        c360.basket_size(edge["items"], edge["orders"]),
        c360.dominant_category(edge["items"], edge["orders"], edge["products"]),
        c360.returns_rate(edge["orders"]),
    ):
        column = part.columns[1]
        for row in part.collect():
            assert row[column] == mart[row.customer_id][column], (column, row)


def test_frequency_with_all_elapsed_months(edge):
    strict = {r.customer_id: r.purchase_frequency_per_mo for r in c360.purchase_frequency(edge["orders"], strict_months=True).collect()}
    assert strict == {1: D("2.0000"), 2: D("0.1429"), 5: D("0.3333"), 6: D("0.1667"), 7: D("1.0000")}


def test_mean_is_rounded_once(spark):
    # The mean is 0.00499975: rounded to six digits first it would become 0.01.
    orders = spark.range(20_001).selectExpr(
        "id as order_id", "1 as customer_id", "date'2024-01-01' as order_date", "'completed' as status",
        "cast(if(id % 2 = 1, 0.01, 0) as decimal(12,2)) as order_total",
    )
    customers = spark.sql("select 1 as customer_id")
    assert c360.customer_base(customers, orders).first().avg_order_value == D("0.00")


def test_category_without_known_revenue_ranks_first(spark, edge):
    items = frame(spark, "fact_order_items", [(1, 1001, 10, 1, "1.00", "9.00"), (2, 1001, 11, 1, "1.00", None)])
    assert c360.dominant_category(items, edge["orders"], edge["products"]).first().dominant_category == "Home"


def test_clean_items_drop_null_and_orphans(spark, edge):
    items = frame(
        spark,
        "fact_order_items",
        [(1, 1001, 10, None, "1.00", "1.00"), (2, 1001, 10, 1, None, "1.00"), (3, None, 10, 1, "1.00", "1.00"),
         (4, 1005, 10, 1, "1.00", "1.00"), (5, 1009, 10, 1, "0.00", "0.00")],
    )
    assert [r.order_item_id for r in silver.clean_items(items, edge["orders"]).collect()] == [5]


def test_views(spark, edge):
    silver.register_views(edge["orders"], edge["items"])
    assert spark.table("v_orders_completed").count() == 7
    assert spark.sql("select count(*) from v_orders_non_cancelled").first()[0] == 9
    assert spark.table("v_order_items_clean").columns == edge["items"].columns


def test_rfm(edge):
    base = rfm.rfm_base(edge["orders"], AS_OF)
    assert rows(base, "customer_id") == [(1, 123, 2, D("150.01")), (5, 181, 2, D("100.00")), (7, 172, 1, D("12.00"))]
    assert rows(rfm.rfm_scored(base), "customer_id") == [
        (1, 5, 3, 5, 535, "Loyal"),
        (5, 1, 5, 3, 153, "At Risk"),
        (7, 3, 1, 1, 311, "Needs Attention"),
    ]
    assert rows(report_segments(rfm.rfm_scored(base), base), "segment") == [
        ("At Risk", 1, D("100.00")), ("Loyal", 1, D("150.01")), ("Needs Attention", 1, D("12.00")),
    ]


def test_rfm_counts_repeated_orders_once_unless_keyed(edge):
    twice = edge["orders"].unionByName(edge["orders"])
    assert {r.frequency_orders for r in rfm.rfm_base(twice, AS_OF).collect()} == {1, 2}
    assert rows(rfm.rfm_base(edge["orders"], AS_OF, unique_orders=True), "customer_id") == rows(
        rfm.rfm_base(edge["orders"], AS_OF), "customer_id"
    )


def test_rfm_of_nobody(edge):
    with pytest.raises(RuntimeError, match="mart_rfm_base is empty"):
        rfm.rfm_scored(rfm.rfm_base(edge["orders"], "2030-01-01"))


def test_cohorts(edge):
    retention = cohort_retention(edge["orders"])
    day = date.fromisoformat
    assert [tuple(r) for r in retention.collect()] == [
        (day("2023-01-01"), day("2023-01-01"), 1, 1, D("1.0000")),
        (day("2023-06-01"), day("2023-06-01"), 1, 1, D("1.0000")),
        (day("2023-07-01"), day("2023-07-01"), 1, 1, D("1.0000")),
        (day("2023-07-01"), day("2024-01-01"), 1, 1, D("1.0000")),
        (day("2024-01-01"), day("2024-01-01"), 2, 2, D("1.0000")),
        (day("2024-01-01"), day("2024-02-01"), 2, 1, D("0.5000")),
    ]
    assert [tuple(r) for r in report_retention_curve(retention).collect()] == [(0, 1.0), (1, 0.5), (6, 1.0)]
    assert first_purchase(edge["orders"]).count() == 5


def test_cohorts_keep_activity_without_a_date(spark):
    orders = frame(
        spark,
        "fact_orders",
        [(1, 1, "2024-01-05", "completed", "card", "1.00", "0", "0"), (2, 1, None, "completed", "card", "1.00", "0", "0"),
         (3, 2, None, "completed", "card", "1.00", "0", "0"), (4, None, "2024-01-05", "completed", "card", "1.00", "0", "0")],
    )
    month = date(2024, 1, 1)
    found = {(r.cohort_month, r.active_month, r.cohort_size, r.active_users) for r in cohort_retention(orders).collect()}
    assert found == {(month, month, 1, 1), (month, None, 1, 1)}
    assert [tuple(r) for r in report_retention_curve(cohort_retention(orders)).collect()] == [(0, 1.0)]


def test_quality(edge):
    assert [tuple(r) for r in dq_report(edge["orders"], edge["items"]).collect()] == [
        ("no_negative_revenue_completed", True, 0),
        ("positive_quantity_items", False, 1),
        ("no_orphan_order_items", False, 1),
    ]


def test_quality_counts_rows_not_keys(spark, edge):
    orphans = frame(spark, "fact_order_items", [(i, None if i % 2 else 5555, 10, -1, "1.00", "1.00") for i in range(10)])
    found = {r.check: r.bad_rows for r in dq_report(edge["orders"], orphans).collect()}
    assert found == {"no_negative_revenue_completed": 0, "positive_quantity_items": 10, "no_orphan_order_items": 10}
    doubled = {"fact_orders": edge["orders"].unionByName(edge["orders"].limit(3))}
    assert dq_unique_keys(doubled, {"fact_orders": ["order_id"]}).first().bad_rows == 6


def test_quality_of_values_and_amounts(spark, edge):
    tables = {"dim_customers": edge["customers"], "dim_products": edge["products"], "fact_orders": edge["orders"]}
    assert {r.bad_rows for r in dq_accepted_values(tables).collect()} == {0}
    found = {r.check: r.bad_rows for r in dq_reconcile(edge["orders"], order_rollup(edge["items"])).collect()}
    assert found["line_total_is_price_times_quantity"] == 1
    assert found["order_total_is_lines_less_discount_plus_shipping"] == 0
    assert found["cancelled_orders_are_zero"] == found["cancelled_lines_are_zero"] == 0


def test_quality_of_empty_tables(edge):
    nothing = dq_report(edge["orders"].limit(0), edge["items"].limit(0))
    assert [(r.passed, r.bad_rows) for r in nothing.collect()] == [(True, 0)] * 3


def test_dates_table(spark):
    orders = frame(spark, "raw_orders", [(i, 1, d, "completed", "card", "1.00", "0", "0") for i, d in enumerate(
        ["2021-01-01", "2024-05-05", "2024-05-05", None])])
    assert rows(bronze.date_rows(orders), "date_key") == [
        (date(2021, 1, 1), 2021, 1, 1, 53, "Friday   ", "January  "),
        (date(2024, 5, 5), 2024, 5, 5, 18, "Sunday   ", "May      "),
    ]


def test_cluster_report(spark):
    clusters = frame(
        spark,
        "mart_customer_clusters",
        [(1, 0, 1, "10.00", "1", "1", "1", 1, "0"), (2, 0, 2, "10.01", "1", "1", "1", 1, "0"), (3, 1, 5, "1.00", "1", "1", "1", 1, "0")],
    )
    assert [tuple(r) for r in report_clusters(clusters).collect()] == [(0, 10.005, 1.5), (1, 1.0, 5.0)]
