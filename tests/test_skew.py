"""A key that holds a third of all rows: results stay whole and no task gets the lot."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketry.operators.quality import dq_report, order_rollup
from basketry.operators.hot_keys import heavy_keys, join_heavy
from basketry.plans import customer360 as c360, silver
from basketry.plans.cohorts import cohort_retention

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}
N = 300_000


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """A third of the items on order 7, a third of the orders of customer 1."""
    folder = str(tmp_path_factory.mktemp("hot"))
    spark.range(0, N, 1, 12).selectExpr(
        "id as order_item_id", "if(id % 3 = 0, 7L, pmod(hash(id), 30000)) as order_id", "cast(id % 100 as int) as product_id",
        "1 as quantity", "cast(1 as decimal(12,2)) as unit_price", "cast(1 as decimal(12,2)) as line_total",
    ).write.parquet(f"{folder}/items")
    spark.range(0, 30_000, 1, 12).selectExpr(
        "id as order_id", "if(id % 3 = 0, 1, cast(id as int)) as customer_id", "date_add(date'2020-01-01', cast(id % 700 as int)) as order_date",
        "'completed' as status", "'card' as payment_type", "cast(1 as decimal(12,2)) as order_total",
        "cast(0 as decimal(12,2)) as discount_total", "cast(0 as decimal(12,2)) as shipping_total",
    ).write.parquet(f"{folder}/orders")
    before = {key: spark.conf.get(key) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    products = spark.range(100).selectExpr("cast(id as int) product_id", "concat('c', id % 7) category")
    yield {"items": spark.read.parquet(f"{folder}/items"), "orders": spark.read.parquet(f"{folder}/orders"), "products": products}
    for key, value in before.items():
        spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def fixed(spark):
    """No adaptive execution: what a plan says is what runs."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_hot_order_is_split_in_the_line_join(hot, fixed):
    clean = silver.clean_items(hot["items"], hot["orders"], ["customer_id"])
    rows = sizes(clean)
    assert sum(rows) == N and clean.select("order_item_id").distinct().count() == N
    assert len(rows) == 16 and rows[-1] <= 2 * rows[8]
    assert sizes(hot["items"].join(hot["orders"], "order_id"))[-1] > N // 3  # what it would be otherwise


def test_hot_product_is_split(hot, fixed):
    items = hot["items"].withColumn("product_id", F.when(F.col("order_item_id") % 2 == 0, 5).otherwise(F.col("product_id")))
    assert heavy_keys(items, "product_id", 16)[0][0] == 5
    assert sizes(join_heavy(items, hot["products"], "product_id"))[-1] < N // 4
    revenue = c360.category_revenue(items, hot["orders"], hot["products"])
    assert revenue.agg(F.sum("cat_revenue")).first()[0] == N


def test_no_key_is_heavy(hot, spark):
    even = spark.range(0, N, 1, 8).select((F.col("id") % 30_000).alias("order_id"), "id")
    assert heavy_keys(even, "order_id", 16) == [] == heavy_keys(even.limit(0), "order_id", 16)
    joined = join_heavy(even.withColumn("order_id", F.when(F.col("id") > 5, F.col("order_id"))), hot["orders"], "order_id")
    assert joined.count() == N - 6  # NULL keys match nothing


def test_hot_order_collapses_before_the_shuffle(hot):
    units = c360.items_per_order(hot["items"])
    plan = units._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_sum")
    assert units.filter("order_id = 7").first().items_per_order >= N // 3


def test_hot_customer(hot):
    customers = hot["orders"].select("customer_id").distinct()
    mart = c360.customer_360(customers, hot["products"], hot["orders"], hot["items"], "2022-01-01")
    row = mart.filter("customer_id = 1").first()
    assert row.total_orders == 10_001  # its own order and a third of all
    assert mart.agg(F.sum("total_orders")).first()[0] == 30_000
    assert cohort_retention(hot["orders"]).agg(F.max("cohort_size")).first()[0] > 1


def test_checks_on_a_hot_order(hot):
    assert {r.bad_rows for r in dq_report(hot["orders"], hot["items"]).collect()} == {0}
    assert order_rollup(hot["items"]).agg(F.sum("n_rows")).first()[0] == N
    lost = hot["orders"].filter("order_id <> 7")
    assert dq_report(lost, hot["items"]).filter("bad_rows > 0").first().bad_rows >= N // 3
