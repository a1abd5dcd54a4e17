"""The retail model on top of a customer / part / orders / lineitem schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.ranking import global_rank
from ..schemas import conform

AS_OF = "2001-08-01"  # the last order date in the data
FIRST_SIGNUP = "1994-10-03"

# Order status letters and what they stand for here.
STATUS = {"F": "completed", "O": "returned", "P": "cancelled"}


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _hundredths(amount: str) -> Column:
    """A double with at most two decimals as a whole number; a decimal cast would go through text."""
    return F.rint(F.col(amount) * 100).cast("long")


def _scaled(whole: Column, digits: int, kind: str) -> Column:
    """A whole number times 10^-digits. Decimal multiplication is exact and cheaper than division."""
    return (whole * F.lit(f"1e-{digits}").cast(f"decimal({digits + 1},{digits})")).cast(kind)


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = _read(spark, folder, "nation").select("n_nationkey", "n_name")
    rows = _read(spark, folder, "customer")
    key = F.col("c_custkey")
    return conform(
        rows.join(nation, rows.c_nationkey == nation.n_nationkey, "left").select(
            key.alias("customer_id"),
            F.date_add(F.lit(FIRST_SIGNUP).cast("date"), (key % 365).cast("int")).alias("signup_date"),
            F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("channel"),
            F.concat(F.lit("d"), (key % 4).cast("string"), F.lit(".example")).alias("email_domain"),
            (F.col("c_acctbal") >= 0).alias("is_active"),
        ),
        "raw_customers",
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return conform(
        _read(spark, folder, "part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").alias("unit_cost"),
        ),
        "raw_products",
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the discounts of their lines summed up; plans that do not use the sum skip the lines."""
    discount = _hundredths("l_extendedprice") * _hundredths("l_discount")  # whole numbers: a sum of longs is half a decimal's size
    discounts = _read(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.sum(discount).alias("discount"))
    rows = _read(spark, folder, "orders")
    status = F.lit(None).cast("string")
    for letter, name in STATUS.items():
        status = F.when(F.col("o_orderstatus") == letter, name).otherwise(status)
    return conform(
        rows.join(discounts, rows.o_orderkey == discounts.l_orderkey, "left").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
            status.alias("status"),
            F.col("o_orderpriority").alias("payment_type"),
            F.col("o_totalprice").alias("order_total"),
            F.coalesce(_scaled(F.col("discount").cast("decimal(19,0)"), 4, "decimal(12,2)"), F.lit(0)).alias("discount_total"),
            F.lit(0).alias("shipping_total"),
        ),
        "raw_orders",
    )


def _item_columns(rows: DataFrame, item_id: Column) -> DataFrame:
    quantity, cents = F.col("l_quantity").cast("int"), _hundredths("l_extendedprice")
    unit_cents = F.call_function("div", cents, quantity.cast("long"))
    return conform(
        rows.select(
            item_id.alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            quantity.alias("quantity"),
            _scaled(unit_cents.cast("decimal(14,0)"), 2, "decimal(12,2)").alias("unit_price"),
            _scaled(cents.cast("decimal(14,0)"), 2, "decimal(12,2)").alias("line_total"),
        ),
        "raw_order_items",
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Items without their id, for plans that do not need one."""
    return _item_columns(_read(spark, folder, "lineitem"), F.lit(None)).drop("order_item_id")


def items_with_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Items numbered by order, line, part, supplier; the lines carry no key of their own."""
    rows = _read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"
    )
    return _item_columns(global_rank(rows, rows.columns, "item_id"), F.col("item_id"))
