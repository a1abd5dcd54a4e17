"""Monthly retention by month of first purchase."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.dates import month_start
from ..functions.numbers import ratio
from ..schemas import conform
from .silver import completed


def first_purchase(orders: DataFrame) -> DataFrame:
    """Customer and month of the first completed order."""
    return completed(orders).groupBy("customer_id").agg(month_start(F.min("order_date")).alias("cohort_month"))


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Share of each cohort that ordered again, per month.

    Orders shrink to distinct (customer, month) pairs before anything else, so a customer is never more
    rows than months. On pairs a plain count is a distinct count, the cohort is the customer's first month,
    and the size of a cohort is its activity in its own month: no self-join is needed.
    """
    pairs = (
        completed(orders)
        .filter(F.col("customer_id").isNotNull())
        .select("customer_id", month_start(F.col("order_date")).alias("active_month"))
        .distinct()
    )
    first = F.min("active_month").over(Window.partitionBy("customer_id"))
    active = (
        pairs.withColumn("cohort_month", first)
        .filter(F.col("cohort_month").isNotNull())
        .groupBy("cohort_month", "active_month")
        .agg(F.count("*").alias("active_users"))
    )
    own_month = F.when(F.col("active_month") == F.col("cohort_month"), F.col("active_users"))
    sized = active.withColumn("cohort_size", F.max(own_month).over(Window.partitionBy("cohort_month")))
    rates = sized.withColumn("retention_rate", ratio(F.col("active_users"), F.col("cohort_size"), "decimal(10,4)"))
    return conform(rates, "mart_cohort_retention").orderBy("cohort_month", F.asc_nulls_last("active_month"))
