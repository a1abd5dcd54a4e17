"""The tables behind the charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import months_between_starts
from ..functions.numbers import float_mean


def report_segments(scored: DataFrame, base: DataFrame) -> DataFrame:
    """Customers and revenue by segment, largest revenue first."""
    return (
        scored.select("customer_id", "segment")
        .join(base.select("customer_id", "monetary_value"), "customer_id")
        .groupBy("segment")
        .agg(F.count("*").alias("customers"), F.sum("monetary_value").alias("revenue_365d"))
        .orderBy(F.desc("revenue_365d"))
    )


def report_retention_curve(retention: DataFrame) -> DataFrame:
    """Mean retention by months since first purchase; every cohort counts the same."""
    index = months_between_starts(F.col("active_month"), F.col("cohort_month"))
    return (
        retention.filter(F.col("active_month").isNotNull())
        .groupBy(index.alias("month_index"))
        .agg(float_mean(F.sum("retention_rate"), F.count("retention_rate")).alias("retention_rate"))
        .orderBy("month_index")
    )


def report_clusters(clusters: DataFrame) -> DataFrame:
    """Mean revenue and orders by cluster."""
    return (
        clusters.groupBy("cluster_id")
        .agg(
            float_mean(F.sum("total_revenue"), F.count("total_revenue")).alias("avg_revenue"),
            float_mean(F.sum("total_orders"), F.count("total_orders")).alias("avg_orders"),
        )
        .orderBy("cluster_id")
    )
