"""Recency, frequency and monetary value: base measures, scores and segments."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import as_of_column
from ..functions.segments import composite_score, segment_of
from ..operators.ranking import score_quintiles
from ..schemas import conform
from ..sources.tables import require_rows
from .silver import completed

WINDOW_DAYS = 365

# Score column: metric and whether more of it is better.
SCORES = {
    "r_score": ("recency_days", False),
    "f_score": ("frequency_orders", True),
    "m_score": ("monetary_value", True),
}


def rfm_base(
    orders: DataFrame, as_of: date | str | None = None, days: int = WINDOW_DAYS, unique_orders: bool = False
) -> DataFrame:
    """Per customer over completed orders of the last `days` days (first day included, no upper limit).

    Orders count by distinct id. For a table known to hold each id once, as keyed writes guarantee,
    `unique_orders` counts rows instead and saves shuffling all orders to tell ids apart.
    """
    today = as_of_column(as_of)
    recent = completed(orders).filter((F.col("order_date") >= F.date_sub(today, days)) & F.col("customer_id").isNotNull())
    measured = recent.groupBy("customer_id").agg(
        F.date_diff(today, F.max("order_date")).alias("recency_days"),
        (F.count if unique_orders else F.count_distinct)("order_id").alias("frequency_orders"),
        F.sum("order_total").alias("monetary_value"),
    )
    return conform(measured, "mart_rfm_base")


def rfm_segments(base: DataFrame) -> DataFrame:
    """The base measures with scores, composite score and segment: the export table.

    `base` is read more than once; pass a stored table.
    """
    require_rows(base, "mart_rfm_base is empty: build it first")
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return (
        score_quintiles(base, "customer_id", SCORES)
        .withColumn("rfm_score", composite_score(r, f, m))
        .withColumn("segment", segment_of(r, f, m))
    )


def rfm_scored(base: DataFrame) -> DataFrame:
    """The scored mart."""
    return conform(rfm_segments(base), "mart_rfm_scored")
