"""Behavioural clusters of customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import float_mean
from ..operators.clustering import SEED, choose_k, nearest_center, standardize
from ..schemas import conform
from ..sources.staging import stage
from ..sources.tables import require_rows

# Features in order, and what a customer without the measure gets.
FEATURES = {
    "total_orders": 0,
    "total_revenue": 0,
    "avg_order_value": 0,
    "avg_basket_size": 0,
    "purchase_frequency_per_mo": 0,
    "days_since_last_purchase": 9999,
    "returns_rate": 0,
}
COLUMNS = list(FEATURES)


def cluster_features(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        "customer_id",
        *[F.coalesce(c, F.lit(v).cast(metrics.schema[c].dataType)).alias(c) for c, v in FEATURES.items()],
    )


def assign_clusters(features: DataFrame, centers: list[list[float]]) -> DataFrame:
    """The cluster mart for given centres in standardised units."""
    scaled = standardize(features.withColumns({f"z_{c}": F.col(c) for c in COLUMNS}), [f"z_{c}" for c in COLUMNS])
    labelled = scaled.withColumn("cluster_id", nearest_center([f"z_{c}" for c in COLUMNS], centers))
    return conform(labelled, "mart_customer_clusters")


def cluster_customers(metrics: DataFrame, seed: int = SEED) -> tuple[DataFrame, dict[int, float]]:
    """The cluster mart with the best k, and the silhouette of every k tried."""
    require_rows(metrics, "mart_customer_metrics is empty: build it first")
    features = stage(cluster_features(metrics))
    _, scores, centers = choose_k(standardize(features, COLUMNS), "customer_id", COLUMNS, seed=seed)
    return assign_clusters(features, centers), scores


def cluster_profile(clusters: DataFrame) -> DataFrame:
    """Mean of every feature per cluster, two digits, half to even."""
    return clusters.groupBy("cluster_id").agg(
        *[F.bround(float_mean(F.sum(c), F.count(c)), 2).alias(c) for c in COLUMNS]
    )
