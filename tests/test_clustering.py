from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators.clustering import best_k, choose_k, fit_kmeans, nearest_center, seeds, silhouettes, standardize
from basketry.plans.clusters import COLUMNS, cluster_customers, cluster_profile


def brute_silhouette(points, labels):
    distance = ((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2)
    scores = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            scores.append(0.0)
            continue
        a = distance[i][same].sum() / (same.sum() - 1)
        b = min(distance[i][labels == other].mean() for other in set(labels) - {own})
        scores.append((b - a) / max(a, b))
    return float(np.mean(scores))


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    middles = np.array([[0, 0], [8, 0], [0, 8], [8, 8], [20, 4]])
    points = np.vstack([m + rng.normal(0, 0.6, (60, 2)) for m in middles])
    df = spark.createDataFrame([(i, float(x), float(y), i // 60) for i, (x, y) in enumerate(points)], "id int, x double, y double, blob int")
    return df.cache(), points


def test_standardize(spark):
    df = spark.createDataFrame([(1, 1, 5), (2, 2, 5), (3, 3, 5), (4, 6, 5)], "id int, v int, same int")
    got = standardize(df, ["v", "same"]).orderBy("id").toPandas()
    v = np.array([1, 2, 3, 6.0])
    assert np.allclose(got["v"], (v - v.mean()) / v.std(), atol=1e-6)
    assert got["same"].tolist() == [0.0] * 4


def test_nearest_center_takes_the_first_on_ties(spark):
    df = spark.createDataFrame([(0.0,), (0.9,), (1.1,)], "x double")
    assert [r[0] for r in df.select(nearest_center(["x"], [[-1.0], [1.0], [1.0]])).collect()] == [0, 1, 1]


def test_silhouettes_match_all_pairs(spark, blobs):
    df, _ = blobs
    scaled = standardize(df, ["x", "y"])
    labelled = scaled.withColumn("odd", (F.col("id") % 7 == 0).cast("int")).withColumn("alone", F.when(F.col("id") == 0, 3).otherwise(F.col("blob") % 3))
    local = labelled.orderBy("id").toPandas()
    got = silhouettes(labelled, ["x", "y"], ["blob", "odd", "alone"])
    for name in got:
        assert got[name] == pytest.approx(brute_silhouette(local[["x", "y"]].to_numpy(), local[name].to_numpy()), abs=1e-9)


def test_one_cluster_has_no_silhouette(blobs):
    df, _ = blobs
    assert np.isnan(silhouettes(df.withColumn("one", F.lit(0)), ["x", "y"], ["one"])["one"])
    with pytest.raises(ValueError, match="one cluster"):
        best_k({3: float("nan")})
    assert best_k({3: 0.5, 4: 0.5, 5: 0.1}) == 3


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_choose_k_is_the_same_in_every_layout(spark, blobs, partitions):
    df, _ = blobs
    scaled = standardize(df, ["x", "y"])
    if not hasattr(test_choose_k_is_the_same_in_every_layout, "first"):
        test_choose_k_is_the_same_in_every_layout.first = choose_k(scaled, "id", ["x", "y"])
    first = test_choose_k_is_the_same_in_every_layout.first
    assert first[0] == 5 and len(first[2]) == 5 and set(first[1]) == set(range(3, 9))
    assert choose_k(scaled.repartition(partitions, F.rand(partitions)), "id", ["x", "y"]) == first


def test_cluster_customers_keeps_everyone(spark):
    rng = np.random.default_rng(1)
    schema = "customer_id int, " + ", ".join(
        f"{c} {'int' if c in ('total_orders', 'days_since_last_purchase') else 'decimal(14,2)'}" for c in COLUMNS
    )
    rows = spark.range(200).selectExpr(
        "cast(id as int) customer_id", "cast(id % 9 as int) total_orders", "cast(id % 4 * 100 as decimal(14,2)) total_revenue",
        "cast(id % 4 * 10 as decimal(14,2)) avg_order_value", "cast(2 as decimal(14,2)) avg_basket_size",
        "cast(id % 2 as decimal(14,4)) purchase_frequency_per_mo", "if(id % 50 = 0, null, cast(id % 30 as int)) days_since_last_purchase",
        "cast(0 as decimal(10,4)) returns_rate",
    )
    clusters, scores = cluster_customers(rows)
    assert clusters.select("customer_id").distinct().count() == clusters.count() == 200
    assert clusters.filter("days_since_last_purchase = 9999").count() == 4
    assert set(scores) == set(range(3, 9))
    profile = cluster_profile(clusters)
    assert profile.columns == ["cluster_id", *COLUMNS]
    with pytest.raises(RuntimeError, match="mart_customer_metrics is empty"):
        cluster_customers(rows.limit(0))


def test_profile_rounds_half_to_even(spark):
    from helpers import frame

    clusters = frame(
        spark,
        "mart_customer_clusters",
        [(i, 0, 1, total, "1", "1", "1", 1, "0") for i, total in enumerate(["0.12", "0.13", "0.12", "0.13"])],
    )
    assert cluster_profile(clusters).first().total_revenue == 0.12


def test_fitted_centers_are_the_means_of_their_points(blobs):
    df, _ = blobs
    scaled = standardize(df, ["x", "y"])
    for k, centers in fit_kmeans(scaled, "id", ["x", "y"], [3, 4]).items():
        means = scaled.groupBy(nearest_center(["x", "y"], centers).alias("c")).agg(F.avg("x"), F.avg("y")).orderBy("c")
        assert len(centers) == k
        assert np.allclose([list(r)[1:] for r in means.collect()], centers, atol=0.05)


def test_seeds_are_distinct_points(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(30)], "id int, x double")
    assert sorted(c[0] for c in seeds(df, "id", ["x"], 5)) == [0.0, 1.0, 2.0]
