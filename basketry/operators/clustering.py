"""Standardising, k-means, silhouettes and the choice of k; the same at every size and in every layout."""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

SEED = 42
K_MIN, K_MAX = 3, 8
MAX_ITERATIONS = 300
TOLERANCE = 1e-4  # of the squared movement of all centres together, in units of the feature variance
FEW_PARTITIONS = 64  # with at most so many, tasks' rows (a few each) go to the driver without another shuffle
GRID = 1 << 20  # standardised values are multiples of 1 / GRID, so that their sums are exact in any order

Centers = list[list[float]]


def _exact(column: str) -> Column:
    """The sum of a column as a decimal: the same whatever the order of the rows."""
    return F.sum(F.col(column).cast("decimal(18,6)"))


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns as doubles with mean 0 and population standard deviation 1, on the grid; a constant column becomes 0."""
    squares = {c: F.sum((F.col(c).cast("decimal(18,6)") * F.col(c).cast("decimal(18,6)")).cast("decimal(38,12)")) for c in columns}
    stats = df.agg(
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[_exact(c).alias(f"sum_{c}") for c in columns],
        *[squares[c].alias(f"square_{c}") for c in columns],
    ).first()
    scaled = {}
    for c in columns:
        n = stats[f"n_{c}"] or 1
        total, square = Fraction(stats[f"sum_{c}"] or 0), Fraction(stats[f"square_{c}"] or 0)
        deviation = math.sqrt(square / n - (total / n) ** 2) or 1.0
        scaled[c] = F.rint((F.col(c).cast("double") - F.lit(float(total / n))) / F.lit(deviation) * GRID) / GRID
    return df.withColumns(scaled)


def _squared(columns: list[str], center: list[float]) -> Column:
    """Squared distance from a point."""
    gaps = [f"(`{c}` - ({float(x)!r}D))" for c, x in zip(columns, center)]
    return F.expr(" + ".join(f"{gap} * {gap}" for gap in gaps))


def nearest_center(columns: list[str], centers: list[list[float]]) -> Column:
    """Index of the closest centre by Euclidean distance, the first one on ties."""
    distances = []
    for center in centers:
        gaps = [f"(`{c}` - ({float(x)!r}D))" for c, x in zip(columns, center)]
        distances.append(" + ".join(f"{gap} * {gap}" for gap in gaps))
    each = f"array({', '.join(distances)})"
    return F.expr(f"cast(array_position({each}, array_min({each})) - 1 AS int)")


def _sums(points: DataFrame, columns: list[str], labels: dict[str, Column]) -> dict[str, dict[int, tuple]]:
    """Per label column and label: rows, sums of the columns, and sum of squares, in units of the grid.

    One job for all label columns; at most one row per label leaves a task.
    """
    whole = [(F.col(c) * GRID).cast("long") for c in columns]
    square = reduce(Column.__add__, [x.cast("decimal(38,0)") * x.cast("decimal(19,0)") for x in whole])
    each = F.array(*[F.struct(F.lit(name).alias("name"), label.alias("label")) for name, label in labels.items()])
    rows = points.select(F.explode(each).alias("of"), *[x.alias(f"_{i}") for i, x in enumerate(whole)], square.cast("decimal(38,0)").alias("_sq"))
    found = rows.groupBy("of.name", "of.label").agg(
        F.count("*").alias("n"), *[F.sum(F.col(f"_{i}").cast("decimal(20,0)")).alias(f"s{i}") for i in range(len(columns))], F.sum("_sq").alias("sq")
    )
    sums: dict[str, dict[int, tuple]] = {name: {} for name in labels}
    for r in found.collect():
        sums[r["name"]][r["label"]] = (r["n"], [int(r[f"s{i}"]) for i in range(len(columns))], int(r["sq"]))
    return sums


def lloyd_step(points: DataFrame, columns: list[str], centers: dict[str, Centers]) -> dict[str, Centers]:
    """Every set of centres moved to the means of its points, all sets in one job; a centre without points stays.

    The centres travel as data, not as text of the plan: a new plan text in every step would be compiled anew. With few
    partitions the tasks' sums, a row per centre and task, come to the driver as they are; else they are added up first.
    """

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, x = [], batch[columns].to_numpy(float)
            whole = np.rint(x * GRID).astype(np.int64)
            for name, places in centers.items():
                label = np.stack([sum((x[:, j] - c[j]) ** 2 for j in range(len(columns))) for c in places]).argmin(axis=0)
                for i in np.unique(label):
                    mine = whole[label == i]
                    rows.append((name, int(i), len(mine), *map(int, mine.sum(axis=0))))
            yield pd.DataFrame(rows, columns=["name", "label", "n", *[f"s{j}" for j in range(len(columns))]])

    places = [f"s{j}" for j in range(len(columns))]
    partial = points.select(*columns).mapInPandas(of_batches, "name string, label int, n long, " + ", ".join(f"{c} long" for c in places))
    if points.rdd.getNumPartitions() > FEW_PARTITIONS:
        partial = partial.groupBy("name", "label").agg(F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in places])
    sums: dict[str, dict[int, tuple]] = {name: {} for name in centers}
    for r in partial.collect():
        n, s = sums[r["name"]].get(r["label"], (0, [0] * len(places)))
        sums[r["name"]][r["label"]] = (n + r["n"], [a + int(r[c]) for a, c in zip(s, places)])
    moved = {}
    for name, old in centers.items():
        moved[name] = [
            [s / sums[name][i][0] / GRID for s in sums[name][i][1]] if i in sums[name] else center for i, center in enumerate(old)
        ]
    return moved


def seeds(points: DataFrame, id_col: str, columns: list[str], k: int, seed: int = SEED) -> Centers:
    """The first centres: each a point drawn with probability in proportion to its squared distance from those before.

    The draw is the smallest of -log(u) / distance over the points, with u a hash of id, seed and round: one
    aggregate a round, the same point whatever the layout. Fewer distinct points than k give fewer seeds.
    """
    chosen: Centers = []
    id_type = points.schema[id_col].dataType.simpleString()
    schema = f"key double, id {id_type}, point array<double>"
    for number in range(k):
        u = (F.conv(F.substring(F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(f"{seed}:{number}"))), 1, 12), 16, 10).cast("double") + 1) / (2.0**48 + 1)

        def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """The least of a task; the seeds before travel as data."""
            best = None
            for batch in batches:
                x, key = batch[columns].to_numpy(float), batch["_draw"].to_numpy(float)
                if chosen:
                    gap = np.stack([sum((x[:, j] - c[j]) * (x[:, j] - c[j]) for j in range(len(columns))) for c in chosen]).min(axis=0)
                    key = np.divide(key, gap, out=np.full(len(key), np.inf), where=gap > 0)
                if len(key) and np.isfinite(least := key.min()):
                    tied = batch[id_col][key == least]
                    at = tied.idxmin() if tied.dtype != object else tied.index[np.argsort(tied.to_numpy(), kind="stable")[0]]
                    found = (float(least), batch[id_col][at], x[batch.index.get_loc(at)].tolist())
                    best = found if best is None or found[:2] < best[:2] else best
            yield pd.DataFrame([best] if best else [], columns=["key", "id", "point"])

        drawn = points.select(id_col, *columns, (-F.log(u)).alias("_draw")).mapInPandas(of_batches, schema)
        if points.rdd.getNumPartitions() > FEW_PARTITIONS:
            drawn = drawn.agg(F.min_by(F.struct("key", "id", "point"), F.struct("key", "id")).alias("least")).filter("least IS NOT NULL").select("least.*")
        rows = drawn.collect()
        if not rows:
            break
        chosen.append(list(min(rows, key=lambda r: (r["key"], r["id"]))["point"]))
    return chosen


def fit_kmeans(points: DataFrame, id_col: str, columns: list[str], ks: list[int], seed: int = SEED) -> dict[int, Centers]:
    """Centres for every k in `ks` over standardised `columns`.

    The fits share their seeds (k takes the first k) and their jobs: one pass over the points moves the centres
    of all fits that still move. Sums are exact, so the result does not depend on partitions.
    """
    first = seeds(points, id_col, columns, max(ks), seed)
    centers = {k: first[:k] for k in ks}
    moving = list(ks)
    for _ in range(MAX_ITERATIONS):
        if not moving or not first:
            break
        moved = lloyd_step(points, columns, {str(k): centers[k] for k in moving})
        still = []
        for k in moving:
            shift = sum((a - b) ** 2 for old, new in zip(centers[k], moved[str(k)]) for a, b in zip(old, new))
            centers[k] = moved[str(k)]
            if shift > TOLERANCE:
                still.append(k)
        moving = still
    return centers


def silhouettes(points: DataFrame, columns: list[str], labels: list[str]) -> dict[str, float]:
    """Mean silhouette by squared Euclidean distance per label column; NaN where there is a single cluster.

    The mean squared distance of a point from a cluster follows from the cluster's size, sum and sum of
    squares, so this is exact over all rows and linear: one job for the sums, one for the scores.
    """
    sums = _sums(points, columns, {name: F.col(name) for name in labels})
    means, scores = {}, []
    for number, name in enumerate(labels):
        clusters = sorted(sums[name].items())
        if len(clusters) < 2:
            scores.append(F.lit(None).cast("double").alias(name))
            continue
        own_size, mean = F.lit(0), {}
        for label, (n, total, square) in clusters:
            spread = square / n - sum((t / n) ** 2 for t in total)  # of the cluster about its mean, in units of the grid
            mean[label] = f"_mean_{number}_{label}"  # a column: it is used several times
            means[mean[label]] = _squared(columns, [t / n / GRID for t in total]) + F.lit(max(0.0, spread) / GRID**2)
            own_size = F.when(F.col(name) == label, n).otherwise(own_size)
        inside = F.coalesce(*[F.when(F.col(name) == label, F.col(m)) for label, m in mean.items()])
        inside = inside * own_size / F.greatest(own_size - 1, F.lit(1))
        outside = F.least(*[F.when(F.col(name) != label, F.col(m)) for label, m in mean.items()])
        sides = F.struct(inside.alias("inside"), outside.alias("outside"), (own_size > 1).alias("joined"))
        means[f"_sides_{number}"] = sides
        own = F.col(f"_sides_{number}")
        larger = F.greatest(own["inside"], own["outside"])
        score = F.when(own["joined"] & (larger > 0), (own["outside"] - own["inside"]) / larger).otherwise(0.0)
        scores.append((F.sum(score.cast("decimal(20,15)")).cast("double") / F.count("*")).alias(name))
    for some in ("_mean", "_sides"):
        points = points.withColumns({c: e for c, e in means.items() if c.startswith(some)})
    found = points.agg(*scores).first()
    return {name: math.nan if found[name] is None else found[name] for name in labels}


def best_k(scores: dict[int, float]) -> int:
    """The k with the highest silhouette, the smallest on ties."""
    usable = {k: s for k, s in scores.items() if not math.isnan(s)}
    if not usable:
        raise ValueError("all rows fell into one cluster: there is nothing to choose from")
    return max(usable, key=lambda k: (round(usable[k], 12), -k))


def score_centers(points: DataFrame, columns: list[str], centers: dict[int, Centers]) -> dict[int, float]:
    """The silhouette of every set of centres."""
    labelled = points.select(*columns, *[nearest_center(columns, c).alias(f"k{k}") for k, c in centers.items()])
    found = silhouettes(labelled, columns, [f"k{k}" for k in centers])
    return {k: found[f"k{k}"] for k in centers}


def choose_k(
    df: DataFrame, id_col: str, columns: list[str], k_min: int = K_MIN, k_max: int = K_MAX, seed: int = SEED
) -> tuple[int, dict[int, float], Centers]:
    """Fit every k and keep the one with the best silhouette.

    Returns k, the silhouette of each k, and the centres of the chosen one. The points are cached: the fits
    read them many times. Lost cache blocks are rebuilt from `df`, so pass a stored table.
    """
    points = df.select(id_col, *columns).repartition(df.sparkSession.sparkContext.defaultParallelism)
    points = points.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centers = fit_kmeans(points, id_col, columns, list(range(k_min, k_max + 1)), seed)
        by_k = score_centers(points, columns, centers)
    finally:
        points.unpersist()
    best = best_k(by_k)
    return best, by_k, centers[best]
