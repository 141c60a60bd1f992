"""Weighted K-Means on two coordinates, made independent of the layout of its input."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreline.errors import DataValidationError
from acreline.functions.expressions import is_unusable, rbf_similarity
from acreline.operators.checks import check_clusters, require_columns
from acreline.operators.keys import parts_for

Centre = tuple[float, ...]


def bad_weights(weight: Column) -> Column:
    """Aggregate: rows whose weight is missing, not finite or negative."""
    return F.count_if(is_unusable(weight) | (weight < 0))


def weighted_points(df: DataFrame, x: Column, y: Column, weight: Column | None) -> DataFrame:
    """Equal points become one point with the summed weight; K-Means gives the same centres for it.

    This shrinks the table to its distinct positions before the shuffle, so neither copies nor a
    crowded place can make a hot partition.
    """
    points = df.select(x.alias("x"), y.alias("y"), (weight if weight is not None else F.lit(1.0)).alias("w"))
    return (
        points.filter("x IS NOT NULL AND y IS NOT NULL")
        .groupBy("x", "y")
        .agg(F.sum("w").alias("w"))
        .filter("w > 0")
    )


def fit_centres(
    df: DataFrame,
    x: Column,
    y: Column,
    weight: Column | None = None,
    clusters: int = 10,
    seed: int = 42,
    restarts: int = 1,
    max_iter: int = 300,
    tol: float = 1e-4,
    check: bool = True,
) -> list[Centre]:
    """Centres sorted by position (so that their numbers mean the same in every run)."""
    check_clusters(clusters)
    if weight is not None and check:
        bad = df.agg(bad_weights(weight).alias("n")).first()["n"]
        if bad:
            raise DataValidationError(f"{bad} cluster weights are missing, infinite or negative")
    points = weighted_points(df, x, y, weight).persist()
    try:
        shape = points.agg(F.count(F.lit(1)), F.var_pop("x") + F.var_pop("y")).first()
        laid = points.repartition(parts_for(shape[0], 20_000), "x", "y").sortWithinPartitions("x", "y")
        # Stop when the squared moves of all centres sum to 1e-4 of the mean variance of an axis.
        # Spark tests each centre on its own, by distance.
        stop = math.sqrt(tol * (shape[1] or 0.0) / 2.0 / clusters) or 1e-9
        table = VectorAssembler(inputCols=["x", "y"], outputCol="point").transform(laid).select("point", "w").persist()
        try:
            best = None
            for turn in range(restarts):
                model = KMeans(
                    k=clusters, seed=seed + turn, weightCol="w", featuresCol="point", maxIter=max_iter, tol=stop, solver="block"
                ).fit(table)
                cost = model.summary.trainingCost
                if best is None or cost < best[0]:
                    best = (cost, [tuple(float(v) for v in c) for c in model.clusterCenters()])
        finally:
            table.unpersist()
    finally:
        points.unpersist()
    return sorted(best[1])


def similarity_columns(point: Sequence[Column], centres: Sequence[Centre], gamma: float = 1.0) -> dict[str, Column]:
    """cluster_<i>_similarity for every centre."""
    return {f"cluster_{i}_similarity": rbf_similarity(point, c, gamma) for i, c in enumerate(centres)}


def max_similarity(point: Sequence[Column], centres: Sequence[Centre], gamma: float = 1.0) -> Column:
    """Closeness to the nearest centre."""
    values = list(similarity_columns(point, centres, gamma).values())
    return F.greatest(*values) if len(values) > 1 else values[0]


def hotspots(
    df: DataFrame,
    lon: str = "longitude",
    lat: str = "latitude",
    weight: str | None = "median_house_value",
    clusters: int = 10,
    gamma: float = 1.0,
    seed: int = 42,
    restarts: int = 10,
) -> DataFrame:
    """Value-weighted hotspots on raw coordinates, best of several starts: adds max_similarity."""
    require_columns(df, [lon, lat, *([weight] if weight else [])])
    point = (F.col(lon), F.col(lat))
    centres = fit_centres(df, *point, F.col(weight) if weight else None, clusters, seed, restarts)
    return df.withColumn("max_similarity", max_similarity(point, centres, gamma))
