"""Centroid geometry on array columns: per-label centroids, nearest-centroid
assignment, distance-to-centroid anomalies (M6/M7 semantics without a model fit)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.scalar import squared_distance


def group_centroids(df: DataFrame, group: str, vec: str) -> DataFrame:
    """Per-group mean vector: element-wise sums by ``posexplode`` + partial aggregation.

    Output has one row per group (k rows, bounded by the number of groups).
    """
    e = df.select(group, F.posexplode(vec).alias("_i", "_x"))
    per = e.groupBy(group, "_i").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    return (per.groupBy(group)
            .agg(F.sort_array(F.collect_list(F.struct("_i", "_m"))).alias("_s"))
            .select(group, F.transform("_s", lambda s: s["_m"]).alias("centroid")))


def centroid_literal(centroids: Sequence[Sequence[float]]) -> Column:
    """A (k × d) model as an array literal — model-sized, not data-sized."""
    return F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centroids])


def nearest_centroid(vec, centroids: Sequence[Sequence[float]]) -> tuple[Column, Column]:
    """(index of the nearest centroid, squared distance to it); ties pick the first."""
    v = F.col(vec) if isinstance(vec, str) else vec
    d = F.transform(centroid_literal(centroids), lambda c: squared_distance(v, c))
    best = F.array_min(d)
    return (F.array_position(d, best) - 1).cast("int"), best


def collect_centroids(centroids: DataFrame, group: str) -> list[list[float]]:
    """Bring the (bounded, k-row) centroid table to the driver in group order."""
    rows = centroids.orderBy(group).collect()
    return [list(r["centroid"]) for r in rows]


def assign_clusters(df: DataFrame, vec: str, centroids: Sequence[Sequence[float]],
                    out: str = "cluster", dist: str = "sqdist") -> DataFrame:
    c, d = nearest_centroid(vec, centroids)
    return df.withColumn(out, c).withColumn(dist, d)


def farthest_points(df: DataFrame, dist: str, n: int = 100) -> DataFrame:
    """Rows whose distance is at least the ``n``-th largest (ties may give more than n).

    The threshold is a top-n (bounded per task), then a narrow filter.
    """
    thr = df.select(dist).orderBy(F.col(dist).desc()).limit(n).agg(F.min(dist)).first()[0]
    return df.where(F.col(dist) >= F.lit(thr)) if thr is not None else df.limit(0)
