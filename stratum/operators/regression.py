"""Closed-form least squares as aggregates: one pass of cross-product sums per
group (partial aggregation), then a small solve in column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grouped_ols2(df: DataFrame, group: str, y: str, x1: str, x2: str) -> DataFrame:
    """Per-group OLS ``y ~ 1 + x1 + x2`` from centred cross-products (one aggregate pass).

    Returns (group, n, b0, b1, b2); singular designs give NULL coefficients.
    """
    s = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.sum(x1).alias("s1"), F.sum(x2).alias("s2"), F.sum(y).alias("sy"),
        F.sum(F.col(x1) * F.col(x1)).alias("s11"), F.sum(F.col(x2) * F.col(x2)).alias("s22"),
        F.sum(F.col(x1) * F.col(x2)).alias("s12"), F.sum(F.col(x1) * F.col(y)).alias("s1y"),
        F.sum(F.col(x2) * F.col(y)).alias("s2y"))
    n = F.col("n")
    c = s.select(group, "n", (F.col("s1") / n).alias("m1"), (F.col("s2") / n).alias("m2"), (F.col("sy") / n).alias("my"),
                 (F.col("s11") - F.col("s1") * F.col("s1") / n).alias("c11"),
                 (F.col("s22") - F.col("s2") * F.col("s2") / n).alias("c22"),
                 (F.col("s12") - F.col("s1") * F.col("s2") / n).alias("c12"),
                 (F.col("s1y") - F.col("s1") * F.col("sy") / n).alias("c1y"),
                 (F.col("s2y") - F.col("s2") * F.col("sy") / n).alias("c2y"))
    det = F.col("c11") * F.col("c22") - F.col("c12") * F.col("c12")
    b1 = F.when(det != 0, (F.col("c22") * F.col("c1y") - F.col("c12") * F.col("c2y")) / det)
    b2 = F.when(det != 0, (F.col("c11") * F.col("c2y") - F.col("c12") * F.col("c1y")) / det)
    c = c.withColumn("b1", b1).withColumn("b2", b2)
    return c.select(group, "n", (F.col("my") - F.col("b1") * F.col("m1") - F.col("b2") * F.col("m2")).alias("b0"),
                    "b1", "b2")


@dataclass
class Fit:
    """Least squares ``y ~ 1 + x``: coefficients (intercept first), (X'X)^-1, residual and total sums of squares, n."""

    x: list[str]
    coefficients: np.ndarray
    inverse: np.ndarray
    rss: float
    tss: float
    n: int

    @property
    def r2(self) -> float:
        return 1 - self.rss / self.tss if self.tss > 0 else float("nan")

    @property
    def sd(self) -> float:
        return float(np.sqrt(self.rss / (self.n - len(self.coefficients))))


def multi_ols(df: DataFrame, y: str, x: Sequence[str]) -> Fit:
    """One aggregate of means and cross products (of values less a first guess of the means, for accuracy), solved as one small system.

    Rows with a missing value do not count. A singular design raises an error that names it.
    """
    v = [F.col(c).cast("double") for c in (*x, y)]
    rows = df.na.drop(subset=[*x, y])
    guess = rows.agg(*[F.avg(c) for c in v]).first()
    if guess[0] is None:
        raise ValueError("no complete rows to fit")
    d = [c - F.lit(float(g)) for c, g in zip(v, guess)]
    pairs = [(i, j) for i in range(len(v)) for j in range(i, len(v))]
    s = rows.agg(F.count(F.lit(1)), *[F.sum(c) for c in d], *[F.sum(d[i] * d[j]) for i, j in pairs]).first()
    n, p = s[0], len(x)
    off = np.array(s[1:p + 2]) / n
    c = np.zeros((p + 1, p + 1))
    for (i, j), value in zip(pairs, s[p + 2:]):
        c[i, j] = c[j, i] = value - n * off[i] * off[j]
    mean = np.array([float(g) for g in guess]) + off
    scale = np.sqrt(np.maximum(np.diag(c)[:p], 1e-300))
    within = c[:p, :p] / np.outer(scale, scale)
    if np.linalg.cond(within) > 1e12 or n <= p + 1:
        raise ValueError("the design is singular: a constant or dependent column, or too few rows")
    inner = np.linalg.inv(within) / np.outer(scale, scale)
    b = inner @ c[:p, p]
    inverse = np.zeros((p + 1, p + 1))
    inverse[1:, 1:] = inner
    inverse[0, 1:] = inverse[1:, 0] = -inner @ mean[:p]
    inverse[0, 0] = 1 / n + mean[:p] @ inner @ mean[:p]
    return Fit(list(x), np.concatenate([[mean[p] - b @ mean[:p]], b]), inverse, float(max(c[p, p] - b @ c[:p, p], 0.0)), float(c[p, p]), n)


def with_prediction(df: DataFrame, fit: Fit, level: float = 0.95) -> DataFrame:
    """yhat, se_pred = sd * sqrt(1 + x'(X'X)^-1 x), and the interval yhat -/+ t * se_pred, as column expressions."""
    from stratum.operators.ml import t_quantile

    v = [F.lit(1.0), *[F.col(c).cast("double") for c in fit.x]]
    add = lambda terms: sum(terms[1:], terms[0])
    yhat = add([F.lit(float(b)) * c for b, c in zip(fit.coefficients, v)])
    spread = add([F.lit(float(fit.inverse[i, j] * (1 if i == j else 2))) * v[i] * v[j] for i in range(len(v)) for j in range(i, len(v))])
    t = t_quantile(level, fit.n - len(fit.coefficients))
    out = df.withColumn("yhat", yhat).withColumn("se_pred", F.lit(fit.sd) * F.sqrt(1 + spread))
    return out.withColumn("lower", F.col("yhat") - t * F.col("se_pred")).withColumn("upper", F.col("yhat") + t * F.col("se_pred"))
