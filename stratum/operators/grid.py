"""Many elastic-net models from shared sums: one pass over the data per group and part, then every grid point from the moments.

A model ``y ~ x1..xp`` needs nothing of its rows but the sums, squares and products of x and y. These are summed for the
training and the validation part at once, one row per group (a metric, say); coordinate descent on the standardised moments
then gives all grid points of a group together, and the validation error follows from the other part's moments.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (regularisation, intercept?, share of the absolute-value penalty)
GRID = tuple(product((0.1, 0.01, 0.001), (True, False), (0.0, 0.25, 0.5, 0.75, 1.0)))


def moments(x: Sequence[str], y: str, part: Column) -> Column:
    """n, and the sums of products of (1, x, y), upper triangle row by row, of the rows in ``part``."""
    v = [F.lit(1.0), *[F.col(c).cast("double") for c in (*x, y)]]
    return F.array(*[F.coalesce(F.sum(F.when(part, v[i] * v[j])), F.lit(0.0)) for i in range(len(v)) for j in range(i, len(v))])


def elastic_nets(m: np.ndarray, grid: Sequence[tuple]) -> np.ndarray:
    """(grid, 1 + p) intercepts and slopes from a moment matrix of (1, x, y).

    The objective is that of Spark ML's iterative solver: squared error / 2n + penalty, on features and label divided by their sample deviations
    (the penalty weight too); centred where there is an intercept. Constant features have slope 0.
    """
    p, n = len(m) - 2, m[0, 0]
    out = np.zeros((len(grid), p + 1))
    if n < 2:
        return out
    mean = m[0, 1:] / n
    centred = m[1:, 1:] - n * np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(centred), 0) / (n - 1))
    sd[sd <= 1e-12 * np.sqrt(np.diag(m)[1:] / n)] = 0
    if sd[p] == 0:
        return np.where(np.arange(p + 1) == 0, np.where([[g[1]] for g in grid], mean[p], 0.0), 0.0)
    live = sd[:p] > 0
    scale = np.where(live, sd[:p], 1.0)
    for with_intercept in (True, False):
        rows = [i for i, g in enumerate(grid) if g[1] == with_intercept]
        a = (centred if with_intercept else m[1:, 1:]) / n
        gram, c = a[:p, :p] / np.outer(scale, scale), a[:p, p] / scale / sd[p]
        weight = np.array([grid[i][0] for i in rows]) / sd[p]
        l1, l2 = weight * [grid[i][2] for i in rows], weight * [1 - grid[i][2] for i in rows]
        b = np.zeros((len(rows), p))
        for _ in range(100_000):
            before = b.copy()
            for j in np.flatnonzero(live):
                rest = c[j] - b @ gram[j] + gram[j, j] * b[:, j]
                b[:, j] = np.sign(rest) * np.maximum(np.abs(rest) - l1, 0) / (gram[j, j] + l2)
            if np.abs(b - before).max(initial=0.0) < 1e-14:
                break
        slopes = b / scale * sd[p]
        out[rows, 1:] = slopes
        out[rows, 0] = (mean[p] - slopes @ mean[:p]) if with_intercept else 0.0
    return out


def grid_search(df: DataFrame, group: str, x: Sequence[str], y: str, train: Column, grid: Sequence[tuple] = GRID) -> DataFrame:
    """Per group the best grid point by validation RMSE (to 9 digits; the first of equals), fitted on all of the group's rows.

    Columns: group, reg_param, fit_intercept, elastic_net, valid_rmse, coefficients (intercept first), n. Rows with a missing
    value do not count. A group without validation rows takes the first grid point (valid_rmse NULL).
    """
    p = len(x)
    rows = df.na.drop(subset=[*x, y]).withColumn("_t", train)
    sums = rows.groupBy(group).agg(moments(x, y, F.col("_t")).alias("train"), moments(x, y, ~F.col("_t")).alias("valid"))
    kind = df.schema[group].dataType.simpleString()
    up = np.triu_indices(p + 2)

    def square(flat):
        out = np.zeros((p + 2, p + 2))
        out[up] = flat
        return out + out.T - np.diag(np.diag(out))

    def run(batches):
        for batch in batches:
            rows = []
            for train, valid in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                t, v = square(train), square(valid)
                fits = elastic_nets(t, grid)
                errors = np.hstack([-fits, np.ones((len(grid), 1))])  # y - intercept - x b as weights of (1, x, y)
                mse = np.maximum(np.einsum("gi,ij,gj->g", errors, v, errors), 0) / v[0, 0] if v[0, 0] else np.full(len(grid), np.nan)
                rmse = np.round(np.sqrt(mse), 9)
                best = 0 if np.isnan(rmse).all() else int(np.argmin(rmse))
                rows.append((*grid[best], None if np.isnan(rmse[best]) else float(rmse[best]), elastic_nets(t + v, [grid[best]])[0].tolist(),
                             int(t[0, 0] + v[0, 0])))
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.float64(), pa.bool_(), pa.float64(), pa.float64(), pa.list_(pa.float64()),
                                                                pa.int64()))] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=[group, "reg_param", "fit_intercept", "elastic_net", "valid_rmse",
                                                                                  "coefficients", "n"])

    return sums.mapInArrow(run, f"{group} {kind}, reg_param double, fit_intercept boolean, elastic_net double, valid_rmse double, "
                           "coefficients array<double>, n long")


def predicted(x: Sequence[str], coefficients: str = "coefficients") -> Column:
    """intercept + x b from a coefficient array."""
    return sum((F.col(coefficients)[i] * F.col(c).cast("double") for i, c in enumerate(x, 1)), F.col(coefficients)[0])
