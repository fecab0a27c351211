"""Regression per group on any number of covariates: sums of the whole design, then one small solve per group.

The design of a row is (1, covariates..., tested value). Every pass over the data is one aggregate with map-side combine whose
result is an array of sums per group; the matrices of many groups are solved together, in Arrow batches of one row per group.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators.joins import lookup_join
from stratum.session import cut_lineage


def cholesky_solve(a: np.ndarray, b: np.ndarray, tol: float = 1e-10) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a batch of symmetric matrices: (a^-1 b, last diagonal entry of a^-1, is it positive definite?).

    A pivot below ``tol`` of its diagonal entry marks the matrix as singular; its results are NaN.
    """
    m, p = b.shape
    low, ok = np.zeros((m, p, p)), np.ones(m, bool)
    for j in range(p):
        pivot = a[:, j, j] - (low[:, j, :j] ** 2).sum(1)
        ok &= pivot > tol * np.abs(a[:, j, j])
        low[:, j, j] = np.sqrt(np.where(ok, pivot, 1.0))
        low[:, j + 1:, j] = (a[:, j + 1:, j] - np.einsum("mik,mk->mi", low[:, j + 1:, :j], low[:, j, :j])) / low[:, j, j][:, None]
    y = np.zeros((m, p))
    for j in range(p):
        y[:, j] = (b[:, j] - (low[:, j, :j] * y[:, :j]).sum(1)) / low[:, j, j]
    x = np.zeros((m, p))
    for j in reversed(range(p)):
        x[:, j] = (y[:, j] - (low[:, j + 1:, j] * x[:, j + 1:]).sum(1)) / low[:, j, j]
    x[~ok] = np.nan
    last = np.where(ok, 1.0 / low[:, -1, -1] ** 2, np.nan)  # the last unit vector is solved by the last pivot alone
    return x, last, ok


def _square(parts: np.ndarray, p: int) -> np.ndarray:
    """Rows of upper triangles (row by row) -> symmetric matrices."""
    out = np.zeros((len(parts), p, p))
    rows, cols = np.triu_indices(p)
    out[:, rows, cols] = out[:, cols, rows] = parts
    return out


def _numpy(column) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    if not len(column):
        return np.zeros((0, 0))
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def design(df: DataFrame, samples: DataFrame, y: str, covariates: Sequence[str], group: str = "variant_id", key: str = "sample_id",
           value: str = "gt") -> DataFrame:
    """(group, _y, _x0.._xp): rows with a value and no missing covariate; _x0 is 1, the last one the tested value."""
    told = samples.select(key, F.col(y).cast("double").alias("_y"), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(covariates, 1)])
    told = told.na.drop()
    rows = lookup_join(df.where(F.col(value).isNotNull()).select(group, key, F.col(value).cast("double").alias(f"_x{len(covariates) + 1}")), told, key)
    return rows.withColumn("_x0", F.lit(1.0)).select(group, "_y", *[f"_x{i}" for i in range(len(covariates) + 2)])


def linear_fits(df: DataFrame, samples: DataFrame, y: str, covariates: Sequence[str], group: str = "variant_id", key: str = "sample_id",
                value: str = "gt") -> DataFrame:
    """Least squares ``y ~ 1 + covariates + value`` per group: n, beta, se, t_stat of the value, and all coefficients.

    One aggregate: the cross products of the design and y as one array of sums per group. A singular design, or one without
    a degree of freedom left, has NULL beta, se and t_stat.
    """
    p = len(covariates) + 2
    x = [F.col(f"_x{i}") for i in range(p)] + [F.col("_y")]
    sums = F.array(*[F.sum(x[i] * x[j]) for i in range(p + 1) for j in range(i, p + 1)])
    rows = design(df, samples, y, covariates, group, key, value).groupBy(group).agg(F.count("*").alias("n"), sums.alias("sums"))

    def run(batches):
        for batch in batches:
            whole = _square(_numpy(batch.column(2)).reshape(batch.num_rows, -1), p + 1) if batch.num_rows else np.zeros((0, p + 1, p + 1))
            n = batch.column(1).to_numpy()
            coef, last, ok = cholesky_solve(whole[:, :p, :p], whole[:, :p, p])
            left = np.where(n > p, n - p, np.nan)
            rss = np.maximum(whole[:, p, p] - (coef * whole[:, :p, p]).sum(1), 0.0)
            se = np.sqrt(rss / left * last)
            beta = np.where(np.isnan(left), np.nan, coef[:, -1])
            with np.errstate(divide="ignore", invalid="ignore"):
                told = [beta, se, beta / se]
            found = pa.array([c.tolist() if good else None for c, good in zip(coef, ok)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(v, from_pandas=True) for v in told], found],
                                             names=[group, "n", "beta", "se", "t_stat", "coefficients"])

    kind = rows.schema[group].dataType.simpleString()
    return rows.mapInArrow(run, f"{group} {kind}, n long, beta double, se double, t_stat double, coefficients array<double>")


def normal_equations(df: DataFrame, samples: DataFrame, fits: DataFrame, y: str, covariates: Sequence[str], logistic: bool = False,
                     group: str = "variant_id", key: str = "sample_id", value: str = "gt") -> DataFrame:
    """Per group: worst = the largest |sum of x_i (y - fitted)| over the design's columns, against the sums of |x_i y|."""
    p = len(covariates) + 2
    rows = design(df, samples, y, covariates, group, key, value).join(fits.select(group, "coefficients"), group)
    eta = sum((F.col("coefficients")[i] * F.col(f"_x{i}") for i in range(1, p)), F.col("coefficients")[0])
    left = F.col("_y") - (1 / (1 + F.exp(-eta)) if logistic else eta)
    return rows.groupBy(group).agg(F.greatest(*[F.abs(F.sum(F.col(f"_x{i}") * left)) / (1 + F.sum(F.abs(F.col(f"_x{i}") * F.col("_y"))))
                                                for i in range(p)]).alias("worst"))


def logistic_fits(df: DataFrame, samples: DataFrame, y: str, covariates: Sequence[str], group: str = "variant_id", key: str = "sample_id",
                  value: str = "gt", far: float = 30.0) -> DataFrame:
    """Logistic regression ``y ~ 1 + covariates + value`` per group with a Wald test of the value.

    Newton steps on arrays of sums (log-likelihood, score, information). The rows are placed by group once and checkpointed
    with that placement, so that a step moves coefficients only. A step that lowers the likelihood is halved. There is no cap
    on the steps: each group ends as ``converged`` (the Newton decrement vanishes), ``singular`` (the information is not
    positive definite) or ``separated`` (a fitted log-odds beyond ``far``, where the likelihood has no maximum: such steps
    do not shrink). Only converged groups have beta, se, z_stat, p_wald and coefficients.
    """
    p = len(covariates) + 2
    kind = df.schema[group].dataType.simpleString()
    rows = cut_lineage(design(df, samples, y, covariates, group, key, value).repartition(group))
    zero = F.array(*[F.lit(0.0)] * p)
    state = rows.select(group).distinct().select(group, zero.alias("b"), zero.alias("before"), F.lit(None).cast("double").alias("ll"),
                                                 F.lit("open").alias("status"), F.lit(None).cast("double").alias("se"), F.lit(0).cast("long").alias("n"))
    state = cut_lineage(state)
    x = [F.col(f"_x{i}") for i in range(p)]
    schema = f"{group} {kind}, b array<double>, before array<double>, ll double, status string, se double, n long"

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            b, before, s = (_numpy(batch.column(i)) for i in (1, 2, 4))
            old = batch.column(3).to_numpy(zero_copy_only=False).astype(float)
            n, top, ll, score = s[:, 0], s[:, 1], s[:, 2], s[:, 3:3 + p]
            step, last, ok = cholesky_solve(_square(s[:, 3 + p:], p), score)
            gain = (step * score).sum(1)
            worse = ll < old - 1e-9 * np.abs(old)  # NaN in the first step: not worse
            done = ok & ~worse & (gain < 1e-18)
            status = np.where(done, "converged", np.where(top > far, "separated", np.where(ok | worse, "open", "singular")))
            new = np.where(worse[:, None], (b + before) / 2, np.where(ok[:, None], b + np.nan_to_num(step), b))
            kept, best = np.where(worse[:, None], before, b), np.where(worse, old, ll)
            se = np.where(done, np.sqrt(last), np.nan)
            lists = [pa.array(list(v), pa.list_(pa.float64())) for v in (new, kept)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists, pa.array(best), pa.array(status.tolist()), pa.array(se, from_pandas=True),
                                              pa.array(n.astype(np.int64))], names=[group, "b", "before", "ll", "status", "se", "n"])

    while True:
        j = rows.join(state.where("status = 'open'"), group)
        eta = sum((F.col("b")[i] * x[i] for i in range(1, p)), F.col("b")[0])
        j = j.withColumn("_eta", eta)
        e = F.col("_eta")
        fitted = 1 / (1 + F.exp(-e))
        w = fitted * (1 - fitted)
        likely = F.col("_y") * e - F.greatest(e, F.lit(0.0)) - F.log1p(F.exp(-F.abs(e)))
        sums = F.array(F.count("*").cast("double"), F.max(F.abs(e)), F.sum(likely), *[F.sum(v * (F.col("_y") - fitted)) for v in x],
                       *[F.sum(w * x[i] * x[k]) for i in range(p) for k in range(i, p)])
        # sums alone keep to a hash aggregate: a first() of a list would sort all rows in every step
        made = j.groupBy(group).agg(sums.alias("s")).join(state.select(group, "b", "before", "ll"), group).select(group, "b", "before", "ll", "s")
        state = cut_lineage(made.mapInArrow(run, schema).unionByName(state.where("status <> 'open'")))
        if state.where("status = 'open'").limit(1).count() == 0:
            break
    good = F.col("status") == "converged"
    out = state.select(group, "n", F.when(good, F.col("b")[p - 1]).alias("beta"), F.when(good, F.col("se")).alias("se"), "status",
                       F.when(good, F.col("b")).alias("coefficients"))
    out = out.withColumn("z_stat", F.col("beta") / F.col("se"))
    from stratum.operators.genotype import normal_two_sided_p_udf

    return out.withColumn("p_wald", F.when(F.col("z_stat").isNotNull(), normal_two_sided_p_udf("z_stat"))).select(
        group, "n", "beta", "se", "z_stat", "p_wald", "status", "coefficients")
