"""Spark ML building blocks (M1–M27): assembling, indexing, scaling, k sweeps,
distance-to-centroid anomalies, tuned forests, cross-validation, evaluators,
leaderboards, regression with prediction intervals, run logging."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.scalar import squared_distance
from stratum.functions.stats import t_two_sided_p


def vectors(df: DataFrame, arr: str, out: str = "features") -> DataFrame:
    """array<float|double> → ML vector column."""
    return df.withColumn(out, array_to_vector(F.col(arr).cast("array<double>")))


def one_hot_stage(input_col: str) -> tuple[Pipeline, str]:
    """Category string → index → one-hot vector, as a reusable sub-pipeline."""
    idx, vec = f"{input_col}_idx", f"{input_col}_vec"
    return Pipeline(stages=[StringIndexer(inputCol=input_col, outputCol=idx, handleInvalid="keep"),
                            OneHotEncoder(inputCol=idx, outputCol=vec)]), vec


def scaled(df: DataFrame, features: str = "features", out: str = "scaled", with_mean: bool = False) -> DataFrame:
    """Divide by the standard deviation (no centring) — a fitted StandardScaler."""
    model = StandardScaler(inputCol=features, outputCol=out, withStd=True, withMean=with_mean).fit(df)
    return model.transform(df)


def _for_kmeans(df: DataFrame, *columns: str) -> DataFrame:
    """The columns as materialised rows. KMeans zips its input with norms of the same input, so each task runs the input's plan
    twice at once, and the sorts of a sort-merge join in it, which the two runs share, are freed by whichever run ends first."""
    from stratum.session import cut_lineage

    return cut_lineage(df.select(*columns))


def kmeans_sweep(df: DataFrame, ks: Sequence[int], features: str = "scaled", max_iter: int = 40, tol: float = 1e-5,
                 seed: int = 42) -> DataFrame:
    """Cost per row for each k (within-cluster sum of squares / n)."""
    from pyspark.ml.clustering import KMeans

    df = _for_kmeans(df, features)
    n = df.count()
    rows = []
    for k in ks:
        m = KMeans(k=k, maxIter=max_iter, tol=tol, seed=seed, featuresCol=features).fit(df)
        rows.append((int(k), float(m.summary.trainingCost) / n))
    return df.sparkSession.createDataFrame(rows, "k int, cost_per_row double")


def kmeans_entropy_sweep(df: DataFrame, ks: Sequence[int], label: str, features: str = "scaled", max_iter: int = 40,
                         tol: float = 1e-5, seed: int = 42) -> DataFrame:
    """Per k: cost per row, and the size-weighted mean entropy of the labels in the clusters (0: every cluster is pure)."""
    from pyspark.ml.clustering import KMeans

    from stratum.operators.aggregates import cluster_entropy

    df = _for_kmeans(df, features, label)
    rows = []
    for k in ks:
        m = KMeans(k=k, maxIter=max_iter, tol=tol, seed=seed, featuresCol=features).fit(df)
        entropy = cluster_entropy(m.transform(df), "prediction", label).first()[0]
        rows.append((int(k), float(m.summary.trainingCost) / sum(m.summary.clusterSizes), float(entropy)))
    return df.sparkSession.createDataFrame(rows, "k int, cost_per_row double, entropy double")


def distance_to_centroid(df: DataFrame, model, features: str = "scaled", pred: str = "prediction",
                         out: str = "sqdist") -> DataFrame:
    """Squared distance of each row to its assigned k-means centre (centres are a k×d literal)."""
    from stratum.operators.ml_geometry import centroid_literal

    centres = centroid_literal([list(map(float, c)) for c in model.clusterCenters()])
    v = vector_to_array(F.col(features))
    return df.withColumn(out, squared_distance(v, F.element_at(centres, F.col(pred) + 1)))


def feature_importances(model, names: Sequence[str]) -> DataFrame:
    """Tree-ensemble feature importances with names, largest first."""
    from pyspark.sql import SparkSession

    imp = model.featureImportances.toArray()
    spark = SparkSession.getActiveSession()
    rows = [(str(n), float(v)) for n, v in zip(names, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc())


def t_quantile(level: float, df: int) -> float:
    """The t beyond which Student's tails hold 1 - level, by bisection (a driver-side scalar)."""
    lo, hi = 0.0, 1.0
    while t_two_sided_p([hi], [df])[0] > 1 - level:
        hi *= 2
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if t_two_sided_p([mid], [df])[0] > 1 - level else (lo, mid)
    return (lo + hi) / 2


def ols_with_intervals(df: DataFrame, y: str, x: str, new_x: DataFrame, level: float = 0.95) -> DataFrame:
    """Simple OLS fit and, for each new x, prediction ± t·s·sqrt(1 + 1/n + (x−x̄)²/Sxx).

    Fit statistics are one aggregate row; the t quantile comes from a
    bisection on the Student-t tail (numpy, driver-side scalar).
    """
    s = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("mx"), F.regr_slope(y, x).alias("b"),
        F.regr_intercept(y, x).alias("a"), F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"),
        F.regr_sxy(y, x).alias("sxy")).first()
    n, mx, b, a, sxx, syy, sxy = s
    sse = syy - sxy * sxy / sxx
    sd = math.sqrt(sse / (n - 2))
    tq = t_quantile(level, n - 2)
    xv = F.col(x)
    yhat = F.lit(a) + F.lit(b) * xv
    se = F.lit(sd) * F.sqrt(1 + F.lit(1.0 / n) + (xv - F.lit(mx)) * (xv - F.lit(mx)) / F.lit(sxx))
    return new_x.select(x, yhat.alias("yhat"), se.alias("se_pred"), (yhat - F.lit(tq) * se).alias("lower"),
                        (yhat + F.lit(tq) * se).alias("upper"))


def log_runs(spark, path: str, runs: Sequence[tuple[str, str, float]]) -> DataFrame:
    """Append (run_id, name, value) metrics to a Parquet table and return the whole table."""
    df = spark.createDataFrame(list(runs), "run_id string, name string, value double")
    df.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def best_run(runs: DataFrame, metric: str, higher_is_better: bool = True) -> DataFrame:
    m = runs.where(F.col("name") == metric)
    return m.orderBy(F.col("value").desc() if higher_is_better else F.col("value").asc()).limit(1)



def permutation_map(base: DataFrame, seed: int = 42) -> DataFrame:
    """(_rid, _src): a seeded random permutation of the row ids of ``base``.

    Rows are ranked by id and by a seeded hash of the id (both
    range-partitioned, no single-task window); the i-th id takes the row with
    the i-th hash — an equi-join on the rank.
    """
    from stratum.operators.profile import rank_within

    ids = base.select("_rid", F.lit(0).alias("_g"))
    by_id = rank_within(ids, ["_g"], "_rid").select("_rid", F.col("rank").alias("_r"))
    hashed = ids.withColumn("_h", F.xxhash64("_rid", F.lit(seed)))
    by_hash = rank_within(hashed, ["_g"], "_h").select(F.col("_rid").alias("_src"), F.col("rank").alias("_r"))
    return by_id.join(by_hash, "_r").drop("_r")


def with_row_ids(df: DataFrame) -> DataFrame:
    """Stable row ids: assigned once and materialised (reliable checkpoint) so recomputation cannot renumber."""
    from stratum.session import cut_lineage

    return cut_lineage(df.withColumn("_rid", F.monotonically_increasing_id()))


def permute_column(df: DataFrame, col: str, seed: int = 42, base: DataFrame | None = None,
                   pmap: DataFrame | None = None) -> DataFrame:
    """``df`` with ``col`` permuted across rows (pass ``base``/``pmap`` to reuse one permutation)."""
    base = base if base is not None else with_row_ids(df)
    pmap = pmap if pmap is not None else permutation_map(base, seed)
    src = base.select(F.col("_rid").alias("_src"), F.col(col).alias("_perm"))
    out = base.drop(col).join(pmap, "_rid").join(src, "_src").withColumnRenamed("_perm", col)
    return out.drop("_src", "_rid")


def permutation_impact(model, df: DataFrame, features: Sequence[str], evaluator, seed: int = 42,
                       higher_is_better: bool = False) -> DataFrame:
    """Loss increase when each input column is permuted, and that increase normalised to the largest."""
    base = evaluator.evaluate(model.transform(df))
    ided = with_row_ids(df)
    pmap = permutation_map(ided, seed)
    rows = []
    for f in features:
        m = evaluator.evaluate(model.transform(permute_column(df, f, base=ided, pmap=pmap)))
        rows.append((f, float(base - m if higher_is_better else m - base)))
    top = max((abs(v) for _, v in rows), default=0.0) or 1.0
    spark = df.sparkSession
    return spark.createDataFrame([(f, v, v / top) for f, v in rows],
                                 "feature string, impact double, normalized_impact double").orderBy(
        F.col("impact").desc())


def seeded_split(df: DataFrame, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """``randomSplit`` on materialised rows: the input is checkpointed first, so a recomputed
    upstream (shuffle order, lost executor) cannot move rows between the splits."""
    from stratum.session import cut_lineage

    return cut_lineage(df).randomSplit(list(weights), seed=seed)


def seeded_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    from stratum.session import cut_lineage

    return cut_lineage(df).sample(False, fraction, seed)


def frozen_featurizer(df: DataFrame, input_col: str, output_col: str, make_predict_fn, in_dim: int,
                      batch_size: int = 256) -> DataFrame:
    """Apply a user-supplied frozen model to an array column in Arrow batches (``predict_batch_udf``).

    ``make_predict_fn`` is called once per Python worker and returns a function
    ``np.ndarray (batch × in_dim) → np.ndarray (batch × out)``; the output becomes an ML vector.
    """
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql import types as T

    udf = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size,
                            input_tensor_shapes=[[in_dim]])
    out = df.withColumn("_feat", udf(F.col(input_col).cast("array<float>")))
    return out.withColumn(output_col, array_to_vector(F.col("_feat").cast("array<double>"))).drop("_feat")
