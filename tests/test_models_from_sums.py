"""Hash splits, elastic nets from shared sums and regression with intervals, against Spark ML and numpy."""

import hashlib

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from stratum.operators import grid as G
from stratum.operators import regression as RG
from stratum.operators import splits as S
from stratum.operators.ml import t_quantile


def test_split_by_key_is_the_hash(spark):
    rows = [(i, f"n{i % 7}", None if i % 50 == 0 else i) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, name string, v int")
    bucket = lambda i, n: int(hashlib.md5(f"42|{i}|{n}".encode()).hexdigest()[:8], 16) % S.BUCKETS
    a, b, c = S.split_by_key(df, ["id", "name"], [0.7, 0.2, 0.1])
    got = [sorted(r.id for r in part.collect()) for part in (a, b, c)]
    at = {i: bucket(i, n) for i, n, _ in rows}
    assert got == [[i for i in range(2000) if low <= at[i] < high] for low, high in ((0, 7000), (7000, 9000), (9000, 10_000))]
    moved = S.split_by_key(df.orderBy(F.rand(1)).repartition(5), ["id", "name"], [0.7, 0.2, 0.1])[1]
    assert sorted(r.id for r in moved.collect()) == got[1] and a.columns == df.columns
    folds = [r["count"] for r in S.with_fold(df, ["id"], 4).groupBy("fold").count().collect()]
    assert len(folds) == 4 and min(folds) > 400
    whole = S.with_fold(df, ["name"], 3).groupBy("name").agg(F.count_distinct("fold").alias("k")).collect()
    assert {r.k for r in whole} == {1}  # rows of one key stay together
    assert S.key_bucket_sql(["id"]).startswith("(CAST(") and S.split_by_key(df.limit(0), ["id"], [1, 1])[0].count() == 0


def table(spark, n=150):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(n, 2)) * [3.0, 0.5] + [4.0, -1.0]
    y = 1.5 + x @ [0.4, 2.0] + rnd.normal(size=n)
    return spark.createDataFrame([(i, "m", float(a), float(b), float(v)) for i, ((a, b), v) in enumerate(zip(x, y))],
                                 "id int, metric string, x1 double, x2 double, y double"), x, y


def test_elastic_nets_equal_spark_ml(spark):
    df, x, y = table(spark)
    d = VectorAssembler(inputCols=["x1", "x2"], outputCol="features").transform(df)
    one = np.column_stack([np.ones(len(y)), x, y])
    grid = [(0.1, True, 0.0), (0.1, False, 0.5), (0.5, True, 1.0), (0.01, True, 0.25), (3.0, True, 1.0), (0.3, False, 0.0)]
    for point, got in zip(grid, G.elastic_nets(one.T @ one, grid)):
        m = LinearRegression(labelCol="y", regParam=point[0], fitIntercept=point[1], elasticNetParam=point[2], maxIter=2000, tol=1e-13, solver="l-bfgs").fit(d)
        assert np.allclose(got, [m.intercept, *m.coefficients], atol=1e-5), (point, got, m.intercept, m.coefficients)


def test_grid_search(spark):
    df, x, y = table(spark)
    more = spark.createDataFrame([(1000 + i, "flat", 1.0, float(i), 5.0) for i in range(20)] + [(2000, "gap", None, 1.0, 2.0), (2001, "one", 1.0, 1.0, 2.0)],
                                 df.schema)
    got = {r.metric: r for r in G.grid_search(df.unionByName(more), "metric", ["x1", "x2"], "y", F.col("id") % 4 > 0).collect()}
    t = np.arange(len(y)) % 4 > 0
    one = np.column_stack([np.ones(len(y)), x, y])
    fits = G.elastic_nets(one[t].T @ one[t], G.GRID)
    rmse = np.sqrt([np.mean((y[~t] - f[0] - x[~t] @ f[1:]) ** 2) for f in fits]).round(9)
    best = int(np.argmin(rmse))
    r = got["m"]
    assert (r.reg_param, r.fit_intercept, r.elastic_net) == G.GRID[best] and abs(r.valid_rmse - rmse[best]) < 1e-9 and r.n == len(y)
    assert np.allclose(r.coefficients, G.elastic_nets(one.T @ one, [G.GRID[best]])[0], atol=1e-9)
    assert got["flat"].coefficients == [5.0, 0.0, 0.0] and "gap" not in got and got["one"].n == 1


def test_multi_ols_with_intervals(spark):
    df, x, y = table(spark)
    df = df.withColumn("year", F.lit(2000.0) + F.col("id") % 5)  # a large offset
    fit = RG.multi_ols(df.unionByName(df.limit(3).withColumn("x1", F.lit(None).cast("double"))), "y", ["x1", "x2", "year"])
    X = np.column_stack([np.ones(len(y)), x, 2000.0 + np.arange(len(y)) % 5])
    b, rss = np.linalg.lstsq(X, y, rcond=None)[:2]
    assert fit.n == len(y) and np.allclose(fit.coefficients, b, rtol=1e-6) and abs(fit.rss - rss[0]) < 1e-6
    rows = RG.with_prediction(df, fit).orderBy("id").collect()
    sd = np.sqrt(rss[0] / (len(y) - 4))
    se = sd * np.sqrt(1 + np.einsum("ij,jk,ik->i", X, np.linalg.inv(X.T @ X), X))
    assert np.allclose([r.yhat for r in rows], X @ b, atol=1e-6) and np.allclose([r.se_pred for r in rows], se, atol=1e-6)
    assert abs(t_quantile(0.95, 10) - 2.228138851965) < 1e-9
    assert np.allclose([r.upper - r.lower for r in rows], 2 * t_quantile(0.95, len(y) - 4) * se, atol=1e-6)
    for bad in (df.withColumn("x2", F.lit(1.0)), df.withColumn("x2", F.col("x1") * 2), df.limit(0)):
        with pytest.raises(ValueError):
            RG.multi_ols(bad, "y", ["x1", "x2"])
