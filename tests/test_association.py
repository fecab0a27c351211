"""Regressions per group on several covariates and converged components, against numpy and Spark ML."""

import math

import numpy as np
from pyspark.sql import functions as F

from stratum.operators import association as A
from stratum.operators import genotype as GT
from stratum.operators.pca import eigen_residuals, lanczos_pca


def cohort(spark, n=90, variants=4, seed=3):
    rnd = np.random.default_rng(seed)
    people = np.column_stack([rnd.normal(size=(n, 3)), rnd.random(n) < 0.5])
    y = 2 + people @ [0.5, -1.0, 0.0, 0.7] + rnd.normal(size=n)
    case = (rnd.random(n) < 1 / (1 + np.exp(-people[:, 0]))).astype(float)
    gt = rnd.integers(0, 3, (variants, n))
    samples = spark.createDataFrame([(i, float(y[i]), float(case[i]), *map(float, people[i])) for i in range(n)],
                                    "sample_id long, y double, case double, a double, b double, c double, sex double")
    rows = [(v, i, int(gt[v, i])) for v in range(variants) for i in range(n)] + [(0, 10_000, 1), (1, 3, None)]
    return spark.createDataFrame(rows, "variant_id int, sample_id long, gt int"), samples, gt, people, y, case


def test_linear_fits_equal_least_squares_and_spark_ml(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    g, samples, gt, people, y, _ = cohort(spark)
    by = ["a", "b", "c", "sex"]
    flat = spark.createDataFrame([(9, i, 1) for i in range(90)] + [(8, i, i % 3) for i in range(5)], g.schema)  # constant; too few rows
    got = {r.variant_id: r for r in A.linear_fits(g.unionByName(flat), samples, "y", by).collect()}
    for v in range(4):
        X = np.column_stack([np.ones(90), people, gt[v]])
        b, rss = np.linalg.lstsq(X, y, rcond=None)[:2]
        se = math.sqrt(rss[0] / (90 - 6) * np.linalg.inv(X.T @ X)[5, 5])
        assert got[v].n == 90 and np.allclose(got[v].coefficients, b, atol=1e-9) and abs(got[v].se - se) < 1e-9
    assert got[9].beta is None and got[9].n == 90 and got[8].se is None and got[8].beta is None
    one = g.where("variant_id = 2").join(samples, "sample_id")
    m = LinearRegression(labelCol="y", solver="normal").fit(VectorAssembler(inputCols=[*by, "gt"], outputCol="features").transform(one))
    assert abs(m.coefficients[4] - got[2].beta) < 1e-9 and abs(m.summary.coefficientStandardErrors[4] - got[2].se) < 1e-9
    fits = A.linear_fits(g, samples, "y", by)
    assert A.normal_equations(g, samples, fits, "y", by).where("worst > 1e-9").count() == 0
    p = {r.variant_id: r.p_value for r in GT.with_t_pvalue(fits.drop("coefficients"), k=6).collect()}
    assert abs(p[2] - m.summary.pValues[4]) < 1e-9
    assert A.linear_fits(g.limit(0), samples, "y", by).count() == 0


def test_logistic_fits(spark):
    g, samples, gt, people, _, case = cohort(spark, seed=5)
    n = len(case)
    split = [(20, i, 2 if case[i] else 0) for i in range(n)]  # gt tells the outcome
    half = [(21, i, int(gt[0, i]) if case[i] else 0) for i in range(n)]  # only one side is told
    flat = [(22, i, 1) for i in range(n)]
    more = spark.createDataFrame(split + half + flat, g.schema)
    got = {r.variant_id: r for r in A.logistic_fits(g.unionByName(more), samples, "case", ["a", "sex"]).collect()}
    assert [got[v].status for v in (20, 21, 22)] == ["separated", "separated", "singular"]
    assert all(got[v][c] is None for v in (20, 21, 22) for c in ("beta", "se", "z_stat", "p_wald", "coefficients"))
    for v in range(4):
        X, b = np.column_stack([np.ones(n), people[:, 0], people[:, 3], gt[v]]), np.zeros(4)
        for _ in range(60):
            p = 1 / (1 + np.exp(-X @ b))
            H = X.T @ (X * (p * (1 - p))[:, None])
            b = b + np.linalg.solve(H, X.T @ (case - p))
        se = math.sqrt(np.linalg.inv(H)[3, 3])
        r = got[v]
        assert r.status == "converged" and np.allclose(r.coefficients, b, atol=1e-9) and abs(r.se - se) < 1e-9
        assert abs(r.p_wald - math.erfc(abs(b[3] / se) / math.sqrt(2))) < 1e-9


def test_lanczos_components_are_exact(spark):
    rnd = np.random.default_rng(7)
    a = rnd.normal(size=(120, 80))  # no gap in the spectrum
    df = spark.createDataFrame([(i, j, float(a[i, j])) for i in range(120) for j in range(80)], "r int, c int, v double")
    u, s, _ = np.linalg.svd(a, full_matrices=False)
    for most in (400, 45):  # once with restarts
        scores, lam = lanczos_pca(df, "r", "c", "v", k=4, most=most, block=8)
        assert np.allclose(lam, s[:4] ** 2, rtol=1e-10)
        got = np.zeros((120, 4))
        for r in scores.collect():
            got[r.r, r.pc] = r.score
        for c in range(4):
            want = u[:, c] * s[c]
            assert np.allclose(got[:, c], want * np.sign(want[np.abs(want).argmax()]), atol=1e-6)
    assert eigen_residuals(df, scores, "r", "c", "v").where("residual > 1e-7").count() == 0
    low = df.where("r < 3")  # rank 3
    scores, lam = lanczos_pca(low, "r", "c", "v", k=4)
    assert len(lam) == 3 and np.allclose(lam, np.linalg.svd(a[:3])[1] ** 2) and scores.count() == 9
    empty, lam = lanczos_pca(df.limit(0), "r", "c", "v", k=2)
    assert lam == [] and empty.count() == 0


def test_rare_variants(spark):
    rows = [(1, "1", 5, i, 1 if i == 0 else 0, 30) for i in range(20)] + [(2, "1", 6, i, i % 3, 30) for i in range(20)]
    rows += [(3, "1", 7, i, 0, 30) for i in range(20)] + [(4, "1", 8, i, 2 if i else 1, 30) for i in range(20)]
    df = spark.createDataFrame(rows, "variant_id int, contig string, pos long, sample_id int, gt int, gq int")
    assert {r.variant_id for r in GT.rare_variants(df, 0.05).select("variant_id").distinct().collect()} == {1, 4}


def test_lanczos_keeps_its_basis_on_the_smaller_side(spark, monkeypatch):
    from stratum.operators import pca

    rnd = np.random.default_rng(3)
    a = rnd.normal(size=(90, 12))
    df = spark.createDataFrame([(i, j, float(a[i, j])) for i in range(90) for j in range(12)] + [(None, 0, 1.0)], "r int, c int, v double")
    sizes, plain = [], pca._map_lists
    monkeypatch.setattr(pca, "_map_lists", lambda d, *args, **more: sizes.append(d.count()) or plain(d, *args, **more))
    u, s, _ = np.linalg.svd(a, full_matrices=False)
    for limit in (pca.FEW_NUMBERS, 0):  # lists broadcast, and joined
        monkeypatch.setattr(pca, "FEW_NUMBERS", limit)
        scores, lam = pca.lanczos_pca(df, "r", "c", "v", k=3)
        assert sizes and max(sizes) == 12 and np.allclose(lam, s[:3] ** 2, rtol=1e-10)
        found = {(r.r, r.pc): r.score for r in scores.collect()}
        assert len(found) == 3 * 91 and all(abs(found[None, c]) < 1e-9 for c in range(3))
        for c in range(3):
            want = u[:, c] * s[c]
            assert np.allclose([found[i, c] for i in range(90)], want * np.sign(want[np.abs(want).argmax()]), atol=1e-6)


def test_fits_without_coefficients_are_not_optimal(spark, monkeypatch):
    """A failed fit must not look like a verified one: constant genotypes (singular), genotypes that tell the outcome (separated), no fitted row."""
    from stratum.plans import q_genotype as Q

    rnd = np.random.default_rng(4)
    n = 80
    case = rnd.random(n) < 0.5
    gt = {v: rnd.integers(0, 3, n) for v in range(1, 6)} | {6: np.ones(n), 7: np.where(case, 2, 0)}
    rows = [(v, "1", v * 1000, i, int(x), 50) for v, col in gt.items() for i, x in enumerate(col)]
    rows += [(8, "1", 8000, n + i, i % 3, 50) for i in range(6)]  # only samples without an outcome
    people = [(i, float(i % 2), bool(case[i]), *map(float, rnd.normal(size=4))) for i in range(n)] + [(n + i, 1.0, None, None, 0.0, 0.0, 0.0) for i in range(6)]
    g = spark.createDataFrame(rows, "variant_id int, contig string, pos int, sample_id int, gt int, gq int")
    s = spark.createDataFrame(people, "sample_id int, is_female double, purple_hair boolean, caffeine double, pc1 double, pc2 double, pc3 double")
    monkeypatch.setattr(Q, "_g", lambda spark, sf: g)
    monkeypatch.setattr(Q, "_with_pcs", lambda spark, sf, g=None: s)
    got = {(r.model, r.variant_id): (r.n, r.optimal) for r in Q.assoc_pcs_optimality(spark, None).collect()}
    assert set(got) == {(m, v) for m in ("linear", "logistic") for v in range(1, 9)}
    assert all(got[m, v] == (n, True) for m in ("linear", "logistic") for v in range(1, 6)) and got["linear", 7] == (n, True)
    assert got["linear", 6] == got["logistic", 6] == got["logistic", 7] == (n, False)
    assert got["linear", 8] == got["logistic", 8] == (0, False)
