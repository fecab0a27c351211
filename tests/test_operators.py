import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.operators import aggregates as A
from stratum.operators import clean as C
from stratum.operators import genotype as GT
from stratum.operators import joins as J
from stratum.operators import profile as P
from stratum.operators import seasons as SN
from stratum.operators import windows as W
from stratum.operators.savings import predicted_cost


def test_preferred_row(spark):
    df = spark.createDataFrame([(1976, "A", "DET", 1.0), (1976, "A", "TOT", 2.0), (1976, "A", "LAL", 3.0),
                                (1976, "B", "DET", 4.0)], "year int, name string, team string, v double")
    got = sorted((r["name"], r["team"], r["v"]) for r in SN.dedup_seasons(df).collect())
    assert got == [("A", "TOT", 2.0), ("B", "DET", 4.0)]


def test_cluster_entropy(spark):
    df = spark.createDataFrame([(0, "a"), (0, "a"), (0, "b"), (0, "b"), (1, "c"), (1, "c")], "c int, l string")
    got = A.cluster_entropy(df, "c", "l").first()[0]
    assert abs(got - 4 * math.log(2) / 6) < 1e-12


def test_maxabs(spark):
    df = spark.createDataFrame([(1, -4.0), (1, 1.0), (1, 2.0)], "g int, z double")
    got = sorted(r["n"] for r in W.maxabs_within(df, ["g"], ["z"], prefix="n", strip="z").collect())
    assert got == [-1.0, 0.25, 0.5]


def test_prior_year_not_lag(spark):
    df = spark.createDataFrame([("a", 2001, 1.0), ("a", 2002, 2.0), ("a", 2004, 4.0)], "name string, year int, x double")
    got = J.prior_period_pairs(df, "name", "year", ["x"]).collect()
    assert [(r["year"], r["x0"], r["x"]) for r in got] == [(2002, 1.0, 2.0)]


def test_keep_true_or_missing(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert sorted(C.keep_true_or_missing(df, F.col("b")).collect(), key=str) == sorted([(True,), (None,)], key=str)


def test_balance_filter(spark):
    df = spark.createDataFrame([(0, 9, 1), (1, 9, 1), (2, 1, 9)], "gt int, ad_ref int, ad_alt int")
    assert [r["gt"] for r in GT.balance_filter(df).collect()] == [0, None, 2]


def test_cost_rule(spark):
    df = spark.createDataFrame([("Corrective", "Corrective", 50), ("Preventive", "Preventive", 50),
                                ("Healthy", "Healthy", 50), ("Healthy", "Corrective", 50)], "a string, p string, c int")
    assert [r[0] for r in df.select(predicted_cost("a", "p", "c")).collect()] == [30000, 50, 0, 50]


def test_stat_counter_nan_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (1, float("nan")), (1, 3.0), (1, None)], "g int, v double")
    r = A.stat_counter(df, ["g"], ["v"]).first()
    assert r["count"] == 2 and r["missing"] == 2 and r["mean"] == 2.0 and r["stdev"] == 1.0


def test_similarity_radius_is_exact(spark):
    rnd = random.Random(7)
    rows = []
    for e in range(3):
        for i in range(60):
            rows.append((f"n{i}", e, 2000 + e, [rnd.gauss(0, 0.5) for _ in range(6 * (e + 1))]))
    df = spark.createDataFrame(rows, "name string, experience int, year int, vec array<double>")
    r = 0.45
    got = {(x["experience"], x["name"], x["similar_name"]) for x in SN.similar_within_radius(df, r).collect()}
    want = set()
    for (a, ea, _, va), (b, eb, _, vb) in itertools.product(rows, rows):
        if ea == eb and a != b:
            d = math.sqrt(sum((p - q) ** 2 for p, q in zip(va, vb))) / math.sqrt(len(va))
            if d <= r:
                want.add((ea, a, b))
    assert got == want and len(want) > 0


def test_similarity_example(spark):
    df = spark.createDataFrame([("a", 0, 2000, [1.0, 2.0, 3.0]), ("b", 0, 2000, [1.0, 2.0, 6.0])],
                               "name string, experience int, year int, vec array<double>")
    got = SN.similar_within_radius(df, 2.0).collect()
    assert len(got) == 2 and all(abs(x["similarity_score"] - math.sqrt(3)) < 1e-12 for x in got)


def test_kendall_matches_brute_force(spark):
    rnd = random.Random(3)
    pts = [(rnd.randint(0, 8), rnd.randint(0, 5)) for _ in range(80)]
    df = spark.createDataFrame(pts, "x int, y int")
    got = P.kendall_tau_b(df, "x", "y").first()[0]
    s = n1 = n2 = 0
    for (a, b), (c, d) in itertools.combinations(pts, 2):
        s += np.sign(a - c) * np.sign(b - d)
        n1 += a == c
        n2 += b == d
    n0 = len(pts) * (len(pts) - 1) // 2
    assert abs(got - s / math.sqrt((n0 - n1) * (n0 - n2))) < 1e-12


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(5)
    rows = [(g, rnd.random() * 100) for g in ("a", "b") for _ in range(101 if g == "a" else 37)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["p"]): r["q"] for r in P.exact_quantiles(df, ["g"], "v", [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    for g in ("a", "b"):
        vals = np.array([v for k, v in rows if k == g])
        for p in (0.0, 0.25, 0.5, 0.9, 1.0):
            assert abs(got[(g, p)] - np.percentile(vals, p * 100)) < 1e-9


def test_histogram_counts_all_rows(spark):
    df = spark.range(1000).select((F.col("id") * 0.37).alias("x"))
    h = P.histogram(df, "x", 7).collect()
    assert sum(r["n"] for r in h) == 1000 and len(h) == 7


def test_kde_integrates_to_one(spark):
    rnd = random.Random(1)
    df = spark.createDataFrame([(rnd.gauss(0, 1),) for _ in range(500)], "x double")
    k = P.kde_grid(df, "x", n=256).orderBy("i").collect()
    dx = k[1]["x"] - k[0]["x"]
    assert abs(sum(r["density"] for r in k) * dx - 1.0) < 0.01


def test_interval_join_brute_force(spark):
    rnd = random.Random(9)
    pts = [(i, rnd.choice("12X"), rnd.randint(0, 50_000)) for i in range(300)]
    ivs = [(rnd.choice("12X"), s, s + rnd.randint(0, 3000)) for s in (rnd.randint(0, 50_000) for _ in range(40))]
    p = spark.createDataFrame(pts, "id int, contig string, pos int")
    iv = spark.createDataFrame(ivs, "contig string, start int, end int")
    got = {r["id"] for r in J.interval_semi_join(p, iv, bin_size=1000).collect()}
    want = {i for i, c, x in pts if any(c == c2 and s <= x <= e for c2, s, e in ivs)}
    assert got == want


def test_head_rest_split(spark):
    df = spark.range(20).withColumnRenamed("id", "k")
    h, r = C.head_rest_split(df, ["k"], 5)
    assert sorted(x[0] for x in h.collect()) == list(range(5)) and r.count() == 15


def test_qq_table(spark):
    df = spark.createDataFrame([(0.5,), (0.01,), (float("nan"),), (0.1,), (None,)], "p double")
    q = P.qq_table(df, "p").orderBy("i").collect()
    assert [r["p"] for r in q] == [0.01, 0.1, 0.5]
    assert abs(q[0]["expected"] - (-math.log10(1 / 3))) < 1e-12


def test_grouped_ols_recovers_polynomial(spark):
    from stratum.operators.regression import grouped_ols2

    df = spark.createDataFrame([("m", float(x), float(x * x), float(4 + 6 * x + 2 * x * x)) for x in range(-5, 6)],
                               "metric string, x1 double, x2 double, y double")
    c = grouped_ols2(df, "metric", "y", "x1", "x2").first()
    assert abs(c["b0"] - 4) < 1e-9 and abs(c["b1"] - 6) < 1e-9 and abs(c["b2"] - 2) < 1e-9


def test_logistic_wald_matches_numpy_newton(spark):
    rnd = np.random.default_rng(4)
    n_s = 120
    samples = [(s, bool(rnd.random() < 0.5), bool(rnd.random() < 0.4)) for s in range(n_s)]
    rows = []
    for v in range(3):
        for s in range(n_s):
            rows.append((v, s, int(rnd.integers(0, 3))))
    g = spark.createDataFrame(rows, "variant_id int, sample_id long, gt int")
    sm = spark.createDataFrame(samples, "sample_id long, case boolean, female boolean")
    got = {r["variant_id"]: r for r in GT.logistic_wald(g, sm, "case", "female").collect()}
    yv = np.array([float(c) for _, c, _ in samples])
    fv = np.array([float(f) for _, _, f in samples])
    for v in range(3):
        gt = np.array([float(x) for vv, _, x in rows if vv == v])
        X = np.column_stack([np.ones(n_s), gt, fv])
        b = np.zeros(3)
        for _ in range(50):
            p = 1 / (1 + np.exp(-X @ b))
            H = X.T @ (X * (p * (1 - p))[:, None])
            b = b + np.linalg.solve(H, X.T @ (yv - p))
        p = 1 / (1 + np.exp(-X @ b))
        H = X.T @ (X * (p * (1 - p))[:, None])
        se = math.sqrt(np.linalg.inv(H)[1, 1])
        assert abs(got[v]["beta"] - b[1]) < 1e-7 and abs(got[v]["se"] - se) < 1e-7
        assert abs(got[v]["p_wald"] - math.erfc(abs(b[1] / se) / math.sqrt(2))) < 1e-7


def test_unconverged_fits_are_marked(spark):
    from stratum.operators.pca import subspace_pca

    rnd = np.random.default_rng(8)
    people = [(s, s % 2 == 0, bool(rnd.random() < 0.5)) for s in range(80)]
    rows = [(0, s, int(rnd.integers(0, 3))) for s in range(80)] + [(1, s, 2 if s % 2 == 0 else 0) for s in range(80)]
    rows += [(2, s, 1) for s in range(80)]  # 1: separated, 2: constant, singular
    g = spark.createDataFrame(rows, "variant_id int, sample_id long, gt int")
    sm = spark.createDataFrame(people, "sample_id long, case boolean, female boolean")
    got = {r.variant_id: r for r in GT.logistic_wald(g, sm, "case", "female").collect()}
    assert [got[v].converged for v in range(3)] == [True, False, False] and got[0].beta is not None
    assert all(got[v][c] is None for v in (1, 2) for c in ("beta", "se", "z_stat", "p_wald")) and got[1].n == 80
    a = rnd.normal(size=(30, 20))
    a[0] += 40
    df = spark.createDataFrame([(i, j, float(a[i, j])) for i in range(30) for j in range(20)], "r int, c int, v double")
    for iters, want in ((1, {False}), (6, {True, False})):
        scores, _ = subspace_pca(df, "r", "c", "v", k=3, oversample=3, iters=iters)
        assert {r.converged for r in scores.collect()} == want


def test_subspace_pca_matches_svd(spark):
    from stratum.operators.pca import subspace_pca

    rnd = np.random.default_rng(2)
    n, d = 40, 30
    base = rnd.normal(size=(n, 3)) * np.array([6.0, 3.0, 1.5])
    X = base @ rnd.normal(size=(3, d)) + 0.05 * rnd.normal(size=(n, d))
    rows = [(i, j, float(X[i, j])) for i in range(n) for j in range(d)]
    df = spark.createDataFrame(rows, "r int, c int, v double")
    scores, lam = subspace_pca(df, "r", "c", "v", k=3, oversample=3, iters=25)
    U, s, _ = np.linalg.svd(X, full_matrices=False)
    assert np.allclose(lam[:3], (s[:3] ** 2), rtol=1e-6)
    got = np.zeros((n, 3))
    for r in scores.collect():
        got[r["r"], r["pc"]] = r["score"]
    want = U[:, :3] * s[:3]
    for c in range(3):
        w = want[:, c] * np.sign(want[np.argmax(np.abs(want[:, c])), c])
        assert np.allclose(got[:, c], w, atol=1e-5)


def test_kendall_distributed_path_matches_brute_force(spark):
    rnd = random.Random(11)
    # a hot x value (a third of the rows) and a hot y value, plus continuous-ish values
    pts = [(5, rnd.randint(0, 40)) for _ in range(70)] + [(rnd.randint(0, 60), 7) for _ in range(40)] + \
          [(rnd.randint(0, 60), rnd.randint(0, 40)) for _ in range(100)]
    df = spark.createDataFrame(pts, "x int, y int")
    got = P.kendall_tau_b(df, "x", "y", digit_bits=1).first()[0]
    local = P.kendall_tau_b(df, "x", "y").first()[0]
    s = n1 = n2 = 0
    for (a, b), (c, d) in itertools.combinations(pts, 2):
        s += np.sign(a - c) * np.sign(b - d)
        n1 += a == c
        n2 += b == d
    n0 = len(pts) * (len(pts) - 1) // 2
    want = s / math.sqrt((n0 - n1) * (n0 - n2))
    assert abs(got - want) < 1e-12 and abs(local - want) < 1e-12


def test_permute_column_is_a_permutation(spark):
    from stratum.operators.ml import permute_column

    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    p = permute_column(df, "v", seed=3)
    got = p.collect()
    assert len(got) == 500
    assert sorted(r["v"] for r in got) == [i * 3 for i in range(500)]
    assert sum(1 for r in got if r["v"] == r["k"] * 3) < 50  # actually shuffled


def test_group_stats_broadcast_equals_shuffle(spark):
    rnd = random.Random(8)
    rows = [("hot" if i % 3 == 0 else f"g{i % 17}", rnd.random()) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, v double")
    aggs = [F.avg("v").alias("m"), F.stddev_pop("v").alias("s")]
    small = sorted(W.with_group_stats(df, ["g"], aggs).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    big = sorted(W.with_group_stats(df, ["g"], aggs).collect())
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert small == big


def test_delta_previous_keeps_rows_without_order(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 3, 4.0), ("a", None, 9.0)], "n string, y int, v double")
    got = {r["v"]: r["delta_v"] for r in W.delta_previous(df, "n", "y", ["v"]).collect()}
    assert got == {1.0: None, 4.0: 3.0, 9.0: None}


def test_rank_within_hot_group_with_ties(spark):
    rnd = random.Random(12)
    rows = [("hot", rnd.randint(0, 50)) for _ in range(400)] + [(f"g{i % 5}", rnd.randint(0, 50)) for i in range(800)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = P.rank_within(df, ["g"], "v", partitions=16).collect()
    for g in {r[0] for r in rows}:
        ranks = sorted((r["v"], r["rank"]) for r in got if r["g"] == g)
        vals = sorted(v for k, v in rows if k == g)
        assert [r for _, r in ranks] == list(range(len(vals)))  # dense 0..n-1
        assert [v for v, _ in ranks] == vals  # rank order follows value order


def test_value_ranks_of_a_value_in_most_rows(spark):
    rnd = random.Random(13)
    rows = [("a", 7.0)] * 3600 + [("a", float(rnd.randint(0, 60))) for _ in range(400)] + [("b", None), ("b", 2.0), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    ranked = P.value_ranks(df, ["g"], "v", partitions=8)
    got = sorted(tuple(r) for r in ranked.collect())
    values = sorted(v for g, v in rows if g == "a")
    assert got == sorted([("a", v, values.count(v), values.index(v)) for v in set(values)] + [("b", 2.0, 1, 0)])
    pieces = P.expand_ranks(ranked.where("g = 'a'"), piece=100)
    per_task = [r[0] for r in pieces.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sorted((r["rank"], r["v"]) for r in pieces.collect()) == list(enumerate(values)) and max(per_task) < 0.6 * len(values)
    q = {(r["g"], r["p"]): r["q"] for r in P.exact_quantiles(df, ["g"], "v", [0.0, 0.03, 0.5, 0.991, 1.0]).collect()}
    for p in (0.0, 0.03, 0.5, 0.991, 1.0):
        assert abs(q["a", p] - np.quantile(values, p)) < 1e-12 and q["b", p] == 2.0 and ("c", p) not in q


def test_similarity_salted_cells_match_unsalted(spark):
    rnd = random.Random(21)
    rows = [(f"n{i}", e, 2000 + e, [rnd.gauss(0, 0.5) for _ in range(6 * (e + 1))]) for e in range(2) for i in range(50)]
    df = spark.createDataFrame(rows, "name string, experience int, year int, vec array<double>")
    a = sorted(tuple(r) for r in SN.similar_within_radius(df, 0.45).collect())
    b = sorted(tuple(r) for r in SN.similar_within_radius(df, 0.45, hot_cell_rows=2).collect())
    assert a == b and len(a) > 0


def test_similarity_of_any_vector_length_and_cell_borders(spark):
    rnd = random.Random(5)
    # lengths below, at and between multiples of the classes; a grid of step r puts rows on the cell borders
    rows = [(f"n{i}", e, 2000 + i, [rnd.choice([-0.5, 0.0, 0.5, 1.0]) for _ in range(length)])
            for e, length in enumerate([1, 4, 6, 7, 9]) for i in range(40)]
    extra = [("x", 2, 2000, [None] + [0.0] * 5), ("y", None, 2000, [0.0] * 6), (None, 2, 2000, [0.0] * 6), ("z", 0, 2000, []), ("w", 0, 2000, None)]
    df = spark.createDataFrame(rows + extra, "name string, experience int, year int, vec array<double>")
    for r in (0.25, 0.5):
        want = {(e, ya, a, b) for a, e, ya, va in rows for b, eb, _, vb in rows
                if e == eb and a != b and math.sqrt(sum((p - q) ** 2 for p, q in zip(va, vb))) / math.sqrt(len(va)) <= r}
        got = [tuple(x)[:4] for x in SN.similar_within_radius(df, r).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want


def test_two_pass_scores_match_plain_python(spark):
    rnd = random.Random(11)
    cols = ["fgp", "fga", "ftp", "fta", "tp", "trb", "pts", "tov"]
    rows = [(f"n{i}", y, *[rnd.uniform(0, 9) for _ in cols[:-1]], 2.0 if y == 2001 else rnd.uniform(0, 9))
            for y in (2000, 2001, None) for i in range(25)]  # a year without a spread of tov, and rows without a year
    df = spark.createDataFrame(rows, "name string, year int, " + ", ".join(f"{c} double" for c in cols))
    got = {(r["name"], r["year"]): r for r in SN.score_seasons(df).collect()}
    assert len(got) == len(rows)
    for year in (2000, 2001, None):
        v = {c: np.array([r[2 + k] for r in rows if r[1] == year]) for k, c in enumerate(cols)}
        v["fg"], v["ft"] = (v["fgp"] - v["fgp"].mean()) * v["fga"], (v["ftp"] - v["ftp"].mean()) * v["fta"]
        z = {c: (v[c] - v[c].mean()) / v[c].std() for c in ("tp", "trb", "pts", "fg", "ft")}
        z["tov"] = -(v["tov"] - v["tov"].mean()) / v["tov"].std() if year != 2001 else None
        for i in range(25):
            r = got[f"n{i}", year]
            for c, x in z.items():
                if x is None:
                    assert r["ztov"] is None and r["ntov"] is None and r["ztot"] is None and r["ntot"] is None
                else:
                    assert abs(r[f"z{c}"] - x[i]) < 1e-9 and abs(r[f"n{c}"] - x[i] / np.abs(x).max()) < 1e-9
    assert SN.score_seasons(df.limit(0)).count() == 0


def test_per_variant_regression_equals_spark_ml(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rnd = np.random.default_rng(6)
    samples = [(s, bool(rnd.random() < 0.5), float(rnd.normal(5, 2))) for s in range(80)]
    rows = [(v, s, int(rnd.integers(0, 3))) for v in range(2) for s in range(80)]
    g = spark.createDataFrame(rows, "variant_id int, sample_id long, gt int")
    sm = spark.createDataFrame(samples, "sample_id long, female boolean, y double")
    got = {r["variant_id"]: r for r in GT.linear_assoc(g, sm, "y", "female").collect()}
    for v in range(2):
        one = g.where(F.col("variant_id") == v).join(sm, "sample_id").select(
            F.col("y"), F.col("gt").cast("double").alias("gt"), F.col("female").cast("double").alias("f"))
        d = VectorAssembler(inputCols=["gt", "f"], outputCol="features").transform(one)
        m = LinearRegression(labelCol="y", solver="normal").fit(d)
        assert abs(m.coefficients[0] - got[v]["beta"]) < 1e-9
        assert abs(m.summary.coefficientStandardErrors[0] - got[v]["se"]) < 1e-9


def test_similarity_hot_cell_salting_is_exact(spark):
    rnd = random.Random(33)
    # a dense cluster (one hot cell) plus spread-out vectors
    rows = [(f"h{i}", 0, 2000, [0.01 * rnd.random() for _ in range(6)]) for i in range(60)]
    rows += [(f"n{i}", 0, 2000, [rnd.gauss(0, 1) for _ in range(6)]) for i in range(40)]
    df = spark.createDataFrame(rows, "name string, experience int, year int, vec array<double>")
    r = 0.3
    got = sorted(tuple(x) for x in SN.similar_within_radius(df, r, hot_cell_rows=7).collect())
    want = []
    for a, ea, ya, va in rows:
        for b, eb, _, vb in rows:
            if ea == eb and a != b:
                d = math.sqrt(sum((p - q) ** 2 for p, q in zip(va, vb))) / math.sqrt(len(va))
                if d <= r:
                    want.append((ea, ya, a, b))
    assert [g[:4] for g in got] == sorted(want) and len(want) >= 60 * 59


def test_density_of_constant_single_and_no_values(spark):
    for values in ([4.0] * 50, [4.0], [0.0, 0.0]):
        rows = P.kde_grid(spark.createDataFrame([(v,) for v in values], "v double"), "v", n=64).orderBy("i").collect()
        step = rows[1]["x"] - rows[0]["x"]
        assert len(rows) == 64 and abs(sum(r["density"] for r in rows) * step - 1) < 0.02
    for values in ([], [(None,)]):
        assert P.kde_grid(spark.createDataFrame(values, "v double"), "v").count() == 0


def test_kendall_few_cells(spark):
    rnd = random.Random(8)
    many = spark.createDataFrame([(rnd.randint(0, 40), rnd.randint(0, 30)) for _ in range(400)], "x int, y int")
    assert P.kendall_tau_b(many, "x", "y").first() == P.kendall_tau_b(many, "x", "y", wide=True).first()
    assert P.kendall_tau_b(spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "x int, y int"), "x", "y").first()[0] == 1.0
    assert P.kendall_tau_b(spark.createDataFrame([(1, 1)] * 9, "x int, y int"), "x", "y").first()[0] is None
    assert P.kendall_tau_b(spark.createDataFrame([], "x int, y int"), "x", "y").first()["n"] == 0


def test_similarity_stores_no_pairs(spark):
    """Two lookups of dense cells and the join of the two sides: what pairs that join makes are not joined, so not shuffled, again."""
    df = spark.createDataFrame([(f"p{i}", 0, 2000, [0.01 * i] * 6) for i in range(30)], "name string, experience int, year int, vec array<double>")
    out = SN.similar_within_radius(df, 0.035)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 3
    assert out.count() == 2 * (29 + 28 + 27)


@pytest.mark.parametrize("most", [7, 100, 10_000])
def test_similarity_blocks_equal_brute_force(monkeypatch, most):
    """Rows into blocks, blocks into pairs: entities that come twice, equal numbers, vectors far from the origin, values beyond single precision."""
    import pyarrow as pa

    from stratum.operators import radius as RD

    monkeypatch.setattr(RD, "LEAF", 8)
    monkeypatch.setattr(RD, "TALL", 16)
    monkeypatch.setattr(RD, "FLUSH", 50)
    rnd = np.random.default_rng(2)
    rows, r = [], 0.4
    for level, (size, scale, shift) in enumerate([(6, 0.4, 0.0), (30, 0.35, 1e5), (1, 0.5, 0.0), (20, 0.3, 0.0), (4, 1e30, 0.0)]):
        vecs = scale * rnd.normal(size=(90, size)) + shift
        vecs[80:] = vecs[:10]  # copies
        rows += [(level, f"n{i % 85}", 2000 + i, i % 85 % 40, v.tolist()) for i, v in enumerate(vecs)]
    kind = pa.schema([("l", pa.int32()), ("name", pa.string()), ("year", pa.int32()), ("number", pa.int64()), ("vec", pa.list_(pa.float64()))])
    told = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)
    blocks = list(RD.packer(6, most)(told.to_batches(33)))
    assert sum(-(-90 // most) for _ in range(5)) == len(blocks)
    pairs = []
    for i, a in enumerate(blocks):
        for b in blocks[i:]:
            if a.column(0)[0] == b.column(0)[0]:
                apart = math.sqrt(sum(max(p - q, s - t, 0) ** 2 for p, q, s, t in zip(
                    a.column(2)[0].as_py(), b.column(3)[0].as_py(), b.column(2)[0].as_py(), a.column(3)[0].as_py())))
                got = list(RD.comparer(r, 6, ["l", "year", "name", "other", "score"])([pa.RecordBatch.from_arrays(
                    [a.column(0), a.column(1), pa.array([a is b]), a.column(4), b.column(4)], names=list("abcde"))]))
                assert apart <= r or not got  # bounds never part a pair
                pairs += [tuple(x.values()) for g in got for x in g.to_pylist()]
    want = []
    for (la, a, ya, _, va), (lb, b, _, _, vb) in itertools.permutations(rows, 2):
        if la == lb and a != b:
            d = math.sqrt(sum((p - q) ** 2 for p, q in zip(va, vb))) / math.sqrt(len(va))
            if d <= r:
                want.append((la, ya, a, b, d))
    assert len(want) > 300 and {x[0] for x in want} == {0, 1, 2, 3, 4}
    assert [x[:4] for x in sorted(pairs)] == [x[:4] for x in sorted(want)] and np.allclose([x[4] for x in sorted(pairs)], [x[4] for x in sorted(want)], atol=1e-12)


def test_similarity_blocks_of_long_vectors_are_small(monkeypatch):
    import pyarrow as pa

    from stratum.operators import radius as RD

    monkeypatch.setattr(RD, "BYTES", 8 * 50 * 12)
    rows = pa.table({"l": pa.array([0] * 40, pa.int32()), "name": [f"n{i}" for i in range(40)], "year": [1] * 40, "number": np.arange(40), "vec": np.eye(40, 50).tolist()})
    sizes = [RD._Block(b.column(4)[0], 50, 6).x.shape for b in RD.packer(6, 10_000)(rows.to_batches())]
    assert sizes == [(50, 12)] * 3 + [(50, 4)]


def test_similarity_far_rows_are_no_candidates():
    """Vectors alike in their sums only: few products, no exact distance; rows out of a leaf's reach take part in no product."""
    import pyarrow as pa

    from stratum.operators import radius as RD

    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(4000, 36))
    x[2000:] += 9
    rows = pa.table({"l": pa.array([0] * 4000, pa.int32()), "name": [f"n{i}" for i in range(4000)], "year": [1] * 4000, "number": np.arange(4000), "vec": x.tolist()})
    [block] = list(RD.packer(6, 10_000)(rows.to_batches()))
    b = RD._Block(block.column(4)[0], 36, 6)
    assert sum(len(i) for i, _ in RD.candidates(b, b, True, 0.35)) < 4000 * 3999 / 2 / 200


def test_similarity_joins_blocks_not_rows(spark):
    """What is joined are blocks: a join whose rows are candidates takes a step per candidate, of which there are as many as pairs of rows."""
    df = spark.createDataFrame([(f"p{i}", 0, 2000, [0.001 * i] * 6) for i in range(300)], "name string, experience int, year int, vec array<double>")
    out = SN.similar_within_radius(df, 0.0105)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    top = plan.split("Join ")[0]
    assert "MapInArrow" in top and out.count() == 2 * sum(300 - k for k in range(1, 11))


def test_similarity_of_values_that_are_not_finite(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", 0, 1, [0.0, 1.0]), ("b", 0, 1, [0.0, 1.1]), ("c", 0, 1, [0.0, nan]), ("d", 0, 1, [0.0, nan]), ("e", 0, 1, [inf, 1.0]), ("f", 0, 1, [inf, 1.0]),
            ("g", 0, 1, [0.0]), ("h", 0, 1, [1e300, 1.0]), ("i", 0, 1, [1e300, 1.0])]
    df = spark.createDataFrame(rows, "name string, experience int, year int, vec array<double>")
    assert {(x["name"], x["similar_name"]) for x in SN.similar_within_radius(df, 0.2).collect()} == {("a", "b"), ("b", "a"), ("h", "i"), ("i", "h")}
    assert SN.similar_within_radius(df.limit(0), 0.2).count() == 0


def test_rounded_equals_round(spark):
    from stratum.functions.scalar import rounded

    rnd = random.Random(4)
    values = [None, float("nan"), float("inf"), 0.0, -0.0, -1e-12, 0.5, 2.5, 0.125, 1e-9, 5e-9, 1.000000005, 0.123456785, -0.123456785, 1e7, 1e12 + 0.123456789, 1e300]
    values += [rnd.uniform(-1, 1) for _ in range(3000)] + [rnd.randint(-10**9, 10**9) / 10**9 for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for d in (0, 2, 8):
        got = df.select(rounded("v", d).cast("string").alias("a"), F.round("v", d).cast("string").alias("b"))
        assert got.where("not a <=> b").count() == 0
