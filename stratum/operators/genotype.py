"""Genotype operators on a long table (variant_id, contig, pos, sample_id, gt, gq, ad_ref, ad_alt).

gt = number of alternate alleles (0/1/2), NULL = no call. Every per-variant
or per-sample statistic is a partial-aggregated groupBy; exact tests are folds in
column expressions on the aggregated counts, tails of t and z pandas UDFs on them.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions import stats as ST
from stratum.functions.exact_tests import fisher_p, hardy_weinberg_p
from stratum.operators.joins import lookup_join


def split_multi(df: DataFrame, alts: str = "alts", gt_alleles: str = "alleles") -> DataFrame:
    """Multi-allelic rows → one bi-allelic row per alternate allele (index a = 1..k).

    ``alleles`` is the call's pair of allele indices; the bi-allelic gt counts
    how many of them equal a. The allele index comes from ``posexplode``.
    """
    x = df.select("*", F.posexplode(alts).alias("_ai", "alt")).drop(alts)
    a = F.col("_ai") + 1
    gt = F.aggregate(F.col(gt_alleles), F.lit(0), lambda acc, v: acc + F.when(v == a, 1).otherwise(0))
    return x.withColumn("gt", F.when(F.col(gt_alleles).isNotNull(), gt)).withColumn("allele_index", a).drop(
        "_ai", gt_alleles)


def allelic_balance(ad_ref: str = "ad_ref", ad_alt: str = "ad_alt") -> Column:
    tot = F.col(ad_ref) + F.col(ad_alt)
    return F.when(tot > 0, F.col(ad_alt) / tot)


def balance_filter(df: DataFrame, gt: str = "gt") -> DataFrame:
    """Failing calls become missing (the row stays): HomRef ab ≤ 0.1, Het 0.25–0.75, HomVar ≥ 0.9."""
    ab = allelic_balance()
    g = F.col(gt)
    ok = (((g == 0) & (ab <= 0.1)) | ((g == 1) & (ab >= 0.25) & (ab <= 0.75)) | ((g == 2) & (ab >= 0.9)))
    return df.withColumn(gt, F.when(F.coalesce(ok, F.lit(False)), g))


def call_stats(df: DataFrame, by: Sequence[str], gt: str = "gt", gq: str = "gq") -> DataFrame:
    """Per-group call rate, counts of hom-ref / het / hom-var, alt-allele frequency, mean GQ."""
    g = F.col(gt)
    called = F.count(g)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), called.alias("n_called"),
        (called / F.count(F.lit(1))).alias("call_rate"),
        F.count_if(g == 0).alias("n_hom_ref"), F.count_if(g == 1).alias("n_het"), F.count_if(g == 2).alias("n_hom_var"),
        (F.sum(g) / (2 * called)).alias("af"), F.avg(gq).alias("gq_mean"))


def variant_qc(df: DataFrame) -> DataFrame:
    return call_stats(df, ["variant_id", "contig", "pos"])


def sample_qc(df: DataFrame, min_call_rate: float = 0.97, min_gq: float = 20.0) -> DataFrame:
    q = call_stats(df, ["sample_id"])
    return q.withColumn("pass", (F.col("call_rate") >= min_call_rate) & (F.col("gq_mean") >= min_gq))


def filter_variants(df: DataFrame, min_call_rate: float = 0.95, min_gq: float = 20.0,
                    af_range: tuple[float, float] = (0.0, 1.0)) -> DataFrame:
    """Keep genotype rows of variants passing call-rate, GQ and AF limits, the AF range open (group agg + semi join)."""
    q = variant_qc(df)
    keep = q.where((F.col("call_rate") > min_call_rate) & (F.col("gq_mean") >= min_gq) &
                   (F.col("af") > af_range[0]) & (F.col("af") < af_range[1])).select("variant_id")
    return df.join(keep, "variant_id", "left_semi")


def hwe_counts(df: DataFrame, samples: DataFrame, pop: str = "super_population", female: str = "is_female",
               x_contig: str = "X") -> DataFrame:
    """Genotype counts per variant and population in one pass; on X only females count."""
    j = lookup_join(df, samples.select("sample_id", pop, female), "sample_id")
    use = (F.col("contig") != x_contig) | F.col(female)
    g = F.when(use, F.col("gt"))
    return j.groupBy("variant_id", pop).agg(F.count_if(g == 0).alias("n_hom_ref"), F.count_if(g == 1).alias("n_het"),
                                           F.count_if(g == 2).alias("n_hom_var"))


@F.pandas_udf(T.DoubleType())
def t_p_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(ST.t_two_sided_p(t.to_numpy(dtype=float), df.to_numpy(dtype=float)))


def hwe_test(counts: DataFrame) -> DataFrame:
    """Expected heterozygote frequency and exact HWE p-value per row of genotype counts."""
    n = F.col("n_hom_ref") + F.col("n_het") + F.col("n_hom_var")
    p = (2 * F.col("n_hom_var") + F.col("n_het")) / (2 * n)
    return counts.withColumn("r_expected_het_frequency", F.when(n > 0, 2 * p * (1 - p))) \
        .withColumn("p_hwe", hardy_weinberg_p("n_hom_ref", "n_het", "n_hom_var"))


def case_control_allele_counts(df: DataFrame, samples: DataFrame, case: str) -> DataFrame:
    """Minor/major allele counts in cases and controls per variant (het = 1, hom = 2)."""
    j = lookup_join(df, samples.select("sample_id", case), "sample_id")
    g, c = F.col("gt"), F.col(case)

    def s(cond):
        return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")

    return j.groupBy("variant_id").agg(
        (s(c & (g == 1)) + 2 * s(c & (g == 2))).alias("minor_case"),
        (s(~c & (g == 1)) + 2 * s(~c & (g == 2))).alias("minor_control"),
        (s(c & (g == 1)) + 2 * s(c & (g == 0))).alias("major_case"),
        (s(~c & (g == 1)) + 2 * s(~c & (g == 0))).alias("major_control"))


def fisher_test(counts: DataFrame) -> DataFrame:
    return counts.withColumn("p_fisher", fisher_p("minor_case", "minor_control", "major_case", "major_control"))


def rare_variants(df: DataFrame, max_af: float = 0.05) -> DataFrame:
    """Genotype rows of variants whose allele frequency lies in (0, max_af] or [1 - max_af, 1)."""
    q = variant_qc(df)
    keep = q.where(((F.col("af") > 0) & (F.col("af") <= max_af)) | ((F.col("af") >= 1 - max_af) & (F.col("af") < 1))).select("variant_id")
    return df.join(keep, "variant_id", "left_semi")


def genotype_association_2df(df: DataFrame, samples: DataFrame, case: str) -> DataFrame:
    """2×3 (case/control × gt) Pearson χ² per variant with its exact 2-df p-value exp(−χ²/2)."""
    j = lookup_join(df.where(F.col("gt").isNotNull()), samples.select("sample_id", case), "sample_id")
    cells = j.groupBy("variant_id").agg(*[F.count_if(F.col(case) & (F.col("gt") == k)).alias(f"a{k}") for k in range(3)],
                                       *[F.count_if(~F.col(case) & (F.col("gt") == k)).alias(f"u{k}") for k in range(3)])
    a = [F.col(f"a{k}") for k in range(3)]
    u = [F.col(f"u{k}") for k in range(3)]
    ra, ru = a[0] + a[1] + a[2], u[0] + u[1] + u[2]
    n = ra + ru
    chi = None
    for k in range(3):
        ck = a[k] + u[k]
        for obs, r in ((a[k], ra), (u[k], ru)):
            e = r * ck / n
            term = F.when(e > 0, (obs - e) * (obs - e) / e).otherwise(F.lit(0.0))
            chi = term if chi is None else chi + term
    return cells.select("variant_id", n.alias("n"), chi.alias("chi2"), F.exp(-chi / 2).alias("p"))


def impute_sex(df: DataFrame, maf_threshold: float = 0.05, x_contig: str = "X", female_below: float = 0.2,
               male_above: float = 0.8) -> DataFrame:
    """Inbreeding coefficient F on X variants with MAF ≥ threshold; F < 0.2 female, F > 0.8 male, else NULL.

    F = (O − E) / (N − E): O observed homozygous calls, E = Σ(1 − 2p(1−p)), N called X variants.
    """
    x = df.where(F.col("contig") == x_contig)
    af = x.groupBy("variant_id").agg((F.sum("gt") / (2 * F.count("gt"))).alias("_p"))
    af = af.where(F.least(F.col("_p"), 1 - F.col("_p")) >= maf_threshold)
    j = lookup_join(x.where(F.col("gt").isNotNull()), af, "variant_id")
    s = j.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_called"),
                                   F.count_if(F.col("gt") != 1).alias("o_hom"),
                                   F.sum(1 - 2 * F.col("_p") * (1 - F.col("_p"))).alias("e_hom"))
    f = F.when(F.col("n_called") - F.col("e_hom") != 0,
               (F.col("o_hom") - F.col("e_hom")) / (F.col("n_called") - F.col("e_hom")))
    s = s.withColumn("f_stat", f)
    return s.withColumn("is_female_imputed", F.when(F.col("f_stat") < female_below, F.lit(True))
                        .when(F.col("f_stat") > male_above, F.lit(False)))


def linear_assoc(df: DataFrame, samples: DataFrame, y: str, covariate: str) -> DataFrame:
    """Per-variant OLS ``y ~ 1 + gt + covariate`` from cross-product sums: beta, se, t, p (Student t)."""
    from stratum.operators.regression import grouped_ols2

    j = lookup_join(df.where(F.col("gt").isNotNull()), samples.select("sample_id", y, covariate), "sample_id")
    j = j.select("variant_id", F.col(y).cast("double").alias("_y"), F.col("gt").cast("double").alias("_x1"),
                 F.col(covariate).cast("double").alias("_x2"))
    coef = grouped_ols2(j, "variant_id", "_y", "_x1", "_x2")
    # residual sum of squares needs a second pass with the fitted coefficients
    res = F.col("_y") - F.col("b0") - F.col("b1") * F.col("_x1") - F.col("b2") * F.col("_x2")
    r = lookup_join(j, coef.drop("n"), "variant_id").groupBy("variant_id").agg(
        F.sum(res * res).alias("rss"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("_x1")).alias("s1"), F.sum(F.col("_x2")).alias("s2"), F.sum(F.col("_x1") * F.col("_x1")).alias("s11"),
        F.sum(F.col("_x2") * F.col("_x2")).alias("s22"), F.sum(F.col("_x1") * F.col("_x2")).alias("s12"),
        F.first("b1").alias("beta"))
    n = F.col("n")
    c11 = F.col("s11") - F.col("s1") * F.col("s1") / n
    c22 = F.col("s22") - F.col("s2") * F.col("s2") / n
    c12 = F.col("s12") - F.col("s1") * F.col("s2") / n
    det = c11 * c22 - c12 * c12
    se = F.when((det != 0) & (n > 3), F.sqrt(F.col("rss") / (n - 3) * c22 / det))
    return r.select("variant_id", "n", "beta", se.alias("se"), (F.col("beta") / se).alias("t_stat"))


def with_t_pvalue(df: DataFrame, t: str = "t_stat", n: str = "n", k: int = 3) -> DataFrame:
    return df.withColumn("p_value", t_p_udf(F.col(t), (F.col(n) - k).cast("double")))


def _inv3(a, b, c, d, e, f):
    """Inverse of the symmetric 3×3 [[a,b,c],[b,d,e],[c,e,f]] as column expressions (NULL if singular)."""
    det = a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d)
    ok = F.abs(det) > F.lit(1e-12)

    def q(x):
        return F.when(ok, x / det)

    return (q(d * f - e * e), q(c * e - b * f), q(b * e - c * d), q(a * f - c * c), q(b * c - a * e), q(a * d - b * b))


@F.pandas_udf(T.DoubleType())
def normal_two_sided_p_udf(z: pd.Series) -> pd.Series:
    import math

    return (z.abs() / math.sqrt(2.0)).map(math.erfc, na_action="ignore")


def logistic_wald(df: DataFrame, samples: DataFrame, y: str, covariate: str, iters: int = 25,
                  tol: float = 1e-10) -> DataFrame:
    """Per-variant logistic regression ``y ~ 1 + gt + covariate`` with a Wald test on gt.

    Newton–Raphson where each step is one distributed aggregate: genotype
    rows joined with the current coefficients (a per-variant table, size
    checked before broadcast), ``XᵀWX`` (6 sums) and ``Xᵀ(y−p)`` (3 sums) per
    variant, then a closed-form 3×3 solve in column expressions. The
    coefficient table is checkpointed (reliable, shared folder) every step so
    lineage stays one step long. A step takes only the variants that have not
    converged (largest coefficient step below ``tol``), until none is left or
    after ``iters`` steps. ``converged`` says which have; the others (separated
    or singular data, whose likelihood has no maximum, or too slow for
    ``iters``) have NULL beta, se, z_stat and p_wald.
    """
    from stratum.session import cut_lineage

    rows = lookup_join(df.where(F.col("gt").isNotNull()), samples.select("sample_id", y, covariate), "sample_id")
    rows = cut_lineage(rows.select("variant_id", F.col(y).cast("double").alias("_y"),
                                   F.col("gt").cast("double").alias("_x1"),
                                   F.col(covariate).cast("double").alias("_x2")))
    beta = rows.select("variant_id").distinct().select("variant_id", F.lit(0.0).alias("b0"), F.lit(0.0).alias("b1"),
                                                         F.lit(0.0).alias("b2"), F.lit(False).alias("done"),
                                                         F.lit(False).alias("stuck"))
    beta = cut_lineage(beta)
    one, x1, x2 = F.lit(1.0), F.col("_x1"), F.col("_x2")
    for _ in range(iters):
        j = lookup_join(rows, beta.where("not done and not stuck"), "variant_id")
        eta = F.col("b0") + F.col("b1") * x1 + F.col("b2") * x2
        p = 1.0 / (1.0 + F.exp(-eta))
        w = p * (1 - p)
        r = F.col("_y") - p
        s = j.groupBy("variant_id").agg(
            F.first("b0").alias("b0"), F.first("b1").alias("b1"), F.first("b2").alias("b2"),
            F.sum(w).alias("h11"), F.sum(w * x1).alias("h12"), F.sum(w * x2).alias("h13"),
            F.sum(w * x1 * x1).alias("h22"), F.sum(w * x1 * x2).alias("h23"), F.sum(w * x2 * x2).alias("h33"),
            F.sum(r * one).alias("g1"), F.sum(r * x1).alias("g2"), F.sum(r * x2).alias("g3"),
            F.count(F.lit(1)).alias("n"))
        i11, i12, i13, i22, i23, i33 = _inv3(*[F.col(c) for c in ("h11", "h12", "h13", "h22", "h23", "h33")])
        g1, g2, g3 = F.col("g1"), F.col("g2"), F.col("g3")
        d0 = i11 * g1 + i12 * g2 + i13 * g3
        d1 = i12 * g1 + i22 * g2 + i23 * g3
        d2 = i13 * g1 + i23 * g2 + i33 * g3
        step = F.when(d0.isNotNull() & d1.isNotNull() & d2.isNotNull(), F.greatest(F.abs(d0), F.abs(d1), F.abs(d2)))
        stuck = step.isNull() | F.isnan(step)  # singular: no step to take
        new = s.select("variant_id", *[F.when(stuck, F.col(b)).otherwise(F.col(b) + d).alias(b)
                                       for b, d in (("b0", d0), ("b1", d1), ("b2", d2))],
                       F.coalesce(~stuck & (step < tol), F.lit(False)).alias("done"), stuck.alias("stuck"))
        beta = cut_lineage(new.unionByName(beta.where("done or stuck")))
        if beta.where("not done and not stuck").limit(1).count() == 0:
            break
    # standard error from the information matrix at the final coefficients
    j = lookup_join(rows, beta, "variant_id")
    eta = F.col("b0") + F.col("b1") * x1 + F.col("b2") * x2
    p = 1.0 / (1.0 + F.exp(-eta))
    w = p * (1 - p)
    s = j.groupBy("variant_id").agg(
        F.first("b1").alias("beta"), F.first("done").alias("converged"), F.count(F.lit(1)).alias("n"),
        F.sum(w).alias("h11"), F.sum(w * x1).alias("h12"), F.sum(w * x2).alias("h13"), F.sum(w * x1 * x1).alias("h22"),
        F.sum(w * x1 * x2).alias("h23"), F.sum(w * x2 * x2).alias("h33"))
    inv = _inv3(*[F.col(c) for c in ("h11", "h12", "h13", "h22", "h23", "h33")])
    se = F.when(inv[3] > 0, F.sqrt(inv[3]))
    out = s.select("variant_id", "n", F.when(F.col("converged"), F.col("beta")).alias("beta"),
                   F.when(F.col("converged"), se).alias("se"), "converged").withColumn("z_stat", F.col("beta") / F.col("se"))
    out = out.withColumn("p_wald", F.when(F.col("z_stat").isNotNull(), normal_two_sided_p_udf("z_stat")))
    return out.select("variant_id", "n", "beta", "se", "z_stat", "p_wald", "converged")
