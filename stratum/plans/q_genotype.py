"""Genotype-table queries: call rates, balance filter, sample / variant QC,
HWE, interval filter, sex imputation, case/control tests, association, Q-Q."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.operators import genotype as GT
from stratum.operators import profile as P
from stratum.operators.association import linear_fits, logistic_fits, normal_equations
from stratum.operators.joins import interval_semi_join
from stratum.plans.registry import query
from stratum.plans.views import view, with_views
from stratum.session import cut_lineage, load


def R(c, d: int = 8):
    return F.round(c, d)


def _g(spark, sf):
    return view(spark, sf, "genotypes")


def _s(spark, sf):
    return view(spark, sf, "samples")


_G = ["genotypes"]
_GS = ["genotypes", "samples"]


@query("call_rate", with_views(_G, """
SELECT count(DISTINCT variant_id) AS n_variants, count(DISTINCT sample_id) AS n_samples, count(*) AS n_genotypes,
       round(count(gt) / count(*), 8) AS call_rate FROM genotypes"""))
def call_rate(spark, sf):
    g = _g(spark, sf)
    return g.agg(F.count_distinct("variant_id").alias("n_variants"), F.count_distinct("sample_id").alias("n_samples"),
                 F.count(F.lit(1)).alias("n_genotypes"), R(F.count("gt") / F.count(F.lit(1))).alias("call_rate"))


_AB_OK = "(gt = 0 AND ab <= 0.1) OR (gt = 1 AND ab >= 0.25 AND ab <= 0.75) OR (gt = 2 AND ab >= 0.9)"


@query("balance_filter", with_views(_G, f"""
SELECT variant_id, count(gt) AS n_called_before, count(CASE WHEN {_AB_OK} THEN gt END) AS n_called_after
FROM (SELECT *, CASE WHEN ad_ref + ad_alt > 0 THEN ad_alt / (ad_ref + ad_alt) END AS ab FROM genotypes) t
GROUP BY variant_id"""))
def balance_filter(spark, sf):
    g = GT.balance_filter(_g(spark, sf).withColumn("gt_before", F.col("gt")))
    return g.groupBy("variant_id").agg(F.count("gt_before").alias("n_called_before"), F.count("gt").alias("n_called_after"))


def _qc_sql(key: str) -> str:
    return f"""SELECT {key}, count(*) AS n, count(gt) AS n_called, round(count(gt) / count(*), 8) AS call_rate,
       count(*) FILTER (WHERE gt = 0) AS n_hom_ref, count(*) FILTER (WHERE gt = 1) AS n_het,
       count(*) FILTER (WHERE gt = 2) AS n_hom_var, round(sum(gt) / (2 * count(gt)), 8) AS af,
       round(avg(gq), 8) AS gq_mean FROM genotypes GROUP BY {key}"""


def _round_qc(df, keys, more=()):
    return df.select(*keys, *more, "n", "n_called", R(F.col("call_rate")).alias("call_rate"), "n_hom_ref", "n_het",
                     "n_hom_var", R(F.col("af")).alias("af"), R(F.col("gq_mean")).alias("gq_mean"))


@query("variant_qc", with_views(_G, _qc_sql("variant_id, contig, pos")))
def variant_qc(spark, sf):
    return _round_qc(GT.variant_qc(_g(spark, sf)), ["variant_id", "contig", "pos"])


@query("sample_qc", with_views(_G, f"""
SELECT *, call_rate >= 0.97 AND gq_mean >= 20 AS pass FROM ({_qc_sql('sample_id')}) q"""))
def sample_qc(spark, sf):
    q = GT.sample_qc(_g(spark, sf))
    return _round_qc(q, ["sample_id"], ["pass"])


@query("variants_after_qc", with_views(_G, f"""
SELECT contig, count(*) AS n_rows, count(DISTINCT variant_id) AS n_variants FROM genotypes
WHERE variant_id IN (SELECT variant_id FROM ({_qc_sql('variant_id')}) q
                     WHERE call_rate > 0.95 AND gq_mean >= 20 AND af > 0.05 AND af < 0.95)
GROUP BY contig"""))
def variants_after_qc(spark, sf):
    k = GT.filter_variants(_g(spark, sf), 0.95, 20.0, (0.05, 0.95))
    return k.groupBy("contig").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("variant_id").alias("n_variants"))


@query("hwe_counts", with_views(_GS, """
SELECT variant_id, super_population, count(*) FILTER (WHERE g = 0) AS n_hom_ref, count(*) FILTER (WHERE g = 1) AS n_het,
       count(*) FILTER (WHERE g = 2) AS n_hom_var
FROM (SELECT variant_id, super_population, CASE WHEN contig <> 'X' OR is_female THEN gt END AS g
      FROM genotypes JOIN samples USING (sample_id)) t GROUP BY variant_id, super_population"""))
def hwe_counts(spark, sf):
    return GT.hwe_counts(_g(spark, sf), _s(spark, sf))


# The population labels of the samples view (region names), in sorted order.
_POPS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
_HWE_SQL = """
, cnt AS (
  SELECT variant_id, super_population, count(*) FILTER (WHERE g = 0) AS aa, count(*) FILTER (WHERE g = 1) AS ab,
         count(*) FILTER (WHERE g = 2) AS bb
  FROM (SELECT variant_id, super_population, CASE WHEN contig <> 'X' OR is_female THEN gt END AS g
        FROM genotypes JOIN samples USING (sample_id)) t GROUP BY 1, 2),
al AS (SELECT *, aa + ab + bb AS n, 2 * aa + ab AS na, 2 * bb + ab AS nb FROM cnt),
hs AS (SELECT variant_id, super_population, ab, n, na, nb, unnest(range(0, least(na, nb) + 1)) AS h FROM al WHERE n > 0),
lp AS (
  SELECT variant_id, super_population, ab, h,
         lgamma(n + 1) - lgamma((na - h) / 2 + 1) - lgamma(h + 1) - lgamma((nb - h) / 2 + 1) + h * ln(2)
         + lgamma(na + 1) + lgamma(nb + 1) - lgamma(2 * n + 1) AS lp
  FROM hs WHERE (na - h) % 2 = 0),
obs AS (SELECT variant_id, super_population, max(CASE WHEN h = ab THEN lp END) AS lpo FROM lp GROUP BY 1, 2),
pv AS (
  SELECT lp.variant_id, lp.super_population,
         least(1.0, sum(exp(lp)) FILTER (WHERE exp(lp) <= exp(lpo) * (1 + 1e-7)) / sum(exp(lp))) AS p
  FROM lp JOIN obs USING (variant_id, super_population) GROUP BY 1, 2),
allp AS (SELECT al.variant_id, al.super_population, pv.p FROM al LEFT JOIN pv USING (variant_id, super_population)),
wide AS (
  SELECT variant_id, """ + ", ".join(
    f"max(p) FILTER (WHERE super_population = '{p}') AS \"{p}\"" for p in _POPS) + """
  FROM allp GROUP BY variant_id)
SELECT variant_id, """ + ", ".join(f"round(\"{p}\", 8) AS \"{p}\"" for p in _POPS) + """,
       CASE WHEN """ + " OR ".join(f"\"{p}\" <= 1e-6" for p in _POPS) + """ THEN false
            WHEN """ + " OR ".join(f"\"{p}\" IS NULL" for p in _POPS) + """ THEN NULL ELSE true END AS all_pops_pass
FROM wide"""


@query("hwe_pvalue", with_views(_GS, _HWE_SQL))
def hwe_pvalue(spark, sf):
    """Exact HWE p per variant and population (a fold over the counts), one column per population (those of the region
    table, read from there), and whether every population passes p > 1e-6."""
    t = GT.hwe_test(GT.hwe_counts(_g(spark, sf), _s(spark, sf)))
    pops = [r[0] for r in load(spark, sf, "region").select("r_name").distinct().orderBy("r_name").collect()]
    wide = t.groupBy("variant_id").pivot("super_population", pops).agg(F.first("p_hwe"))
    wide = wide.withColumn("all_pops_pass", F.forall(F.array(*[F.col(f"`{p}`") for p in pops]), lambda x: x > 1e-6))
    return wide.select("variant_id", *[R(F.col(f"`{p}`")).alias(p) for p in pops], "all_pops_pass")


_INTERVALS = """
intervals AS (
  SELECT CASE WHEN p_partkey % 20 = 0 THEN 'X' ELSE CAST(p_partkey % 20 AS VARCHAR) END AS contig,
         (p_partkey % 200) * 1000 - 500 AS start, (p_partkey % 200) * 1000 - 500 + p_size * 20 AS "end"
  FROM part)"""


def _intervals(spark, sf):
    p = load(spark, sf, "part")
    contig = F.when(F.col("p_partkey") % 20 == 0, F.lit("X")).otherwise((F.col("p_partkey") % 20).cast("string"))
    start = (F.col("p_partkey") % 200) * 1000 - 500
    return p.select(contig.alias("contig"), start.alias("start"), (start + F.col("p_size") * 20).alias("end"))


@query("interval_variants", with_views(_G, f""", {_INTERVALS.strip()}
SELECT DISTINCT variant_id, contig, pos FROM genotypes g
WHERE EXISTS (SELECT 1 FROM intervals i WHERE i.contig = g.contig AND g.pos BETWEEN i.start AND i."end")"""))
def interval_variants(spark, sf):
    v = _g(spark, sf).select("variant_id", "contig", "pos").distinct()
    return interval_semi_join(v, _intervals(spark, sf), "contig", "pos", "start", "end", bin_size=10_000)


@query("sex_check", with_views(_GS, """
, x AS (SELECT * FROM genotypes WHERE contig = 'X'),
af AS (SELECT variant_id, sum(gt) / (2 * count(gt)) AS p FROM x GROUP BY variant_id),
af2 AS (SELECT * FROM af WHERE least(p, 1 - p) >= 0.05),
s AS (SELECT sample_id, count(*) AS n_called, count(*) FILTER (WHERE gt <> 1) AS o_hom,
             sum(1 - 2 * p * (1 - p)) AS e_hom
      FROM x JOIN af2 USING (variant_id) WHERE gt IS NOT NULL GROUP BY sample_id),
f AS (SELECT *, CASE WHEN n_called - e_hom <> 0 THEN (o_hom - e_hom) / (n_called - e_hom) END AS f_stat FROM s),
imp AS (SELECT *, CASE WHEN f_stat < 0.2 THEN true WHEN f_stat > 0.8 THEN false END AS is_female_imputed FROM f)
SELECT sample_id, n_called, round(f_stat, 8) AS f_stat, is_female_imputed, is_female, is_female_imputed = is_female AS sex_check
FROM imp JOIN samples USING (sample_id)"""))
def sex_check(spark, sf):
    imp = GT.impute_sex(_g(spark, sf))
    j = imp.join(_s(spark, sf).select("sample_id", "is_female"), "sample_id")
    return j.select("sample_id", "n_called", R(F.col("f_stat")).alias("f_stat"), "is_female_imputed", "is_female",
                    (F.col("is_female_imputed") == F.col("is_female")).alias("sex_check"))


@query("allele_counts_case_control", with_views(_GS, """
SELECT variant_id,
  CAST(sum(CASE WHEN purple_hair AND gt = 1 THEN 1 ELSE 0 END) + 2 * sum(CASE WHEN purple_hair AND gt = 2 THEN 1 ELSE 0 END) AS BIGINT) AS minor_case,
  CAST(sum(CASE WHEN NOT purple_hair AND gt = 1 THEN 1 ELSE 0 END) + 2 * sum(CASE WHEN NOT purple_hair AND gt = 2 THEN 1 ELSE 0 END) AS BIGINT) AS minor_control,
  CAST(sum(CASE WHEN purple_hair AND gt = 1 THEN 1 ELSE 0 END) + 2 * sum(CASE WHEN purple_hair AND gt = 0 THEN 1 ELSE 0 END) AS BIGINT) AS major_case,
  CAST(sum(CASE WHEN NOT purple_hair AND gt = 1 THEN 1 ELSE 0 END) + 2 * sum(CASE WHEN NOT purple_hair AND gt = 0 THEN 1 ELSE 0 END) AS BIGINT) AS major_control
FROM genotypes JOIN samples USING (sample_id) GROUP BY variant_id"""))
def allele_counts_case_control(spark, sf):
    return GT.case_control_allele_counts(_g(spark, sf), _s(spark, sf), "purple_hair")


_ALLELE_SQL = """
SELECT variant_id,
  CAST(sum(CASE WHEN purple_hair AND gt = 1 THEN 1 ELSE 0 END) + 2 * sum(CASE WHEN purple_hair AND gt = 2 THEN 1 ELSE 0 END) AS BIGINT) AS minor_case,
  CAST(sum(CASE WHEN NOT purple_hair AND gt = 1 THEN 1 ELSE 0 END) + 2 * sum(CASE WHEN NOT purple_hair AND gt = 2 THEN 1 ELSE 0 END) AS BIGINT) AS minor_control,
  CAST(sum(CASE WHEN purple_hair AND gt = 1 THEN 1 ELSE 0 END) + 2 * sum(CASE WHEN purple_hair AND gt = 0 THEN 1 ELSE 0 END) AS BIGINT) AS major_case,
  CAST(sum(CASE WHEN NOT purple_hair AND gt = 1 THEN 1 ELSE 0 END) + 2 * sum(CASE WHEN NOT purple_hair AND gt = 0 THEN 1 ELSE 0 END) AS BIGINT) AS major_control
FROM genotypes JOIN samples USING (sample_id) GROUP BY variant_id"""


@query("fisher_p", with_views(_GS, f"""
, cc AS ({_ALLELE_SQL}),
t AS (SELECT *, minor_case + minor_control AS r1, major_case + major_control AS r2,
             minor_case + major_case AS c1, minor_case + minor_control + major_case + major_control AS n FROM cc),
ks AS (SELECT variant_id, minor_case AS a, r1, r2, c1, n,
              unnest(range(greatest(0, c1 - r2), least(r1, c1) + 1)) AS k FROM t WHERE n > 0),
lp AS (SELECT variant_id, a, k,
              lgamma(r1 + 1) - lgamma(k + 1) - lgamma(r1 - k + 1) + lgamma(r2 + 1) - lgamma(c1 - k + 1)
              - lgamma(r2 - c1 + k + 1) - (lgamma(n + 1) - lgamma(c1 + 1) - lgamma(n - c1 + 1)) AS lp FROM ks),
obs AS (SELECT variant_id, max(CASE WHEN k = a THEN lp END) AS lpo FROM lp GROUP BY 1),
pv AS (SELECT variant_id, least(1.0, sum(exp(lp)) FILTER (WHERE exp(lp) <= exp(lpo) * (1 + 1e-7))) AS p
       FROM lp JOIN obs USING (variant_id) GROUP BY 1)
SELECT t.variant_id, minor_case, minor_control, major_case, major_control, round(p, 8) AS p_fisher
FROM t LEFT JOIN pv USING (variant_id)"""))
def fisher_p(spark, sf):
    """Two-sided Fisher exact p per variant on minor/major × case/control allele counts."""
    c = GT.case_control_allele_counts(_g(spark, sf), _s(spark, sf), "purple_hair")
    f = GT.fisher_test(c)
    return f.select("variant_id", "minor_case", "minor_control", "major_case", "major_control",
                    R(F.col("p_fisher")).alias("p_fisher"))


_ASSOC_2DF = """
, cells AS (
  SELECT variant_id, """ + ", ".join(
    [f"count(*) FILTER (WHERE purple_hair AND gt = {k}) AS a{k}" for k in range(3)] +
    [f"count(*) FILTER (WHERE NOT purple_hair AND gt = {k}) AS u{k}" for k in range(3)]) + """
  FROM genotypes JOIN samples USING (sample_id) WHERE gt IS NOT NULL GROUP BY variant_id),
chi AS (
  SELECT variant_id, a0 + a1 + a2 + u0 + u1 + u2 AS n, """ + " + ".join(
    f"CASE WHEN {r} * ({a} + {u}) / n_ > 0 THEN ({o} - {r} * ({a} + {u}) / n_) * ({o} - {r} * ({a} + {u}) / n_) / ({r} * ({a} + {u}) / n_) ELSE 0.0 END"
    for k in range(3) for (a, u) in [(f"a{k}", f"u{k}")] for (o, r) in [(f"a{k}", "ra"), (f"u{k}", "ru")]) + """ AS chi2
  FROM (SELECT *, a0 + a1 + a2 AS ra, u0 + u1 + u2 AS ru, a0 + a1 + a2 + u0 + u1 + u2 AS n_ FROM cells) c)"""


@query("geno_assoc_2df", with_views(_GS, _ASSOC_2DF + """
SELECT variant_id, n, round(chi2, 8) AS chi2, round(exp(-chi2 / 2), 8) AS p FROM chi"""))
def geno_assoc_2df(spark, sf):
    a = GT.genotype_association_2df(_g(spark, sf), _s(spark, sf), "purple_hair")
    return a.select("variant_id", "n", R(F.col("chi2")).alias("chi2"), R(F.col("p")).alias("p"))


@query("qq_table", with_views(_GS, _ASSOC_2DF + """
, pv AS (SELECT exp(-chi2 / 2) AS p FROM chi WHERE NOT isnan(exp(-chi2 / 2))),
r AS (SELECT p, row_number() OVER (ORDER BY p) AS i, count(*) OVER () AS n FROM pv)
SELECT i, round(p, 8) AS p, round(-log10(i / n), 8) AS expected, round(-log10(p), 8) AS observed FROM r"""))
def qq_table(spark, sf):
    a = GT.genotype_association_2df(_g(spark, sf), _s(spark, sf), "purple_hair")
    q = P.qq_table(a.select("p"), "p")
    return q.select("i", R(F.col("p")).alias("p"), R(F.col("expected")).alias("expected"),
                    R(F.col("observed")).alias("observed"))


@query("assoc_linear", with_views(_GS, """
, j AS (SELECT variant_id, caffeine AS y, CAST(gt AS DOUBLE) AS x1, CASE WHEN is_female THEN 1.0 ELSE 0.0 END AS x2
        FROM genotypes JOIN samples USING (sample_id) WHERE gt IS NOT NULL),
sums AS (
  SELECT variant_id, count(*) AS n, sum(x1) AS s1, sum(x2) AS s2, sum(y) AS sy, sum(x1 * x1) AS s11, sum(x2 * x2) AS s22,
         sum(x1 * x2) AS s12, sum(x1 * y) AS s1y, sum(x2 * y) AS s2y FROM j GROUP BY variant_id),
cov AS (
  SELECT variant_id, n, s1 / n AS m1, s2 / n AS m2, sy / n AS my,
         s11 - s1 * s1 / n AS c11, s22 - s2 * s2 / n AS c22, s12 - s1 * s2 / n AS c12,
         s1y - s1 * sy / n AS c1y, s2y - s2 * sy / n AS c2y FROM sums),
coef AS (
  SELECT variant_id, n, c11, c22, c12, b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM (
    SELECT *, CASE WHEN c11 * c22 - c12 * c12 <> 0 THEN (c22 * c1y - c12 * c2y) / (c11 * c22 - c12 * c12) END AS b1,
              CASE WHEN c11 * c22 - c12 * c12 <> 0 THEN (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) END AS b2
    FROM cov) q),
r AS (SELECT variant_id, sum((y - b0 - b1 * x1 - b2 * x2) * (y - b0 - b1 * x1 - b2 * x2)) AS rss
      FROM j JOIN coef USING (variant_id) GROUP BY variant_id),
se AS (SELECT coef.variant_id, n, b1, CASE WHEN c11 * c22 - c12 * c12 <> 0 AND n > 3
            THEN sqrt(rss / (n - 3) * c22 / (c11 * c22 - c12 * c12)) END AS se FROM coef JOIN r USING (variant_id))
SELECT variant_id, n, round(b1, 8) AS beta, round(se, 8) AS se, round(b1 / se, 6) AS t_stat FROM se"""))
def assoc_linear(spark, sf):
    a = GT.linear_assoc(_g(spark, sf), _s(spark, sf), "caffeine", "is_female")
    return a.select("variant_id", "n", R(F.col("beta")).alias("beta"), R(F.col("se")).alias("se"),
                    R(F.col("t_stat"), 6).alias("t_stat"))


@query("assoc_linear_p")
def assoc_linear_p(spark, sf):
    """Per-variant regression with Student-t p-values (pandas UDF on one row per variant)."""
    a = GT.with_t_pvalue(GT.linear_assoc(_g(spark, sf), _s(spark, sf), "caffeine", "is_female"))
    return a.select("variant_id", "n", "beta", "se", "t_stat", "p_value")


@query("variant_annotated", with_views(_GS, """
SELECT variant_id, sample_id, gt, super_population, is_female FROM genotypes LEFT JOIN samples USING (sample_id)
WHERE contig = 'X' AND (gt > 0 OR gt IS NULL)"""))
def variant_annotated(spark, sf):
    """Left enrichment nested under ``sa``, contig filter, keep true-or-missing predicate."""
    from stratum.operators.joins import enrich_nested

    g = _g(spark, sf).where(F.col("contig") == "X")
    e = enrich_nested(g, _s(spark, sf), "sample_id", "sa")
    e = e.where(F.coalesce(F.col("gt") > 0, F.lit(True)))
    return e.select("variant_id", "sample_id", "gt", F.col("sa.super_population").alias("super_population"),
                    F.col("sa.is_female").alias("is_female"))


@query("assoc_logistic")
def assoc_logistic(spark, sf):
    """Per-variant logistic regression (case = purple hair) on gt + sex, Wald test; Newton steps as aggregates."""
    return GT.logistic_wald(_g(spark, sf), _s(spark, sf), "purple_hair", "is_female")


def _pca(spark, sf, k=5, g=None):
    """Standardised genotypes of the variants on the interval list, and their first components per sample."""
    from stratum.operators.pca import lanczos_pca, standardized_genotypes

    g = g if g is not None else _g(spark, sf)
    listed = cut_lineage(interval_semi_join(g, _intervals(spark, sf), "contig", "pos", "start", "end", bin_size=10_000).select("variant_id", "sample_id", "gt"))
    z = cut_lineage(standardized_genotypes(listed))
    return z, *lanczos_pca(z, "sample_id", "variant_id", "z", k=k)


@query("geno_pca")
def geno_pca(spark, sf):
    """Top 5 principal-component scores per sample of the standardised genotypes on the interval list (block Lanczos)."""
    _, scores, lam = _pca(spark, sf)
    ev = spark.createDataFrame([(i, float(v)) for i, v in enumerate(lam)], "pc int, eigenvalue double")
    return scores.join(F.broadcast(ev), "pc")  # five rows


@query("geno_pca_residuals", """
SELECT CAST(range AS INTEGER) AS pc, true AS exact, true AS descending FROM range(0, 5)""")
def geno_pca_residuals(spark, sf):
    """Are the components eigenvectors? Each one's residual against X X', recomputed from the scores, and the order of the values."""
    from stratum.operators.pca import eigen_residuals

    z, scores, _ = _pca(spark, sf)
    found = eigen_residuals(z, scores, "sample_id", "variant_id", "z")
    over = Window.orderBy("pc")  # five rows
    falls = F.coalesce(F.lag("eigenvalue").over(over) >= F.col("eigenvalue") * (1 - 1e-9), F.lit(True))
    return found.select(F.col("pc").cast("int").alias("pc"), (F.col("residual") < 1e-6).alias("exact"), falls.alias("descending"))


#: Populations as covariates: all but two of the regions stand against the rest.
_ADJUST = {"is_female": "is_female", "in_africa": "super_population = 'AFRICA'", "in_america": "super_population = 'AMERICA'",
           "in_asia": "super_population = 'ASIA'"}


def _adjusted_samples(spark, sf):
    return _s(spark, sf).select("sample_id", "caffeine", "purple_hair", *[F.expr(e).cast("double").alias(n) for n, e in _ADJUST.items()])


#: Call rate, mean quality and the open frequency range of variants that are tested (the view calls about 95 % of its genotypes).
_ASSOC_QC = (0.8, 20.0, (0.05, 0.95))
_KEPT_SQL = f""", kept AS (SELECT variant_id FROM ({_qc_sql('variant_id')}) q WHERE call_rate > {_ASSOC_QC[0]} AND gq_mean >= {_ASSOC_QC[1]} AND af > 0.05 AND af < 0.95)"""


def _eliminated_sql(y: str) -> str:
    """Cross products per variant, then Gaussian elimination of all covariates: what is left belongs to gt and y."""
    names = ["1.0", *[f"CAST({e} AS DOUBLE)" for e in (f"CASE WHEN {v} THEN 1 ELSE 0 END" for v in _ADJUST.values())], "CAST(gt AS DOUBLE)", y]
    p = len(names)
    cell = lambda i, j: f"a{min(i, j)}_{max(i, j)}"
    steps = [f""", e0 AS (SELECT variant_id, count(*) AS n, {', '.join(f'sum(x{i} * x{j}) AS {cell(i, j)}' for i in range(p) for j in range(i, p))}
FROM (SELECT variant_id, {', '.join(f'{e} AS x{i}' for i, e in enumerate(names))} FROM genotypes JOIN samples USING (sample_id)
      WHERE gt IS NOT NULL AND variant_id IN (SELECT variant_id FROM kept)) t GROUP BY variant_id)"""]
    for k in range(p - 2):
        rest = [(i, j) for i in range(k + 1, p) for j in range(i, p)]
        bad = f"abs({cell(k, k)}) <= 1e-9 * n"
        steps.append(f", e{k + 1} AS (SELECT variant_id, n, " + ", ".join(
            f"CASE WHEN {bad} THEN NULL ELSE {cell(i, j)} - {cell(k, i)} * {cell(k, j)} / {cell(k, k)} END AS {cell(i, j)}" for i, j in rest) + f" FROM e{k})")
    g, last = p - 2, p - 1
    steps.append(f""", fit AS (SELECT variant_id, n, {cell(g, last)} / {cell(g, g)} AS beta,
  CASE WHEN n > {p - 1} THEN sqrt(({cell(last, last)} - {cell(g, last)} * {cell(g, last)} / {cell(g, g)}) / (n - {p - 1}) / {cell(g, g)}) END AS se
FROM e{p - 2} WHERE {cell(g, g)} > 1e-9 * n)""")
    return "".join(steps)


@query("assoc_linear_adjusted", with_views(_GS, _KEPT_SQL + _eliminated_sql("caffeine") + """
SELECT variant_id, n, round(beta, 8) AS beta, round(se, 8) AS se, round(beta / se, 6) AS t_stat FROM fit WHERE se IS NOT NULL"""))
def assoc_linear_adjusted(spark, sf):
    """caffeine ~ gt + sex + three population indicators per variant that passes QC and the open frequency range."""
    kept = GT.filter_variants(_g(spark, sf), *_ASSOC_QC)
    fits = linear_fits(kept, _adjusted_samples(spark, sf), "caffeine", list(_ADJUST))
    return fits.where("se is not null").select("variant_id", "n", R(F.col("beta")).alias("beta"), R(F.col("se")).alias("se"),
                                               R(F.col("t_stat"), 6).alias("t_stat"))


@query("assoc_linear_pcs")
def assoc_linear_pcs(spark, sf):
    """caffeine ~ gt + sex + PC1-3 per variant that passes QC, with Student-t p-values."""
    kept = GT.filter_variants(_g(spark, sf), *_ASSOC_QC)
    fits = linear_fits(kept, _with_pcs(spark, sf), "caffeine", ["is_female", "pc1", "pc2", "pc3"])
    return GT.with_t_pvalue(fits.drop("coefficients"), k=6)


def _with_pcs(spark, sf, g=None):
    _, scores, _ = _pca(spark, sf, k=3, g=g)
    wide = scores.groupBy("sample_id").pivot("pc", [0, 1, 2]).agg(F.first("score")).toDF("sample_id", "pc1", "pc2", "pc3")
    return _s(spark, sf).join(wide, "sample_id", "left").na.fill(0.0, ["pc1", "pc2", "pc3"]).withColumn("is_female", F.col("is_female").cast("double"))


@query("assoc_pcs_optimality", with_views(_GS, _KEPT_SQL + """
SELECT model, variant_id, count(gt) AS n, true AS optimal
FROM genotypes JOIN samples USING (sample_id), (VALUES ('linear'), ('logistic')) AS m(model)
WHERE variant_id IN (SELECT variant_id FROM kept) GROUP BY model, variant_id"""))
def assoc_pcs_optimality(spark, sf):
    """Both association models with sex and PC1-3: do the score equations vanish at the returned coefficients, per variant?

    Each variant that passes quality control has a row per model. A fit without coefficients (singular, separated, no degree of
    freedom or no row to fit) has shown nothing: it is not optimal.
    """
    g = cut_lineage(_g(spark, sf).select("variant_id", "contig", "pos", "sample_id", "gt", "gq"))  # read by quality control and components
    kept = cut_lineage(GT.filter_variants(g, *_ASSOC_QC))
    people = cut_lineage(_with_pcs(spark, sf, g).withColumn("purple_hair", F.col("purple_hair").cast("double")))
    tested = cut_lineage(kept.join(people.select("sample_id"), "sample_id", "left_semi").select("variant_id").distinct())
    by = ["is_female", "pc1", "pc2", "pc3"]
    out = []
    for model, y, fit in (("linear", "caffeine", linear_fits), ("logistic", "purple_hair", logistic_fits)):
        fits = cut_lineage(fit(kept, people, y, by))
        worst = normal_equations(kept, people, fits.where("coefficients is not null"), y, by, logistic=model == "logistic")
        found = tested.join(fits, "variant_id", "left").join(worst, "variant_id", "left")
        out.append(found.select(F.lit(model).alias("model"), "variant_id", F.coalesce("n", F.lit(0).cast("long")).alias("n"),
                                F.coalesce(F.col("worst") < 1e-7, F.lit(False)).alias("optimal")))
    return out[0].unionByName(out[1])


@query("assoc_logistic_adjusted")
def assoc_logistic_adjusted(spark, sf):
    """purple hair ~ gt + sex + three population indicators per variant that passes QC: Wald test, or why there is none."""
    kept = GT.filter_variants(_g(spark, sf), *_ASSOC_QC)
    return logistic_fits(kept, _adjusted_samples(spark, sf), "purple_hair", list(_ADJUST))


@query("fisher_rare", with_views(_GS, f"""
, rare AS (SELECT variant_id FROM ({_qc_sql('variant_id')}) q WHERE af > 0 AND af <= 0.4 OR af >= 0.6 AND af < 1),
cc AS ({_ALLELE_SQL}),
t AS (SELECT *, minor_case + minor_control AS r1, major_case + major_control AS r2, minor_case + major_case AS c1,
             minor_case + minor_control + major_case + major_control AS n FROM cc WHERE variant_id IN (SELECT variant_id FROM rare)),
ks AS (SELECT variant_id, minor_case AS a, r1, r2, c1, n, unnest(range(greatest(0, c1 - r2), least(r1, c1) + 1)) AS k FROM t WHERE n > 0),
lp AS (SELECT variant_id, a, k, lgamma(r1 + 1) - lgamma(k + 1) - lgamma(r1 - k + 1) + lgamma(r2 + 1) - lgamma(c1 - k + 1)
              - lgamma(r2 - c1 + k + 1) - (lgamma(n + 1) - lgamma(c1 + 1) - lgamma(n - c1 + 1)) AS lp FROM ks),
obs AS (SELECT variant_id, max(CASE WHEN k = a THEN lp END) AS lpo FROM lp GROUP BY 1)
SELECT variant_id, round(least(1.0, sum(exp(lp)) FILTER (WHERE exp(lp) <= exp(lpo) * (1 + 1e-7))), 8) AS p_fisher
FROM lp JOIN obs USING (variant_id) GROUP BY 1"""))
def fisher_rare(spark, sf):
    """Fisher's test for the variants whose rarer allele is rare (here at most 0.4: the view's frequencies lie near one half)."""
    rare = GT.rare_variants(_g(spark, sf), 0.4)
    f = GT.fisher_test(GT.case_control_allele_counts(rare, _s(spark, sf), "purple_hair"))
    return f.where("p_fisher is not null").select("variant_id", R(F.col("p_fisher")).alias("p_fisher"))


@query("split_multi_allelic", with_views(_G, """
, m AS (
  SELECT a.variant_id AS site, a.sample_id, a.gt AS g1, b.gt AS g2
  FROM genotypes a JOIN genotypes b ON b.variant_id = a.variant_id + 1 AND a.sample_id = b.sample_id
  WHERE a.variant_id % 2 = 0),
al AS (
  SELECT site, sample_id,
         CASE WHEN g1 IS NULL OR g2 IS NULL THEN NULL
              ELSE least(g1, 2) END AS c1,
         CASE WHEN g1 IS NULL OR g2 IS NULL THEN NULL
              ELSE least(g2, 2 - least(g1, 2)) END AS c2 FROM m)
SELECT site, allele_index, count(gt) AS n_called, CAST(sum(gt) AS BIGINT) AS alt_alleles FROM (
  SELECT site, 1 AS allele_index, c1 AS gt FROM al UNION ALL SELECT site, 2 AS allele_index, c2 AS gt FROM al) t
GROUP BY site, allele_index"""))
def split_multi_allelic(spark, sf):
    """Two adjacent variants merged into one tri-allelic site (diploid allele pairs), then split back to
    bi-allelic rows with per-allele alternate counts."""
    g = _g(spark, sf)
    a = g.where(F.col("variant_id") % 2 == 0).select(F.col("variant_id").alias("site"), "sample_id", F.col("gt").alias("g1"))
    b = g.select((F.col("variant_id") - 1).alias("site"), "sample_id", F.col("gt").alias("g2"))
    m = a.join(b, ["site", "sample_id"])
    c1 = F.least(F.col("g1"), F.lit(2))
    c2 = F.least(F.col("g2"), 2 - c1)
    alleles = F.concat(F.array_repeat(F.lit(1), c1), F.array_repeat(F.lit(2), c2),
                       F.array_repeat(F.lit(0), 2 - c1 - c2))
    multi = m.select("site", "sample_id", F.array(F.lit("G"), F.lit("T")).alias("alts"),
                     F.when(F.col("g1").isNotNull() & F.col("g2").isNotNull(), alleles).alias("alleles"))
    split = GT.split_multi(multi)
    return split.groupBy("site", "allele_index").agg(F.count("gt").alias("n_called"),
                                                     F.sum("gt").cast("long").alias("alt_alleles"))
