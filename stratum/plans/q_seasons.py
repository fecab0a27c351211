"""Season queries: dedup, z-scores, normalisation, per-age / per-experience
stat tables, prior-season pairs, next-season rows, similarity, per-metric models."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.functions.scalar import rounded
from stratum.operators import aggregates as A
from stratum.operators import seasons as SN
from stratum.operators import windows as W
from stratum.operators import grid as G
from stratum.operators.splits import key_bucket, key_bucket_sql
from stratum.plans.registry import query
from stratum.plans.views import view, with_views
from stratum.session import cut_lineage


def R(c, d: int = 8):
    return F.round(c, d)


_SQL = """WITH
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY name, year
                                 ORDER BY CASE WHEN team = 'TOT' THEN 1 ELSE 0 END DESC, team DESC) AS rn
    FROM raw_seasons) t WHERE rn = 1),
ys AS (
  SELECT year, avg(fgp) AS a_fgp, avg(ftp) AS a_ftp,
         avg(tp) AS a_tp, stddev_pop(tp) AS s_tp, avg(trb) AS a_trb, stddev_pop(trb) AS s_trb,
         avg(pts) AS a_pts, stddev_pop(pts) AS s_pts, avg(tov) AS a_tov, stddev_pop(tov) AS s_tov
  FROM dedup GROUP BY year),
p1 AS (
  SELECT d.name, d.year, d.age, d.team, (fgp - a_fgp) * fga AS fg, (ftp - a_ftp) * fta AS ft,
         CASE WHEN s_tp <> 0 THEN (tp - a_tp) / s_tp END AS ztp,
         CASE WHEN s_trb <> 0 THEN (trb - a_trb) / s_trb END AS ztrb,
         CASE WHEN s_pts <> 0 THEN (pts - a_pts) / s_pts END AS zpts,
         -(CASE WHEN s_tov <> 0 THEN (tov - a_tov) / s_tov END) AS ztov
  FROM dedup d JOIN ys ON d.year = ys.year),
ys2 AS (SELECT year, avg(fg) AS a_fg, stddev_pop(fg) AS s_fg, avg(ft) AS a_ft, stddev_pop(ft) AS s_ft FROM p1 GROUP BY year),
zt AS (
  SELECT *, zfg + zft + ztp + ztrb + ztov + zpts AS ztot FROM (
    SELECT p1.name, p1.year, p1.age, p1.team,
           CASE WHEN s_fg <> 0 THEN (fg - a_fg) / s_fg END AS zfg,
           CASE WHEN s_ft <> 0 THEN (ft - a_ft) / s_ft END AS zft, ztp, ztrb, ztov, zpts
    FROM p1 JOIN ys2 ON p1.year = ys2.year) q),
ym AS (
  SELECT year, greatest(abs(max(zfg)), abs(min(zfg))) AS m_fg, greatest(abs(max(zft)), abs(min(zft))) AS m_ft,
         greatest(abs(max(ztp)), abs(min(ztp))) AS m_tp, greatest(abs(max(ztrb)), abs(min(ztrb))) AS m_trb,
         greatest(abs(max(ztov)), abs(min(ztov))) AS m_tov, greatest(abs(max(zpts)), abs(min(zpts))) AS m_pts
  FROM zt GROUP BY year),
players AS (
  SELECT *, nfg + nft + ntp + ntrb + ntov + npts AS ntot FROM (
    SELECT zt.*, CASE WHEN m_fg <> 0 THEN zfg / m_fg END AS nfg, CASE WHEN m_ft <> 0 THEN zft / m_ft END AS nft,
           CASE WHEN m_tp <> 0 THEN ztp / m_tp END AS ntp, CASE WHEN m_trb <> 0 THEN ztrb / m_trb END AS ntrb,
           CASE WHEN m_tov <> 0 THEN ztov / m_tov END AS ntov, CASE WHEN m_pts <> 0 THEN zpts / m_pts END AS npts
    FROM zt JOIN ym ON zt.year = ym.year) q),
deltas AS (
  SELECT name, year, age, ztot AS value_z, ntot AS value_n,
         ztot - lag(ztot) OVER (PARTITION BY name ORDER BY year) AS delta_z,
         ntot - lag(ntot) OVER (PARTITION BY name ORDER BY year) AS delta_n
  FROM players),
withexp AS (
  SELECT *, age - min(age) OVER (PARTITION BY name) AS exp FROM deltas)
"""


def _sql(body: str) -> str:
    return with_views(["raw_seasons"], _SQL + body)


def _scored(spark, sf):
    return SN.score_seasons(SN.dedup_seasons(view(spark, sf, "raw_seasons")))


@query("season_dedup", _sql("SELECT name, year, age, team FROM dedup"))
def season_dedup(spark, sf):
    return SN.dedup_seasons(view(spark, sf, "raw_seasons")).select("name", "year", "age", "team")


@query("season_zscores", _sql("SELECT name, year, " + ", ".join(f"round({c}, 8) AS {c}" for c in SN.SCORES + ["ztot"])
                              + " FROM players"))
def season_zscores(spark, sf):
    s = _scored(spark, sf)
    return s.select("name", "year", *[R(F.col(c)).alias(c) for c in SN.SCORES + ["ztot"]])


@query("season_norm", _sql("SELECT name, year, " + ", ".join(f"round({c}, 8) AS {c}" for c in SN.NORMS + ["ntot"])
                           + " FROM players"))
def season_norm(spark, sf):
    s = _scored(spark, sf)
    return s.select("name", "year", *[R(F.col(c)).alias(c) for c in SN.NORMS + ["ntot"]])


def _stat_sql(key: str, src: str) -> str:
    cols = []
    for m in ["value_z", "value_n", "delta_z", "delta_n"]:
        cols += [f"count({m}) AS {m}_count", f"round(avg({m}), 8) AS {m}_mean", f"round(stddev_pop({m}), 8) AS {m}_stdev",
                 f"round(max({m}), 8) AS {m}_max", f"round(min({m}), 8) AS {m}_min"]
    return f"SELECT {key}, " + ", ".join(cols) + f" FROM {src} GROUP BY {key}"


def _round_stats(df, key):
    return df.select(key, *[R(F.col(c)).alias(c) if not c.endswith("_count") else F.col(c)
                            for c in df.columns if c != key])


@query("season_delta_by_age", _sql(_stat_sql("age", "deltas")))
def season_delta_by_age(spark, sf):
    d = SN.season_deltas(_scored(spark, sf))
    return _round_stats(A.stat_counter_wide(d, ["age"], ["value_z", "value_n", "delta_z", "delta_n"]), "age")


@query("season_delta_by_experience", _sql(_stat_sql(
    "exp", "(SELECT * FROM withexp WHERE name NOT IN (SELECT name FROM withexp WHERE year = (SELECT min(year) FROM withexp)))")))
def season_delta_by_experience(spark, sf):
    d = SN.with_experience(SN.season_deltas(_scored(spark, sf)))
    d = SN.exclude_first_year(d)
    return _round_stats(A.stat_counter_wide(d, ["exp"], ["value_z", "value_n", "delta_z", "delta_n"]), "exp")


@query("season_stat_counter", _sql("""
SELECT year, metric, count(v) AS count, round(avg(v), 8) AS mean, round(stddev_pop(v), 8) AS stdev,
       round(max(v), 8) AS max, round(min(v), 8) AS min, count(*) - count(v) AS missing
FROM (SELECT year, unnest(['fga', 'fgp', 'fta', 'ftp', 'tp', 'trb', 'pts', 'tov']) AS metric,
             unnest([fga, fgp, fta, ftp, tp, trb, pts, tov]) AS v FROM dedup) t GROUP BY year, metric"""))
def season_stat_counter(spark, sf):
    d = SN.dedup_seasons(view(spark, sf, "raw_seasons"))
    s = A.stat_counter(d, ["year"], ["fga", "fgp", "fta", "ftp", "tp", "trb", "pts", "tov"])
    return s.select("year", "metric", "count", *[R(F.col(c)).alias(c) for c in ("mean", "stdev", "max", "min")],
                    "missing")


_PAIR_COLS = ["ztot", "ntot", "zpts"]


@query("prior_year_pairs", _sql("SELECT p2.name, p2.year, " + ", ".join(
    f"round(p1.{c}, 8) AS {c}0, round(p2.{c}, 8) AS {c}, round(p2.{c} - p1.{c}, 8) AS {c}diff" for c in _PAIR_COLS)
    + " FROM players p2 JOIN players p1 ON p1.name = p2.name AND p1.year = p2.year - 1"))
def prior_year_pairs(spark, sf):
    p = SN.prior_pairs(_scored(spark, sf), _PAIR_COLS)
    out = []
    for c in _PAIR_COLS:
        out += [R(F.col(f"{c}0")).alias(f"{c}0"), R(F.col(c)).alias(c), R(F.col(f"{c}diff")).alias(f"{c}diff")]
    return p.select("name", "year", *out)


@query("with_next_year_rows", _sql("""
SELECT name, year, age, exp, round(ztot, 8) AS ztot FROM (
  SELECT name, year, age, exp, value_z AS ztot FROM withexp
  UNION
  SELECT name, year + 1, age + 1, exp + 1, NULL FROM withexp WHERE year = (SELECT max(year) FROM withexp)) t"""))
def with_next_year_rows(spark, sf):
    d = SN.with_experience(_scored(spark, sf).select("name", "year", "age", "ztot"))
    u = SN.add_next_season(d.select("name", "year", "age", "exp", "ztot"))
    return u.select("name", "year", "age", "exp", R(F.col("ztot")).alias("ztot"))


SIMILARITY_RADIUS = 0.35


@query("similar_entities", _sql(f"""
, vecs AS (
  SELECT name, year, CAST(row_number() OVER (PARTITION BY name ORDER BY year) - 1 AS INTEGER) AS experience,
         flatten(list([zfg, zft, ztp, ztrb, ztov, zpts]) OVER (PARTITION BY name ORDER BY year
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS vec
  FROM players WHERE name NOT IN (SELECT name FROM players WHERE year = (SELECT min(year) FROM players))),
scored AS (
  SELECT a.experience, a.year, a.name, b.name AS similar_name,
         sqrt(list_sum(list_transform(list_zip(a.vec, b.vec), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) / sqrt(len(a.vec))
           AS similarity_score
  FROM vecs a JOIN vecs b ON a.experience = b.experience AND a.name <> b.name
  WHERE list_bool_and(list_transform(a.vec, lambda x: x IS NOT NULL))
    AND list_bool_and(list_transform(b.vec, lambda x: x IS NOT NULL)))
SELECT experience, year, name, similar_name, round(similarity_score, 8) AS similarity_score
FROM scored WHERE similarity_score <= {SIMILARITY_RADIUS}""".replace("withexp AS", "withexp AS", 1)))
def similar_entities(spark, sf):
    s = SN.exclude_first_year(_scored(spark, sf))
    v = SN.cumulative_vectors(s)
    out = SN.similar_within_radius(v, SIMILARITY_RADIUS)
    return out.select("experience", "year", "name", "similar_name", rounded("similarity_score", 8).alias("similarity_score"))


_RAW9 = ["tp", "trb", "ast", "stl", "blk", "pts", "tov"]


def _nine_sql() -> str:
    """Scores of all nine statistics (players9) and their year pairs (pairs9: x1 experience, x2 prior value, y, or NULL to predict)."""
    stats = ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in _RAW9)
    z = ", ".join(f"{'-' if c == 'tov' else ''}(CASE WHEN s_{c} <> 0 THEN ({c} - a_{c}) / s_{c} END) AS z{c}" for c in _RAW9)
    rows = "unnest([" + ", ".join(f"'{m}'" for m in SN.NINE) + "]) AS metric, unnest([" + ", ".join(f"p1.{m}" for m in SN.NINE) + "]) AS x2"
    return f"""WITH dedup9 AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY name, year ORDER BY CASE WHEN team = 'TOT' THEN 1 ELSE 0 END DESC,
                                                           team DESC) AS rn FROM raw_seasons9) t WHERE rn = 1),
ys9 AS (SELECT year, avg(fgp) AS a_fgp, avg(ftp) AS a_ftp, {stats} FROM dedup9 GROUP BY year),
p9 AS (SELECT d.name, d.year, d.age, (fgp - a_fgp) * fga AS fg, (ftp - a_ftp) * fta AS ft, {z} FROM dedup9 d JOIN ys9 ON d.year = ys9.year),
yt9 AS (SELECT year, avg(fg) AS a_fg, stddev_pop(fg) AS s_fg, avg(ft) AS a_ft, stddev_pop(ft) AS s_ft FROM p9 GROUP BY year),
players9 AS (SELECT p9.*, age - min(age) OVER (PARTITION BY name) AS exp, CASE WHEN s_fg <> 0 THEN (fg - a_fg) / s_fg END AS zfg,
                    CASE WHEN s_ft <> 0 THEN (ft - a_ft) / s_ft END AS zft FROM p9 JOIN yt9 ON p9.year = yt9.year),
pairs9 AS (
  SELECT p2.name, p2.year, CAST(p2.exp AS DOUBLE) AS x1, {rows}, unnest([{', '.join(f'p2.{m}' for m in SN.NINE)}]) AS y
  FROM players9 p2 JOIN players9 p1 ON p1.name = p2.name AND p1.year = p2.year - 1
  UNION ALL
  SELECT p1.name, p1.year + 1, CAST(p1.exp + 1 AS DOUBLE), {rows}, NULL FROM players9 p1 WHERE p1.year = (SELECT max(year) FROM players9)),
"""


def _models_sql() -> str:
    """Elastic nets on two features by trying the nine sign patterns of the solution, which is unique; the best grid point per metric."""
    grid = ", ".join(f"({i}, {reg}, {fit}, {a})" for i, (reg, fit, a) in enumerate(G.GRID))
    sums = ("count(*) AS n, sum(x1) AS s1, sum(x2) AS s2, sum(y) AS sy, sum(x1 * x1) AS s11, sum(x1 * x2) AS s12, sum(x2 * x2) AS s22, "
            "sum(x1 * y) AS s1y, sum(x2 * y) AS s2y, sum(y * y) AS syy")

    def fits(name: str, source: str, points: str) -> str:
        return f"""
{name}_m AS (SELECT metric, {sums} FROM {source} GROUP BY metric),
{name}_d AS (SELECT *, sqrt((s11 - s1 * s1 / n) / (n - 1)) AS d1, sqrt((s22 - s2 * s2 / n) / (n - 1)) AS d2, sqrt((syy - sy * sy / n) / (n - 1)) AS dy FROM {name}_m),
{name}_g AS (SELECT d.metric, id, reg, fit, alpha, n, s1, s2, sy, d1, d2, dy, CASE WHEN fit THEN 1 ELSE 0 END AS c, reg / dy * alpha AS l1, reg / dy * (1 - alpha) AS l2,
  (s11 - CASE WHEN fit THEN s1 * s1 / n ELSE 0 END) / n / d1 / d1 AS g11, (s22 - CASE WHEN fit THEN s2 * s2 / n ELSE 0 END) / n / d2 / d2 AS g22,
  (s12 - CASE WHEN fit THEN s1 * s2 / n ELSE 0 END) / n / d1 / d2 AS g12, (s1y - CASE WHEN fit THEN s1 * sy / n ELSE 0 END) / n / d1 / dy AS c1,
  (s2y - CASE WHEN fit THEN s2 * sy / n ELSE 0 END) / n / d2 / dy AS c2 FROM {name}_d d JOIN {points}),
{name}_b AS (SELECT *, CASE WHEN u = 0 THEN 0 WHEN v = 0 THEN (c1 - l1 * u) / (g11 + l2)
                            ELSE ((c1 - l1 * u) * (g22 + l2) - (c2 - l1 * v) * g12) / ((g11 + l2) * (g22 + l2) - g12 * g12) END AS b1,
                       CASE WHEN v = 0 THEN 0 WHEN u = 0 THEN (c2 - l1 * v) / (g22 + l2)
                            ELSE ((c2 - l1 * v) * (g11 + l2) - (c1 - l1 * u) * g12) / ((g11 + l2) * (g22 + l2) - g12 * g12) END AS b2
              FROM {name}_g, (VALUES (-1), (0), (1)) AS a(u), (VALUES (-1), (0), (1)) AS e(v)),
{name} AS (SELECT metric, id, reg, fit, alpha, b1 / d1 * dy AS b1, b2 / d2 * dy AS b2, (sy - b1 / d1 * dy * s1 - b2 / d2 * dy * s2) / n * c AS b0 FROM {name}_b
           WHERE CASE WHEN u = 0 THEN abs(c1 - g12 * b2) <= l1 ELSE b1 * u > 0 END AND CASE WHEN v = 0 THEN abs(c2 - g12 * b1) <= l1 ELSE b2 * v > 0 END)"""

    bucket = key_bucket_sql(["name", "year"])
    return f"""told AS (SELECT *, {bucket} < 7500 AS train FROM pairs9 WHERE x1 IS NOT NULL AND x2 IS NOT NULL AND y IS NOT NULL),
grid(id, reg, fit, alpha) AS (VALUES {grid}),
learn AS (SELECT * FROM told WHERE train),{fits('tried', 'learn', 'grid ON true')},
err AS (SELECT t.metric, id, reg, fit, alpha, round(sqrt(avg((y - b0 - b1 * x1 - b2 * x2) * (y - b0 - b1 * x1 - b2 * x2))), 9) AS rmse
        FROM told JOIN tried t ON t.metric = told.metric WHERE NOT train GROUP BY ALL),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY rmse, id) AS k FROM err) q WHERE k = 1),{fits('final', 'told', 'best ON best.metric = d.metric')}"""


def _pairs9(spark, sf):
    """Long rows (name, year, metric, x1 experience, x2 prior value, y): past pairs, and the coming season with y NULL."""
    s = SN.score_seasons(SN.dedup_seasons(view(spark, sf, "raw_seasons9")), raw=_RAW9, scores=SN.NINE)
    s = SN.with_experience(s.select("name", "year", "age", *SN.NINE))
    s = cut_lineage(SN.add_next_season(s))
    prior = s.select("name", (F.col("year") + 1).alias("year"), *[F.col(c).alias(f"{c}0") for c in SN.NINE])
    pairs = s.join(prior, ["name", "year"])
    line = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"{m}0").alias("x2"), F.col(m).alias("y")) for m in SN.NINE])
    last = s.agg(F.max("year")).first()[0]
    long = pairs.select("name", "year", F.col("exp").cast("double").alias("x1"), F.explode(line).alias("_l")).select("name", "year", "x1", "_l.*")
    return cut_lineage(long), last


@query("season_nine_scores", with_views(["raw_seasons9"], _nine_sql() + "t9 AS (SELECT *, " + " + ".join(SN.NINE) + """ AS ztot,
  """ + ", ".join(f"greatest(abs(max({c}) OVER w), abs(min({c}) OVER w)) AS m_{c}" for c in SN.NINE) + """
  FROM players9 WINDOW w AS (PARTITION BY year))
SELECT name, year, round(ztot, 8) AS ztot, """ + ", ".join(f"round(CASE WHEN m_{c} <> 0 THEN {c} / m_{c} END, 8) AS n{c[1:]}" for c in SN.NINE) + " FROM t9"))
def season_nine_scores(spark, sf):
    """All nine normalised scores and the total of the nine z-scores."""
    s = SN.score_seasons(SN.dedup_seasons(view(spark, sf, "raw_seasons9")), raw=_RAW9, scores=SN.NINE)
    return s.select("name", "year", R(F.col("ztot")).alias("ztot"), *[R(F.col(f"n{c[1:]}")).alias(f"n{c[1:]}") for c in SN.NINE])


@query("metric_models", with_views(["raw_seasons9"], _nine_sql() + _models_sql() + """
SELECT final.metric, reg AS reg_param, fit AS fit_intercept, alpha AS elastic_net, rmse AS valid_rmse, round(b0, 6) + 0.0 AS b0, round(b1, 6) + 0.0 AS b1,
       round(b2, 6) + 0.0 AS b2 FROM final JOIN err USING (metric, id, reg, fit, alpha)"""))
def metric_models(spark, sf):
    """The best of 30 elastic nets per metric (experience and prior value), tuned on a hash split, fitted on all past pairs."""
    long, last = _pairs9(spark, sf)
    m = G.grid_search(long.where(F.col("year") <= F.lit(last)), "metric", ["x1", "x2"], "y", key_bucket(["name", "year"]) < 7500)
    return m.select("metric", "reg_param", "fit_intercept", "elastic_net", "valid_rmse", *[(R(F.col("coefficients")[i], 6) + 0.0).alias(f"b{i}") for i in range(3)])


@query("sum_metric_predictions", with_views(["raw_seasons9"], _nine_sql() + _models_sql() + """
SELECT name, year, round(sum(b0 + b1 * x1 + b2 * x2), 6) AS predicted_total, count(*) AS n_metrics
FROM pairs9 JOIN final USING (metric) WHERE year = (SELECT max(year) FROM pairs9) AND x2 IS NOT NULL GROUP BY name, year"""))
def sum_metric_predictions(spark, sf):
    """The coming season's total of every entity seen in the last year: nine models' predictions of rows they were not fitted on."""
    long, last = _pairs9(spark, sf)
    models = G.grid_search(long.where(F.col("y").isNotNull()), "metric", ["x1", "x2"], "y", key_bucket(["name", "year"]) < 7500)
    rows = long.where((F.col("year") == F.lit(last)) & F.col("x2").isNotNull()).join(models.select("metric", "coefficients"), "metric")
    return rows.groupBy("name", "year").agg(R(F.sum(G.predicted(["x1", "x2"])), 6).alias("predicted_total"), F.count(F.lit(1)).alias("n_metrics"))


@query("season_mean_by_year", _sql("SELECT year, count(*) AS n, " + ", ".join(
    f"round(avg({c}), 8) AS avg_{c}" for c in ["fga", "fgp", "pts", "tov"]) + " FROM dedup GROUP BY year"))
def season_mean_by_year(spark, sf):
    d = SN.dedup_seasons(view(spark, sf, "raw_seasons"))
    return d.groupBy("year").agg(F.count(F.lit(1)).alias("n"),
                                 *[R(F.avg(c)).alias(f"avg_{c}") for c in ["fga", "fgp", "pts", "tov"]])


@query("top_scores_last_year", _sql("""
SELECT name, year, round(ztot, 8) AS ztot FROM players WHERE year = (SELECT max(year) FROM players) AND ztot IS NOT NULL
ORDER BY ztot DESC, name LIMIT 10"""))
def top_scores_last_year(spark, sf):
    """Top 10 entities by total score in the latest year (the limit is the report)."""
    s = _scored(spark, sf)
    last = s.agg(F.max("year")).first()[0]
    t = W.top_k(s.where(F.col("ztot").isNotNull()), "ztot", 10, where=F.col("year") == F.lit(last))
    return t.orderBy(F.col("ztot").desc(), "name").limit(10).select("name", "year", R(F.col("ztot")).alias("ztot"))
