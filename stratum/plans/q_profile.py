"""Distribution-profile queries: histograms, 2-D bins, box statistics, density,
correlation matrix, Kendall τ-b."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators import profile as P
from stratum.operators.sensors import enrich
from stratum.plans.registry import query
from stratum.plans.views import view, with_views


def R(c, d: int = 8):
    return F.round(c, d)


_SENSORS = [f"Sensor_{i}" for i in range(10)]


@query("histogram_value", with_views(["readings"], """
, b AS (SELECT min(value) AS lo, max(value) AS hi FROM readings),
c AS (SELECT CAST(least(floor((value - lo) * 20.0 / (hi - lo)), 19) AS INTEGER) AS bin, count(*) AS n
      FROM readings, b WHERE value >= lo AND value <= hi GROUP BY 1)
SELECT bin, round(lo + bin * ((hi - lo) / 20), 8) AS lower, round(lo + (bin + 1) * ((hi - lo) / 20), 8) AS upper, n,
       round(n / (sum(n) OVER () * ((hi - lo) / 20)), 8) AS density FROM c, b"""))
def histogram_value(spark, sf):
    h = P.histogram(view(spark, sf, "readings"), "value", 20)
    return h.select("bin", R(F.col("lower")).alias("lower"), R(F.col("upper")).alias("upper"), "n",
                    R(F.col("density")).alias("density"))


@query("hist2d_delays", with_views(["flights"], """
, b AS (SELECT min(dep_delay) AS x0, max(dep_delay) AS x1, min(arr_delay) AS y0, max(arr_delay) AS y1 FROM flights)
SELECT CAST(least(floor((dep_delay - x0) * 20.0 / (x1 - x0)), 19) AS INTEGER) AS xbin,
       CAST(least(floor((arr_delay - y0) * 20.0 / (y1 - y0)), 19) AS INTEGER) AS ybin, count(*) AS n
FROM flights, b WHERE dep_delay IS NOT NULL AND arr_delay IS NOT NULL GROUP BY 1, 2"""))
def hist2d_delays(spark, sf):
    # the flights view is a 7-way join: materialise the two columns once for the range and binning passes
    return P.hist2d(view(spark, sf, "flights"), "dep_delay", "arr_delay", 20, materialize=True)


@query("boxplot_stats", with_views(["readings", "tag_mappings"], """
SELECT sensor_name, round(min(value), 8) AS min, round(quantile_cont(value, 0.25), 8) AS q1,
       round(quantile_cont(value, 0.5), 8) AS median, round(quantile_cont(value, 0.75), 8) AS q3,
       round(max(value), 8) AS max
FROM readings JOIN tag_mappings USING (tag_id) GROUP BY sensor_name"""))
def boxplot_stats(spark, sf):
    r = enrich(view(spark, sf, "readings"), view(spark, sf, "tag_mappings"))
    b = P.box_stats(r, ["sensor_name"], "value")
    return b.select("sensor_name", *[R(F.col(c)).alias(c) for c in ("min", "q1", "median", "q3", "max")])


@query("kde_grid", with_views(["readings"], """
, s AS (SELECT value AS x FROM readings WHERE value IS NOT NULL),
st AS (SELECT min(x) AS mn, max(x) AS mx, count(*) AS n, stddev_samp(x) AS sd,
              quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM s),
bw AS (SELECT *, 0.9 * (CASE WHEN q3 - q1 > 0 THEN least(sd, (q3 - q1) / 1.34) ELSE sd END) * pow(n, -0.2) AS h FROM st),
g AS (SELECT *, mn - 3.0 * h AS lo, mx + 3.0 * h AS hi FROM bw),
g2 AS (SELECT *, (hi - lo) / 511 AS delta FROM g),
pos AS (SELECT (x - lo) / delta AS p FROM s, g2),
w AS (SELECT CAST(floor(p) AS INTEGER) AS k, 1 - (p - floor(p)) AS w FROM pos
      UNION ALL SELECT CAST(floor(p) AS INTEGER) + 1 AS k, p - floor(p) AS w FROM pos),
binned AS (SELECT k, sum(w) AS w FROM w GROUP BY k HAVING k < 512),
grid AS (SELECT CAST(range AS INTEGER) AS gi FROM range(0, 512))
SELECT gi AS i, round(lo + gi * delta, 8) AS x,
       round(sum(w * exp(-0.5 * ((gi - k) * delta / h) * ((gi - k) * delta / h)) / sqrt(2 * pi())) / (n * h), 8) AS density
FROM grid, binned, g2 GROUP BY gi, lo, delta, n, h"""))
def kde_grid(spark, sf):
    k = P.kde_grid(view(spark, sf, "readings"), "value", n=512)
    return k.select("i", R(F.col("x")).alias("x"), R(F.col("density")).alias("density"))


def _hourly(spark, sf):
    r = enrich(view(spark, sf, "readings"), view(spark, sf, "tag_mappings"))
    return r.groupBy(F.date_trunc("hour", "record_time").alias("hr")).pivot("sensor_name", _SENSORS).agg(F.avg("value"))


@query("sensor_correlation_long", with_views(["readings", "tag_mappings"], """
, h AS (SELECT date_trunc('hour', record_time) AS hr, """ + ", ".join(
    f"avg(value) FILTER (WHERE sensor_name = '{s}') AS {s}" for s in _SENSORS) + """
  FROM readings JOIN tag_mappings USING (tag_id) GROUP BY 1)
""" + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 8) AS corr FROM h"
    for i, a in enumerate(_SENSORS) for b in _SENSORS[i + 1:])))
def sensor_correlation_long(spark, sf):
    c = P.correlation_long(_hourly(spark, sf), _SENSORS)
    return c.select("col_a", "col_b", R(F.col("corr")).alias("corr"))


@query("kendall_tau_b", with_views(["churn"], """
, p AS (
  SELECT sum(sign(a.account_balance - b.account_balance) * sign(a.n_calls - b.n_calls)) AS s, count(*) AS n0,
         sum(CASE WHEN a.account_balance = b.account_balance THEN 1 ELSE 0 END) AS n1,
         sum(CASE WHEN a.n_calls = b.n_calls THEN 1 ELSE 0 END) AS n2
  FROM churn a JOIN churn b ON a.c_custkey < b.c_custkey)
SELECT round(CAST(s AS DOUBLE) / sqrt(CAST((n0 - n1) * (n0 - n2) AS DOUBLE)), 8) AS tau_b,
       (SELECT count(*) FROM churn) AS n FROM p"""))
def kendall_tau_b(spark, sf):
    t = P.kendall_tau_b(view(spark, sf, "churn"), "account_balance", "n_calls")
    return t.select(R(F.col("tau_b")).alias("tau_b"), "n")


@query("kendall_tau_b_blocked", with_views(["churn"], """
, p AS (
  SELECT sum(sign(a.account_balance - b.account_balance) * sign(a.n_calls - b.n_calls)) AS s, count(*) AS n0,
         sum(CASE WHEN a.account_balance = b.account_balance THEN 1 ELSE 0 END) AS n1,
         sum(CASE WHEN a.n_calls = b.n_calls THEN 1 ELSE 0 END) AS n2
  FROM churn a JOIN churn b ON a.c_custkey < b.c_custkey)
SELECT round(CAST(s AS DOUBLE) / sqrt(CAST((n0 - n1) * (n0 - n2) AS DOUBLE)), 8) AS tau_b,
       (SELECT count(*) FROM churn) AS n FROM p"""))
def kendall_tau_b_blocked(spark, sf):
    """Kendall tau-b with single-bit digits: the most levels."""
    t = P.kendall_tau_b(view(spark, sf, "churn"), "account_balance", "n_calls", digit_bits=1)
    return t.select(R(F.col("tau_b")).alias("tau_b"), "n")
