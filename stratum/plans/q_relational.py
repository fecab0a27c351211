"""Relational queries over the derived views: scans, filters, joins, grouped
aggregates, pivots, scalar functions (S/P/J/A/U/O/F families)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.functions import scalar as S
from stratum.operators import aggregates as A
from stratum.operators import clean as C
from stratum.operators import joins as J
from stratum.operators import ml_geometry as G
from stratum.plans.registry import query
from stratum.plans.views import view, with_views
from stratum.session import load


def R(c, d: int = 8):
    return F.round(c, d)


# ---------------------------------------------------------------- flights ----
@query("carrier_delay_summary", with_views(["flights"], """
SELECT origin, count(*) AS num_departures, round(avg(dep_delay), 8) AS avg_dep_delay
FROM flights WHERE dest = 'NATION_7' GROUP BY origin ORDER BY avg_dep_delay"""))
def carrier_delay_summary(spark, sf):
    f = view(spark, sf, "flights")
    out = A.group_summary(f, ["origin"], "dep_delay", where=F.col("dest") == "NATION_7",
                          count_name="num_departures", mean_name="avg_dep_delay")
    return out.withColumn("avg_dep_delay", R(F.col("avg_dep_delay"))).orderBy("avg_dep_delay")


@query("carrier_delay_summary_sql", with_views(["flights"], """
SELECT origin, count(*) AS num_departures, round(avg(dep_delay), 8) AS avg_dep_delay
FROM flights WHERE dest = 'NATION_3' GROUP BY origin ORDER BY avg_dep_delay"""))
def carrier_delay_summary_sql(spark, sf):
    """The same chain through the SQL entry (temp view + spark.sql)."""
    return spark.sql("""
        SELECT origin, count(*) AS num_departures, round(avg(dep_delay), 8) AS avg_dep_delay
        FROM {flights} WHERE dest = 'NATION_3' GROUP BY origin ORDER BY avg_dep_delay""",
                     flights=view(spark, sf, "flights"))


@query("flights_by_year", with_views(["flights"], """
SELECT year, count(*) AS n_flights FROM flights GROUP BY year ORDER BY year"""))
def flights_by_year(spark, sf):
    f = view(spark, sf, "flights")
    return f.groupBy("year").agg(F.count(F.lit(1)).alias("n_flights")).orderBy("year")


@query("flights_by_year_carrier", with_views(["flights"], """
SELECT year, carrier, count(*) AS n_flights FROM flights GROUP BY year, carrier ORDER BY year, carrier"""))
def flights_by_year_carrier(spark, sf):
    f = view(spark, sf, "flights")
    return f.groupBy("year", "carrier").agg(F.count(F.lit(1)).alias("n_flights")).orderBy("year", "carrier")


@query("flights_by_month_range", with_views(["flights"], """
SELECT year, month, count(*) AS n_flights, CAST(make_date(year, month, 1) AS VARCHAR) AS month_start
FROM flights WHERE year >= 1996 AND month BETWEEN 3 AND 8 GROUP BY year, month ORDER BY year DESC, month DESC"""))
def flights_by_month_range(spark, sf):
    f = view(spark, sf, "flights")
    return (f.where((F.col("year") >= 1996) & F.col("month").between(3, 8))
            .groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_flights"))
            .withColumn("month_start", S.first_of_month("year", "month").cast("string"))
            .orderBy(F.col("year").desc(), F.col("month").desc()))


@query("route_counts_scaled", with_views(["flights", "airports"], """
SELECT r.origin, r.dest, r.n, o.longitude AS origin_lon, o.latitude AS origin_lat,
       d.longitude AS dest_lon, d.latitude AS dest_lat,
       CAST(greatest(1, round(r.n / max(r.n) OVER () * 100)) AS INTEGER) AS intensity
FROM (SELECT origin, dest, count(*) AS n FROM flights GROUP BY origin, dest) r
JOIN airports o ON r.origin = o.iata JOIN airports d ON r.dest = d.iata"""))
def route_counts_scaled(spark, sf):
    f = view(spark, sf, "flights")
    routes = f.groupBy("origin", "dest").agg(F.count(F.lit(1)).alias("n"))
    ap = view(spark, sf, "airports").select("iata", "longitude", "latitude")
    j = J.double_lookup(routes, ap, "iata", ["origin", "dest"], ["o_", "d_"])
    j = j.select("origin", "dest", "n", F.col("o_longitude").alias("origin_lon"), F.col("o_latitude").alias("origin_lat"),
                 F.col("d_longitude").alias("dest_lon"), F.col("d_latitude").alias("dest_lat"))
    return A.scaled_intensity(j, "n")


@query("great_circle_points", with_views(["flights", "airports"], """
SELECT origin, dest, i, round(lon, 6) AS lon, round(lat, 6) AS lat FROM (
  SELECT origin, dest, i,
         degrees(atan2(y, x)) AS lon, degrees(atan2(z, sqrt(x * x + y * y))) AS lat
  FROM (
    SELECT origin, dest, i,
           a * cos(p1) * cos(l1) + b * cos(p2) * cos(l2) AS x,
           a * cos(p1) * sin(l1) + b * cos(p2) * sin(l2) AS y,
           a * sin(p1) + b * sin(p2) AS z
    FROM (
      SELECT origin, dest, i, p1, l1, p2, l2,
             CASE WHEN d = 0 THEN 1 - f ELSE sin((1 - f) * d) / sin(d) END AS a,
             CASE WHEN d = 0 THEN f ELSE sin(f * d) / sin(d) END AS b
      FROM (
        SELECT origin, dest, i, p1, l1, p2, l2, CAST(i AS DOUBLE) / 101.0 AS f,
               2 * asin(sqrt(least(1.0, pow(sin((p2 - p1) / 2), 2) + cos(p1) * cos(p2) * pow(sin((l2 - l1) / 2), 2)))) AS d
        FROM (
          SELECT r.origin, r.dest, radians(o.latitude) AS p1, radians(o.longitude) AS l1,
                 radians(d.latitude) AS p2, radians(d.longitude) AS l2
          FROM (SELECT DISTINCT origin, dest FROM flights) r
          JOIN airports o ON r.origin = o.iata JOIN airports d ON r.dest = d.iata
        ) g, (SELECT CAST(range AS INTEGER) AS i FROM range(0, 102)) s
      ) t1
    ) t2
  ) t3
) t4"""))
def great_circle_points(spark, sf):
    # the routes of the flights view: pairs of nation keys are made distinct before any name is joined
    li = load(spark, sf, "lineitem").join(load(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    ends = (li.join(load(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(load(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(load(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select("s_nationkey", "c_nationkey").distinct())
    nation = load(spark, sf, "nation")
    routes = (ends.join(nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("origin")), "s_nationkey")
              .join(nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("dest")), "c_nationkey").select("origin", "dest").distinct())
    ap = view(spark, sf, "airports").select("iata", "longitude", "latitude")
    j = J.double_lookup(routes, ap, "iata", ["origin", "dest"], ["o_", "d_"])
    pts = j.select("origin", "dest", F.explode(S.great_circle_points("o_longitude", "o_latitude",
                                                                      "d_longitude", "d_latitude", 100)).alias("p"))
    return pts.select("origin", "dest", "p.i", R(F.col("p.lon"), 6).alias("lon"), R(F.col("p.lat"), 6).alias("lat"))


GAIN_EDGES = [-100, -10, 0, 10, 20, 30, 40, 50, 100]
# Bucket labels of the delay-gain histogram, in edge order.
GAIN_LABELS = ['-100 to -10', '-10 to 0', '0 to 10', '10 to 20', '20 to 30', '30 to 40', '40 to 50', '50 to 100']


def _gain_case(x: str) -> str:
    parts = []
    for i, (lo, hi, lab) in enumerate(zip(GAIN_EDGES, GAIN_EDGES[1:], GAIN_LABELS)):
        up = f"{x} <= {hi}" if i == len(GAIN_LABELS) - 1 else f"{x} < {hi}"
        parts.append(f"WHEN {x} >= {lo} AND {up} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


@query("gain_buckets", with_views(["flights"], f"""
SELECT year, carrier, {_gain_case('gain')} AS bucket, count(*) AS n
FROM (SELECT year, carrier, dep_delay - arr_delay AS gain FROM flights
      WHERE dep_delay IS NOT NULL AND arr_delay IS NOT NULL) t
GROUP BY 1, 2, 3"""))
def gain_buckets(spark, sf):
    f = view(spark, sf, "flights")
    d = C.drop_incomplete(f.select("year", "carrier", "dep_delay", "arr_delay"), ["dep_delay", "arr_delay"])
    d = d.select("year", "carrier", (F.col("dep_delay") - F.col("arr_delay")).alias("gain"))
    b = C.add_bucket(d, "gain", GAIN_EDGES, GAIN_LABELS)
    return b.groupBy("year", "carrier", "bucket").agg(F.count(F.lit(1)).alias("n"))


@query("arrival_clock", with_views(["flights"], """
SELECT l_orderkey, l_linenumber, sched_arr_time, dep_delay,
       CAST(floor(m / 60) * 100 + m % 60 AS INTEGER) AS pred_arr_time
FROM (SELECT *, ((floor(sched_arr_time / 100) * 60 + sched_arr_time % 100 + floor(dep_delay * 1.02 - 5.9)) % 1440 + 1440) % 1440 AS m
      FROM flights WHERE dep_delay IS NOT NULL) t"""))
def arrival_clock(spark, sf):
    f = view(spark, sf, "flights").where(F.col("dep_delay").isNotNull())
    return f.select("l_orderkey", "l_linenumber", "sched_arr_time", "dep_delay",
                    S.predicted_arrival("sched_arr_time", "dep_delay").alias("pred_arr_time"))


@query("flight_features", with_views(["flights"], """
SELECT l_orderkey, l_linenumber, concat(carrier, flight) AS flight_code, arr_delay <= 0 AS on_time,
       CAST(floor(sched_arr_time / 100) AS INTEGER) AS arr_hour
FROM flights"""))
def flight_features(spark, sf):
    f = view(spark, sf, "flights")
    return f.select("l_orderkey", "l_linenumber", F.concat("carrier", "flight").alias("flight_code"),
                    (F.col("arr_delay") <= 0).alias("on_time"),
                    F.floor(F.col("sched_arr_time") / 100).cast("int").alias("arr_hour"))


@query("distinct_carriers", with_views(["flights"], """
SELECT count(*) AS n_rows, count(DISTINCT carrier) AS num_carriers, count(DISTINCT origin) AS num_origins FROM flights"""))
def distinct_carriers(spark, sf):
    f = view(spark, sf, "flights")
    return f.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("carrier").alias("num_carriers"),
                 F.count_distinct("origin").alias("num_origins"))


_PROFILE_COLS = ["dep_delay", "arr_delay", "sched_arr_time"]


@query("column_profile", with_views(["flights"], " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 8) AS mean, round(stddev_samp({c}), 8) AS stddev,
       CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM flights""" for c in _PROFILE_COLS)))
def column_profile(spark, sf):
    from stratum.operators.profile import describe_long

    f = view(spark, sf, "flights")
    d = describe_long(f, _PROFILE_COLS)
    return d.select("column_name", "n", R(F.col("mean")).alias("mean"), R(F.col("stddev")).alias("stddev"), "min", "max")


@query("on_time_by_origin_no_nulls", with_views(["flights"], """
SELECT origin, count(*) AS n, round(avg(CASE WHEN arr_delay <= 0 THEN 1.0 ELSE 0.0 END), 8) AS on_time_rate
FROM flights WHERE dep_delay IS NOT NULL AND arr_delay IS NOT NULL GROUP BY origin"""))
def on_time_by_origin_no_nulls(spark, sf):
    f = C.drop_incomplete(view(spark, sf, "flights"), ["dep_delay", "arr_delay"])
    return A.fraction_where(f, ["origin"], F.col("arr_delay") <= 0, "on_time_rate").select(
        "origin", "n", R(F.col("on_time_rate")).alias("on_time_rate"))


@query("top_delayed_routes", with_views(["flights"], """
SELECT origin, dest, round(avg(arr_delay), 8) AS avg_arr_delay FROM flights
GROUP BY origin, dest ORDER BY avg_arr_delay DESC, origin, dest LIMIT 10"""))
def top_delayed_routes(spark, sf):
    f = view(spark, sf, "flights")
    g = f.groupBy("origin", "dest").agg(R(F.avg("arr_delay")).alias("avg_arr_delay"))
    return g.orderBy(F.col("avg_arr_delay").desc(), "origin", "dest").limit(10)


# ------------------------------------------------------------ maintenance ----
@query("monthly_cost", with_views(["maintenance"], """
SELECT strftime(date, '%Y%m') AS month, CAST(sum(cost) AS BIGINT) AS total_cost, count(*) AS n
FROM maintenance GROUP BY 1 ORDER BY 1"""))
def monthly_cost(spark, sf):
    m = view(spark, sf, "maintenance")
    return (m.groupBy(F.date_format("date", "yyyyMM").alias("month"))
            .agg(F.sum("cost").cast("long").alias("total_cost"), F.count(F.lit(1)).alias("n")).orderBy("month"))


# The SQL form of the default cost rule in stratum.operators.savings (oracle side).
_PRED_COST_SQL = """CASE WHEN maintenance_type = predicted_type THEN
    CASE maintenance_type WHEN 'Healthy' THEN 0 WHEN 'Preventive' THEN cost WHEN 'Corrective' THEN 30000 END
  ELSE cost END"""


@query("savings_by_month", with_views(["maintenance"], f"""
SELECT strftime(date, '%Y%m') AS month, CAST(sum(cost) AS BIGINT) AS actual_cost,
       CAST(sum(predicted_cost) AS BIGINT) AS predicted_cost, CAST(sum(cost - predicted_cost) AS BIGINT) AS predicted_savings
FROM (SELECT date, cost, {_PRED_COST_SQL} AS predicted_cost FROM maintenance) t GROUP BY 1"""))
def savings_by_month(spark, sf):
    from stratum.operators.savings import monthly_savings

    return monthly_savings(view(spark, sf, "maintenance"))


@query("savings_total_pct", with_views(["maintenance"], f"""
SELECT CAST(sum(cost - predicted_cost) AS BIGINT) AS total_savings,
       round(sum(cost - predicted_cost) / sum(cost) * 100, 8) AS total_savings_pct
FROM (SELECT date, cost, {_PRED_COST_SQL} AS predicted_cost FROM maintenance) t"""))
def savings_total_pct(spark, sf):
    from stratum.operators.savings import monthly_savings, total_savings

    t = total_savings(monthly_savings(view(spark, sf, "maintenance")))
    return t.select("total_savings", R(F.col("total_savings_pct")).alias("total_savings_pct"))


@query("readings_same_day_or_prev_day", with_views(["maintenance", "readings", "tag_mappings"], """
WITH daily AS (
  SELECT CAST(record_time AS DATE) AS day, sensor_name, avg(value) AS avg_value
  FROM readings JOIN tag_mappings USING (tag_id) GROUP BY 1, 2)
SELECT maint_id, CAST(date AS VARCHAR) AS date, maintenance_type, sensor_name, round(avg_value, 8) AS avg_value, 0 AS lag_days
FROM maintenance JOIN daily ON date = day WHERE maintenance_type <> 'Corrective'
UNION ALL
SELECT maint_id, CAST(date AS VARCHAR) AS date, maintenance_type, sensor_name, round(avg_value, 8) AS avg_value, 1 AS lag_days
FROM maintenance JOIN daily ON date = day + 1 WHERE maintenance_type = 'Corrective'"""))
def readings_same_day_or_prev_day(spark, sf):
    from stratum.operators.sensors import daily_sensor_means

    """Readings of the same day for all types but corrective ones, which take the day before (two branches, one union)."""
    m = view(spark, sf, "maintenance").select("maint_id", "date", "maintenance_type")
    corrective = F.col("maintenance_type") == "Corrective"
    daily = daily_sensor_means(view(spark, sf, "readings"), view(spark, sf, "tag_mappings"))
    same = m.where(~corrective)
    same = same.join(daily, same["date"] == daily["day"]).drop("day").withColumn("lag_days", F.lit(0))
    prev = J.shifted_date_join(m.where(corrective), daily, "date", "day", 1).drop("day").withColumn("lag_days", F.lit(1))
    u = same.unionByName(prev)
    return u.select("maint_id", F.col("date").cast("string").alias("date"), "maintenance_type", "sensor_name",
                    R(F.col("avg_value")).alias("avg_value"), "lag_days")


_SENSORS = [f"Sensor_{i}" for i in range(10)]


@query("sensor_pivot_daily", with_views(["readings", "tag_mappings"], """
SELECT CAST(CAST(record_time AS DATE) AS VARCHAR) AS day, """ + ", ".join(
    f"round(avg(round(value, 2)) FILTER (WHERE sensor_name = '{s}'), 8) AS {s}" for s in _SENSORS) + """
FROM readings JOIN tag_mappings USING (tag_id) GROUP BY 1"""))
def sensor_pivot_daily(spark, sf):
    from stratum.operators.sensors import enrich

    r = enrich(view(spark, sf, "readings"), view(spark, sf, "tag_mappings"))
    r = r.withColumn("day", F.to_date("record_time").cast("string"))
    p = A.pivot_mean(r, ["day"], "sensor_name", _SENSORS, "value", digits=2)
    return p.select("day", *[R(F.col(s)).alias(s) for s in _SENSORS])


@query("sensor_bucket30s_pivot", with_views(["readings", "tag_mappings"], """
SELECT CAST(to_timestamp(floor(epoch(record_time) / 30 + 0.5) * 30) AS TIMESTAMP) AS bucket, """ + ", ".join(
    f"round(avg(value) FILTER (WHERE sensor_name = '{s}'), 8) AS {s}" for s in _SENSORS) + """
FROM readings JOIN tag_mappings USING (tag_id) GROUP BY 1"""))
def sensor_bucket30s_pivot(spark, sf):
    from stratum.operators.sensors import enrich

    r = enrich(view(spark, sf, "readings"), view(spark, sf, "tag_mappings"))
    r = r.withColumn("bucket", S.round_to_nearest_seconds("record_time", 30))
    p = A.pivot_mean(r, ["bucket"], "sensor_name", _SENSORS, "value")
    return p.select("bucket", *[R(F.col(s)).alias(s) for s in _SENSORS])


# ------------------------------------------------------------ cover/churn ----
@query("unhot_index", with_views(["cover"], """
SELECT p_partkey, elevation, slope, CAST(cover_type AS INTEGER) AS cover_type,
       CAST(CASE WHEN w0 = 1.0 THEN 0 WHEN w1 = 1.0 THEN 1 WHEN w2 = 1.0 THEN 2 WHEN w3 = 1.0 THEN 3 ELSE -1 END AS INTEGER) AS wilderness
FROM cover"""))
def unhot_index(spark, sf):
    c = view(spark, sf, "cover")
    return C.add_unhot(c, ["w0", "w1", "w2", "w3"], "wilderness").withColumn("cover_type", F.col("cover_type").cast("int"))


_CLASSES = list(range(7))


@query("confusion_matrix", with_views(["cover"], """
SELECT CAST(cover_type AS INTEGER) AS label, """ + ", ".join(
    f"count(*) FILTER (WHERE prediction = {k}) AS \"{k}\"" for k in _CLASSES) + """
FROM (SELECT cover_type, CAST(floor(elevation) AS INTEGER) % 7 AS prediction FROM cover) t GROUP BY 1"""))
def confusion_matrix(spark, sf):
    c = view(spark, sf, "cover").select(F.col("cover_type").cast("int").alias("label"),
                                         (F.floor("elevation").cast("int") % 7).alias("prediction"))
    return A.confusion_matrix(c, "label", "prediction", _CLASSES)


@query("recode_and_split", with_views(["churn"], """
SELECT c_custkey, CASE WHEN state = 'BUILDING' THEN state ELSE 'OTHER' END AS state, churned,
       CASE WHEN row_number() OVER (ORDER BY c_custkey) <= 1000 THEN 'train' ELSE 'test' END AS part
FROM churn"""))
def recode_and_split(spark, sf):
    c = C.recode_values(view(spark, sf, "churn"), "state", "BUILDING", "OTHER").select("c_custkey", "state", "churned")
    head, rest = C.head_rest_split(c, ["c_custkey"], 1000)
    return head.withColumn("part", F.lit("train")).unionByName(rest.withColumn("part", F.lit("test")))


# --------------------------------------------------------------- sessions ----
@query("label_counts", with_views(["sessions"], """
SELECT label, count(*) AS n FROM sessions GROUP BY label ORDER BY n DESC, label"""))
def label_counts(spark, sf):
    return A.value_counts(view(spark, sf, "sessions"), "label").orderBy(F.col("n").desc(), "label")


_CENTROID_CTE = """
cents AS (
  SELECT label AS cluster, list(m ORDER BY i) AS centroid FROM (
    SELECT label, i, avg(CAST(x AS DOUBLE)) AS m
    FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM sessions) e
    GROUP BY label, i) g GROUP BY label),
dists AS (
  SELECT s.vec_id, s.label, c.cluster,
         list_sum(list_transform(list_zip(s.embedding, c.centroid), lambda p: (CAST(p[1] AS DOUBLE) - p[2]) * (CAST(p[1] AS DOUBLE) - p[2]))) AS d
  FROM sessions s, cents c),
assigned AS (
  SELECT vec_id, label, arg_min(cluster, d) AS cluster, min(d) AS sqdist FROM dists GROUP BY vec_id, label)"""


def _assigned(spark, sf):
    s = view(spark, sf, "sessions")
    cents = G.collect_centroids(G.group_centroids(s, "label", "embedding"), "label")
    return G.assign_clusters(s, "embedding", cents)


@query("cluster_label_entropy", with_views(["sessions"], "," + _CENTROID_CTE + """
SELECT round(sum(n_c * ln(n_c) - s) / sum(n_c), 8) AS entropy FROM (
  SELECT cluster, sum(n) AS n_c, sum(n * ln(n)) AS s FROM (
    SELECT cluster, label, count(*) AS n FROM assigned GROUP BY 1, 2) a GROUP BY cluster) b"""))
def cluster_label_entropy(spark, sf):
    a = _assigned(spark, sf)
    return A.cluster_entropy(a, "cluster", "label").select(R(F.col("entropy")).alias("entropy"))


@query("centroid_anomalies", with_views(["sessions"], "," + _CENTROID_CTE + """
SELECT vec_id, label, cluster, round(sqdist, 6) AS sqdist FROM assigned
WHERE sqdist >= (SELECT min(sqdist) FROM (SELECT sqdist FROM assigned ORDER BY sqdist DESC LIMIT 100) t)"""))
def centroid_anomalies(spark, sf):
    a = _assigned(spark, sf)
    far = G.farthest_points(a, "sqdist", 100)
    return far.select("vec_id", "label", "cluster", R(F.col("sqdist"), 6).alias("sqdist"))


@query("shift_codes", with_views(["cover"], """
SELECT CAST(slope % 4 AS DOUBLE) AS size_code, CAST(cover_type AS DOUBLE) AS cover_code, count(*) AS n
FROM cover GROUP BY 1, 2"""))
def shift_codes(spark, sf):
    """1-based category codes shifted to start at zero (typed double for ML)."""
    c = view(spark, sf, "cover").select((F.col("slope") % 4 + 1).alias("size_code"),
                                        (F.col("cover_type") + 1).alias("cover_code"))
    s = C.shift_codes(c, ["size_code", "cover_code"], 1)
    return s.groupBy("size_code", "cover_code").agg(F.count(F.lit(1)).alias("n"))


@query("sample_conditional_counts", with_views(["samples"], """
SELECT count(*) AS n_samples, count(*) FILTER (WHERE is_female) AS n_female,
       count(*) FILTER (WHERE purple_hair) AS n_purple, count(*) FILTER (WHERE caffeine > 5) AS n_high_caffeine,
       array_to_string(list_sort(list_distinct(list(super_population))), ',') AS populations FROM samples"""))
def sample_conditional_counts(spark, sf):
    """Several predicate counts and the set of populations in one aggregate pass."""
    s = view(spark, sf, "samples")
    extra = {"n_samples": F.count(F.lit(1)),
             "populations": F.array_join(F.sort_array(F.collect_set("super_population")), ",")}
    return A.conditional_counts(s, {"n_female": F.col("is_female"), "n_purple": F.col("purple_hair"),
                                    "n_high_caffeine": F.col("caffeine") > 5}, extra)


@query("nations_per_region", """
SELECT r_name, array_to_string(list_sort(list_distinct(list(n_name))), ',') AS nations, count(*) AS n
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def nations_per_region(spark, sf):
    """Distinct values collected per group (sorted set, joined to a string)."""
    region = load(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    n = J.lookup_join(load(spark, sf, "nation"), region, "n_regionkey")
    return n.groupBy("r_name").agg(F.array_join(F.sort_array(F.collect_set("n_name")), ",").alias("nations"),
                                   F.count(F.lit(1)).alias("n"))


@query("sensor_daily_sums", with_views(["readings", "tag_mappings"], """
SELECT CAST(CAST(record_time AS DATE) AS VARCHAR) AS day, round(sum(value * (1 + tag_id % 3)), 6) AS total FROM readings GROUP BY 1"""))
def sensor_daily_sums(spark, sf):
    """Ten per-metric tables sharing a key summed per key (union + one aggregate, not an N-way join)."""
    r = view(spark, sf, "readings").withColumn("day", F.to_date("record_time").cast("string"))
    frames = [r.where(F.col("tag_id") == k).select("day", (F.col("value") * (1 + k % 3)).alias(f"m{k}")) for k in range(10)]
    s = J.sum_by_key(frames, "day", [f"m{k}" for k in range(10)], out="total")
    return s.select("day", R(F.col("total"), 6).alias("total"))


@query("pixel_scaling", with_views(["sessions"], """
SELECT label, count(*) AS n, round(sum(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * (1.0 / 255.0) + -0.5))), 6) AS sum_scaled
FROM sessions GROUP BY label"""))
def pixel_scaling(spark, sf):
    """Element-wise x/255 − 0.5 over array features."""
    s = view(spark, sf, "sessions").withColumn("scaled", S.scale_pixels("embedding"))
    return s.groupBy("label").agg(F.count(F.lit(1)).alias("n"), R(F.sum(S.array_sum("scaled")), 6).alias("sum_scaled"))
