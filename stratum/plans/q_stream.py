"""Streaming queries: the events table is the stream source (file stream,
everything available now), checked against the same logic in batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.plans.registry import query
from stratum.plans.views import view, with_views
from stratum.streaming import sensors as ST

_SENSORS = [f"Sensor_{i}" for i in range(10)]

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def _readings_stream(spark, sf):
    """events.parquet as a stream, shaped like the readings view."""
    ev = ST.read_stream(spark, f"{sf}/events.parque[t]", EVENT_SCHEMA)  # a pattern: one file or a folder of part files
    return ev.select("event_id", F.col("ts").cast("timestamp").alias("record_time"),
                     (F.col("user_id") % 10).cast("int").alias("tag_id"), "value")


def _R(c, d=8):
    return F.round(c, d)


@query("stream_bucket_avg", with_views(["readings", "tag_mappings"], """
, b AS (
  SELECT CAST(to_timestamp(floor(epoch(record_time) / 30 + 0.5) * 30) AS TIMESTAMP) AS bucket, """ + ", ".join(
    f"avg(value) FILTER (WHERE sensor_name = '{s}') AS {s}" for s in _SENSORS) + """
  FROM readings JOIN tag_mappings USING (tag_id) GROUP BY 1)
SELECT bucket, """ + ", ".join(f"round({s}, 8) AS {s}" for s in _SENSORS) + """
FROM b"""))
def stream_bucket_avg(spark, sf):
    """30 s nearest-bucket sensor pivot of the stream: mergeable sums per batch, averaged on read; no bucket or late row lost."""
    tags = view(spark, sf, "tag_mappings")
    out = ST.run_available_now(ST.enrich_stream(_readings_stream(spark, sf), tags), "bucket_avg", writer=ST.bucket_partials_writer)
    r = ST.merged_buckets(spark, out, _SENSORS)
    return r.select("bucket", *[_R(F.col(x)).alias(x) for x in _SENSORS])


@query("stream_enriched", with_views(["readings", "tag_mappings"], """
SELECT sensor_name, count(*) AS n, round(avg(value), 8) AS avg_value
FROM readings JOIN tag_mappings USING (tag_id) GROUP BY sensor_name"""))
def stream_enriched(spark, sf):
    """Stream–static join written per batch, then summarised per sensor."""
    tags = view(spark, sf, "tag_mappings")
    s = ST.enrich_stream(_readings_stream(spark, sf), tags).select("event_id", "sensor_name", "value")
    out = ST.run_available_now(s, "enriched")
    r = ST.read_output(spark, out, T.StructType([T.StructField("event_id", T.LongType()),
                                                 T.StructField("sensor_name", T.StringType()),
                                                 T.StructField("value", T.DoubleType())]))
    return r.groupBy("sensor_name").agg(F.count(F.lit(1)).alias("n"), _R(F.avg("value")).alias("avg_value"))


@query("stream_scored")
def stream_scored(spark, sf):
    """A model fitted on the batch table scores the stream (prediction counts per sensor)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    tags = view(spark, sf, "tag_mappings")
    batch = view(spark, sf, "readings").withColumn("label", (F.col("value") > 10).cast("double"))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["value"], outputCol="features"),
                            LogisticRegression(maxIter=20, regParam=0.05)])
    model = pipe.fit(batch)
    s = ST.score_stream(ST.enrich_stream(_readings_stream(spark, sf), tags), model)
    s = s.select("event_id", "sensor_name", "prediction")
    out = ST.run_available_now(s, "scored")
    r = ST.read_output(spark, out, T.StructType([T.StructField("event_id", T.LongType()),
                                                 T.StructField("sensor_name", T.StringType()),
                                                 T.StructField("prediction", T.DoubleType())]))
    return r.groupBy("sensor_name", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("stream_batch_pivot_dynamic", with_views(["readings", "tag_mappings"], """
SELECT CAST(to_timestamp(floor(epoch(record_time) / 30 + 0.5) * 30) AS TIMESTAMP) AS bucket, """ + ", ".join(
    f"round(avg(value) FILTER (WHERE sensor_name = '{s}'), 8) AS {s}" for s in _SENSORS) + """
FROM readings JOIN tag_mappings USING (tag_id) GROUP BY 1"""))
def stream_batch_pivot_dynamic(spark, sf):
    """The same with the sensor names found in the stream; buckets and sensors of all batches are merged."""
    tags = view(spark, sf, "tag_mappings")
    s = ST.enrich_stream(_readings_stream(spark, sf), tags).select("record_time", "sensor_name", "value")
    r = ST.merged_buckets(spark, ST.run_available_now(s, "dynpivot", writer=ST.bucket_partials_writer))
    return r.select("bucket", *[_R(F.col(x)).alias(x) for x in sorted(c for c in r.columns if c != "bucket")])


@query("stream_totals_compacted", with_views(["readings", "tag_mappings"], """
SELECT CAST(to_timestamp(floor(epoch(record_time) / 30 + 0.5) * 30) AS TIMESTAMP) AS bucket, sensor_name, round(sum(value), 6) AS total, count(value) AS n
FROM readings JOIN tag_mappings USING (tag_id) GROUP BY 1, 2"""))
def stream_totals_compacted(spark, sf):
    """The stream's bucket sums in a keyed table: written per batch, compacted into its base, read from there."""
    from stratum.functions.scalar import round_to_nearest_seconds

    tags = view(spark, sf, "tag_mappings")
    s = ST.enrich_stream(_readings_stream(spark, sf), tags).select(
        round_to_nearest_seconds("record_time", 30).alias("bucket"), "sensor_name", F.col("value").alias("total"),
        F.col("value").isNotNull().cast("long").alias("n"))
    made = {}

    def store(out):
        made["t"] = ST.KeyedTotals(spark, out, ["bucket", "sensor_name"], ["total", "n"], "bucket timestamp, sensor_name string, total double, n long")
        return made["t"].write

    ST.run_available_now(s, "totals", writer=store)
    made["t"].compact()
    return made["t"].read().select("bucket", "sensor_name", _R(F.col("total"), 6).alias("total"), "n")
