"""Structured Streaming operators for sensor readings (T1–T7).

source (schema given, never inferred) → stream–static broadcast join →
watermark → 30-second nearest-time buckets → one column per known sensor →
idempotent per-batch sink. State is bounded by the watermark × sensors, and
offsets + state live in the checkpoint folder (shared storage).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions.scalar import round_to_nearest_seconds
from stratum.session import checkpoint_dir

READING_SCHEMA = T.StructType([
    T.StructField("record_time", T.TimestampType()),
    T.StructField("tag_id", T.IntegerType()),
    T.StructField("value", T.DoubleType()),
])


# Sources whose schema is fixed by the connector (a custom schema is rejected); payloads are typed afterwards.
FIXED_SCHEMA_SOURCES = {"kafka", "rate", "socket"}


def read_stream(spark: SparkSession, path: str | None, schema: T.StructType | None, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Stream source with an explicit schema (files never infer); connectors with a fixed schema (e.g.
    ``fmt="kafka"`` with ``subscribe`` / ``kafka.bootstrap.servers`` options) take none — type their
    ``value`` with :func:`parse_json_values`."""
    r = spark.readStream.format(fmt)
    if fmt not in FIXED_SCHEMA_SOURCES:
        if schema is None:
            raise ValueError("file streams need an explicit schema")
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path) if path else r.load()


def parse_json_values(stream: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """Message-queue values (JSON strings, e.g. Kafka ``value``) → typed columns."""
    return stream.select(F.from_json(F.col(value_col).cast("string"), schema).alias("_r")).select("_r.*")


def enrich_stream(stream: DataFrame, static: DataFrame, key: str = "tag_id") -> DataFrame:
    """Stream–static join; each micro-batch is planned from the static side's measured size."""
    return stream.join(static, key)


def bucket_partials_writer(out_path: str, ts: str = "record_time", value: str = "value", sensor_col: str = "sensor_name",
                           seconds: int = 30) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink for lossless buckets: (bucket, sensor, total, n) of each micro-batch, in ``out/batch=<id>``
    (overwrite: a replayed batch replaces itself). Late rows and buckets that span batches merge on read with
    :func:`merged_buckets`; no watermark, no state, any sensor names."""
    def write(batch: DataFrame, batch_id: int) -> None:
        part = (batch.withColumn("bucket", round_to_nearest_seconds(ts, seconds)).groupBy("bucket", sensor_col)
                .agg(F.sum(value).alias("total"), F.count(value).alias("n")))
        part.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    return write


class KeyedTotals:
    """A keyed table of sums fed by micro-batches and compacted: reading costs the base and the batches since, not all history.

    ``root/batch/batch=<id>`` holds a batch's partial sums (overwritten when the batch is replayed), ``root/base/upto=<id>`` the
    sums of all batches up to that one, ``root/log`` one row per finished compaction. A reader takes the base of the last log
    row and the batches after it, so a compaction that failed half-way is never seen, and a batch replayed after it was
    folded in does not count again. NULL keys are a key; sums of no values are NULL.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], sums: Sequence[str], schema: str):
        self.spark, self.root, self.keys, self.sums, self.schema = spark, root.rstrip("/"), list(keys), list(sums), schema
        # as a table of its own, so that readers find a log before the first compaction
        spark.createDataFrame([(-1,)], "upto long").coalesce(1).write.mode("ignore").parquet(f"{self.root}/log")

    def _folded(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in self.sums])

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """A ``foreachBatch`` sink for rows with the key and sum columns."""
        self._folded(batch).write.mode("overwrite").parquet(f"{self.root}/batch/batch={batch_id}")

    def _upto(self) -> int:
        return int(self.spark.read.schema("upto long").parquet(f"{self.root}/log").agg(F.max("upto")).first()[0])

    def _rows(self, upto: int) -> DataFrame:
        rows = self.spark.read.schema(self.schema + ", batch long").parquet(f"{self.root}/batch").where(F.col("batch") > upto).drop("batch")
        if upto >= 0:
            rows = rows.unionByName(self.spark.read.schema(self.schema).parquet(f"{self.root}/base/upto={upto}"))
        return rows

    def read(self) -> DataFrame:
        """One row per key over all batches."""
        return self._folded(self._rows(self._upto()))

    def compact(self) -> int:
        """Fold the batches written so far into a new base; returns the last one folded in. Safe to repeat or to lose half-way."""
        upto = self._upto()
        found = self.spark.read.schema(self.schema + ", batch long").parquet(f"{self.root}/batch").agg(F.max("batch")).first()[0]
        last = max(upto, int(found) if found is not None else -1)
        if last > upto:
            new = self.spark.read.schema(self.schema + ", batch long").parquet(f"{self.root}/batch").where((F.col("batch") > upto) & (F.col("batch") <= last))
            rows = new.drop("batch")
            if upto >= 0:
                rows = rows.unionByName(self.spark.read.schema(self.schema).parquet(f"{self.root}/base/upto={upto}"))
            self._folded(rows).write.mode("overwrite").parquet(f"{self.root}/base/upto={last}")
            self.spark.createDataFrame([(last,)], "upto long").coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        return last


def merged_buckets(spark: SparkSession, out: str, sensors: Sequence[str] | None = None, sensor_col: str = "sensor_name") -> DataFrame:
    """One row per bucket over all batches, one column per sensor: its average. ``sensors``: the columns, else those found
    (a NULL name is the column ``null``)."""
    schema = f"bucket timestamp, {sensor_col} string, total double, n long"
    parts = read_output(spark, out, schema).groupBy("bucket", sensor_col).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    names = [sensors] if sensors else []
    wide = parts.groupBy("bucket").pivot(sensor_col, *map(list, names))
    return wide.agg(F.sum(F.col("total") / F.when(F.col("n") > 0, F.col("n"))))


def bucket_pivot_stream(enriched: DataFrame, sensors: Sequence[str], ts: str = "record_time", value: str = "value",
                        seconds: int = 30, watermark: str = "0 seconds", sensor_col: str = "sensor_name") -> DataFrame:
    """Average per nearest-``seconds`` bucket, one column per known sensor, emitted once per bucket.

    A tumbling window shifted by half a bucket gives nearest rounding (ties
    up): bucket = window.start + seconds/2. With a watermark, append mode
    emits each bucket once when it closes.
    """
    half = seconds // 2
    w = F.window(ts, f"{seconds} seconds", f"{seconds} seconds", f"{half} seconds")
    aggs = [F.avg(F.when(F.col(sensor_col) == s, F.col(value))).alias(s) for s in sensors]
    g = enriched.withWatermark(ts, watermark).groupBy(w.alias("w")).agg(*aggs)
    return g.select((F.col("w.start") + F.expr(f"INTERVAL {half} SECONDS")).alias("bucket"), *sensors)


def idempotent_batch_writer(out_path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: batch ``b`` overwrites ``out/batch=b`` so a
    re-run batch after a failure replaces, never duplicates, its rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{out_path}/batch={batch_id}")

    return write


def run_available_now(stream: DataFrame, name: str, output_mode: str = "append",
                      writer: Callable[[str], Callable[[DataFrame, int], None]] | None = None, state_partitions: int | None = None) -> str:
    """Run a streaming query over everything available now, synchronously; returns its output folder.

    Checkpoint and output go below ``spark.checkpoint.dir`` (shared storage).
    Stateful streams do not use AQE: their state is split into exactly
    ``spark.sql.shuffle.partitions`` stores, fixed at the first start and kept
    in the checkpoint. ``state_partitions`` (default: 2 × cores) is set for the
    stream's own session copy only; the caller's setting is restored.
    """
    spark = stream.sparkSession
    base = os.path.join(checkpoint_dir(spark), "stratum-streams", f"{name}-{uuid.uuid4().hex[:12]}")
    out = os.path.join(base, "out")
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", os.path.join(base, "chk"))
    w = w.foreachBatch((writer or idempotent_batch_writer)(out))
    parts = state_partitions or 2 * spark.sparkContext.defaultParallelism
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        q = w.trigger(availableNow=True).start()  # the stream clones the session conf here
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return out


def read_output(spark: SparkSession, out: str, schema: T.StructType | str) -> DataFrame:
    """Batch view of a sink folder; a folder that does not exist is an error, not an empty table."""
    return spark.read.schema(schema).parquet(out).drop("batch")


def score_stream(stream: DataFrame, model) -> DataFrame:
    """Apply a fitted (or loaded) PipelineModel to a stream (stateless transform)."""
    return model.transform(stream)
