"""Session helpers: a tuned ``SparkSession`` and typed table loading."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tables the driver ships under every sf directory.
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_spark(app: str = "stratum", cpus: str | int = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the provided session.

    AQE stays on so shuffle partitions coalesce (small data) or split (skew)
    at run time; the UI is off because nothing may open a port.
    """
    parts = shuffle_partitions or (8 if cpus == "*" else int(cpus))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on (UTC) on any given session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: ``spark.checkpoint.dir`` from the session.

    Where it is unset, a folder set on the Spark context counts; a session in one local process (tests) takes a folder
    beside its warehouse. A cluster must name a shared folder.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    path = path or sc.getCheckpointDir()
    if not path:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never a local one."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cut from its lineage, with a measured size the planner can go by.

    The folder is left there, since lazy results read it.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/stratum-tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _normalise(df: DataFrame) -> DataFrame:
    """timestamp_ntz → timestamp (UTC session) so casts to long work."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampNTZType):
            cols.append(F.col(f.name).cast("timestamp").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; the scan stays lazy so filters and pruning reach Parquet."""
    return _normalise(spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")))


def spread(df: DataFrame, factor: int = 2) -> DataFrame:
    """Round-robin spread before CPU-heavy per-row work when the input has fewer partitions than
    cores (e.g. one large row group). A no-op on large inputs, which already have many splits."""
    par = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= par else df.repartition(par * factor)


class persisted:
    """``with persisted(df) as d:`` — cache for a block of repeated actions, always unpersisted after.

    For reuse inside one job; lineage cuts that must survive executor loss use
    :func:`cut_lineage` instead.
    """

    def __init__(self, df: DataFrame, level=None):
        from pyspark import StorageLevel

        self.df, self.level = df, level or StorageLevel.MEMORY_AND_DISK

    def __enter__(self) -> DataFrame:
        return self.df.persist(self.level)

    def __exit__(self, *exc) -> None:
        self.df.unpersist()


def sql_rows(spark: SparkSession, text: str, limit: int = 50, **frames) -> DataFrame:
    """A SQL statement (optionally over DataFrame parameters) capped at ``limit`` rows for display."""
    return spark.sql(text, **frames).limit(limit)


def cluster_settings(input_bytes: int, executor_memory_gb: float = 16.0, executor_cores: int = 4) -> dict[str, str]:
    """Settings for a large cluster, derived from the input size (apply with :func:`apply_settings`).

    * scan splits: 256 MB, 512 MB above 10 TB of input (≈200 k map tasks at 100 TB);
    * shuffle partitions: about one per GB of *input* (shuffled bytes are far
      smaller after column pruning and partial aggregation), between 200 and
      50 000 — the map × reduce block count stays manageable; AQE coalesces
      small partitions to the advisory size and splits skewed ones;
    * skew: a partition above 5× the median and 1 GB is split (AQE skew join);
    * broadcast: run-time conversion only below 64 MB (our own dimensions are
      bounded by row count before they are broadcast).
    """
    tb = 1024 ** 4
    split_mb = 512 if input_bytes > 10 * tb else 256
    partitions = int(min(50_000, max(200, input_bytes // 1024 ** 3)))
    per_core_mb = executor_memory_gb * 1024 * 0.6 / max(1, executor_cores)
    advisory_mb = int(min(512, max(64, per_core_mb / 4)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": f"{split_mb}m",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{advisory_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.session.timeZone": "UTC",
    }


def apply_settings(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    for k, v in settings.items():
        spark.conf.set(k, v)
    return spark
