"""Shared pieces of the training-data operators: shared-folder scratch tables and connected components."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import checkpoint_dir


BATCH_ROWS = 1024


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder in ``spark.checkpoint.dir`` (visible to the driver and every executor)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to a scratch Parquet table and read it back: a lineage cut that survives lost executors."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark drop shuffle files of finished steps whose results were written (it does so on driver GC only)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, under fixed names; a null text is the empty text.

    Whole texts are large rows: the session's Arrow batches are held to ``BATCH_ROWS`` rows, so that a task's two
    processes hold few megabytes of them at a time.
    """
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): root is the smallest node reachable over the undirected links (a, b).

    Alternating large-star / small-star rounds, each two minimum aggregates and two equi-joins, so a hub's neighbours
    are never gathered in one task (the join side is split by adaptive skew handling). Rounds end when the link set
    is unchanged. An isolated node does not occur in the result; null ends and self-links are ignored.
    """
    e = (edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e, seen = table(e, "links"), None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = table(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        large = table(e.select(F.col("v").alias("k"), F.col("u").alias("far"))
                      .join(low.withColumnRenamed("u", "k"), "k").where("far <> m")
                      .select(F.col("far").alias("u"), F.col("m").alias("v"))
                      .unionByName(low.where("u <> m").select("u", F.col("m").alias("v"))).distinct(), "large")
        low = table(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        e = table(large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
