"""A training-data pipeline over ``documents``: quality rules, toxicity, SimHash near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet in the shared folder
and reads it again as the next stage's documents. All stages but the last return the columns they were given. The
near-duplicate stage decides by row: ids may be null or repeat, with the same or with different texts.
"""

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stratum.llm import packing, quality, simhash, suffix, toxicity
from stratum.llm.common import free_shuffles, scratch, table
from stratum.session import load


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the threshold table."""
    return quality.keep_good(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is below the limit; the model is fitted on the labelled rows of the raw table."""
    model = toxicity.fit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the smallest id, null ids last; of rows with that id, the smallest text hash."""
    rows = table(docs.select(F.monotonically_increasing_id().alias("_key"), F.struct(*docs.columns).alias("_row")), "near-rows")
    own = F.struct(F.col("_row.doc_id").isNull().alias("unnamed"), F.col("_row.doc_id").alias("id"),
                   F.xxhash64("_row.text").alias("hash"), F.col("_key").alias("key"))
    groups = simhash.near_duplicates(rows.select(own.alias("doc_id"), F.col("_row.text").alias("text")), size=3, distance=2)
    kept = table(groups.where("doc_id.key = component_id.key").select(F.col("doc_id.key").alias("_key")), "near-kept")
    return rows.join(kept, "_key", "left_semi").select("_row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated 200-byte strings; a character that lost some of its bytes goes whole."""
    whole = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))  # one column: names cannot clash
    made = suffix.dedup(whole, length=200, with_kept=True, keep=("_row",))
    made = made.withColumn("text", F.when(F.col("n_removed") == 0, F.decode(F.col("kept"), "UTF-8")).otherwise(_readable(F.col("kept"))))
    own = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return made.select(*[own.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


@F.pandas_udf(StringType())
def _readable(kept: pd.Series) -> pd.Series:
    return kept.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the fixed token windows."""
    return packing.pack(docs, window=2048, end_id=1)


STAGES = [("quality", quality_rules), ("toxicity", toxicity_filter), ("simhash", simhash_dedup),
          ("suffix_array", repeated_passages), ("packing", pack_documents)]

#: SQL cannot express the fitted model, the fingerprints and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from ``documents``; the last stage's rows."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        free_shuffles(spark)
    return docs
