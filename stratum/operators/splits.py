"""Splits, samples and folds by a hash of a row's key: any engine can recompute them, whatever the row order or partitioning.

Nothing is materialised or drawn: the part of a row follows from its key and the seed alone, so a recomputed upstream or a
lost executor cannot move it, and rows of one key always stay together. Null keys are an (empty) key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of the hash; shares are kept to one part in so many.
BUCKETS = 10_000


def key_bucket(keys: Sequence[str], seed: int = 42) -> Column:
    """0..BUCKETS-1 from the first 32 bits of the MD5 of ``seed|key|key...``."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") % BUCKETS).cast("int")


def key_bucket_sql(keys: Sequence[str], seed: int = 42) -> str:
    """The same as SQL of an engine that reads hexadecimal numbers."""
    text = " || '|' || ".join([f"'{seed}'", *[f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys]])
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % {BUCKETS})"


def split_by_key(df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """One DataFrame per weight; every row is in exactly one."""
    marked, out, low = df.withColumn("_b", key_bucket(keys, seed)), [], 0
    for i in range(len(weights)):
        high = BUCKETS if i == len(weights) - 1 else round(BUCKETS * sum(weights[:i + 1]) / sum(weights))
        out.append(marked.where((F.col("_b") >= low) & (F.col("_b") < high)).drop("_b"))
        low = high
    return out


def with_fold(df: DataFrame, keys: Sequence[str], folds: int, seed: int = 42, out: str = "fold") -> DataFrame:
    """A fold number 0..folds-1 per row, as ``CrossValidator(foldCol=...)`` takes it."""
    return df.withColumn(out, F.floor(key_bucket(keys, seed) * folds / BUCKETS).cast("int"))
