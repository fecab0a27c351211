"""Group-relative statistics and ordered-sequence operators (W1–W8, O3, A11 helpers).

Group statistics (z-score, max-abs scale) are computed with a partial hash
aggregate and attached by an equi-join (broadcast or skew-split at run time), so a hot
group (say one year holding a third of all rows) is never sent whole to one
task as a ``Window.partitionBy(group)`` would do. Previous-row deltas, ordinals
and the running concatenation are windows over one entity's history.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_group_stats(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Attach per-group aggregates to every row (one partial-aggregated pass + join).

    The aggregate table has one row per group; adaptive execution broadcasts it by its measured bytes or
    splits skewed partitions of the shuffle join. NULL keys are a group like any other.
    """
    return attach(df, df.groupBy(*keys).agg(*aggs), keys)


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row of ``df`` with its group's row of ``stats`` (one per ``keys``); NULL keys meet each other."""
    for k in keys:
        stats = stats.withColumnRenamed(k, f"_k_{k}")
    on = functools.reduce(lambda a, b: a & b, [df[k].eqNullSafe(stats[f"_k_{k}"]) for k in keys])
    return df.join(stats, on, "left").drop(*[f"_k_{k}" for k in keys])


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (zero variance gives no score)."""
    return F.when(den != 0, num / den)


def zscore_within(df: DataFrame, group: Sequence[str], cols: Sequence[str], prefix: str = "z",
                  negate: Sequence[str] = ()) -> DataFrame:
    """Population z-score of each column within its group; columns in ``negate`` flip sign."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"_a_{c}"), F.stddev_pop(c).alias(f"_s_{c}")]
    x = with_group_stats(df, group, aggs)
    for c in cols:
        z = safe_div(F.col(c) - F.col(f"_a_{c}"), F.col(f"_s_{c}"))
        x = x.withColumn(f"{prefix}{c}", -z if c in negate else z)
    return x.drop(*[f"_a_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def maxabs_within(df: DataFrame, group: Sequence[str], cols: Sequence[str], prefix: str = "n",
                  strip: str = "z") -> DataFrame:
    """``x / max(|max x|, |min x|)`` within the group (scores scaled to [-1, 1])."""
    aggs = []
    for c in cols:
        aggs += [F.greatest(F.abs(F.max(c)), F.abs(F.min(c))).alias(f"_m_{c}")]
    x = with_group_stats(df, group, aggs)
    for c in cols:
        base = c[len(strip):] if strip and c.startswith(strip) else c
        x = x.withColumn(f"{prefix}{base}", safe_div(F.col(c), F.col(f"_m_{c}")))
    return x.drop(*[f"_m_{c}" for c in cols])


def row_sum(cols: Sequence[str]) -> Column:
    """Sum of several columns (NULL if any is NULL), left to right."""
    out = F.col(cols[0])
    for c in cols[1:]:
        out = out + F.col(c)
    return out


def delta_previous(df: DataFrame, entity: str, order: str, cols: Sequence[str], prefix: str = "delta_") -> DataFrame:
    """Change against the entity's previous row in ``order``; NULL for the first.

    One ``lag`` over the entity's history (one shuffle by entity). Rows with a NULL ``order`` are kept: they have no
    previous row and are no row's previous one.
    """
    w = Window.partitionBy(entity).orderBy(F.col(order).asc_nulls_last())
    out = df
    for c in cols:
        out = out.withColumn(f"{prefix}{c}", F.when(F.col(order).isNotNull(), F.col(c) - F.lag(c).over(w)))
    return out


def offset_from_first(df: DataFrame, entity: str, col: str, out: str) -> DataFrame:
    """``col − min(col)`` per entity (e.g. experience = age − first age), via group stats."""
    x = with_group_stats(df, [entity], [F.min(col).alias("_first")])
    return x.withColumn(out, F.col(col) - F.col("_first")).drop("_first")


def ordinal(df: DataFrame, entity: str, order: str, out: str = "ordinal") -> DataFrame:
    """0-based position of each row in its entity's ``order`` sequence; NULL (row kept) where ``order`` is NULL."""
    w = Window.partitionBy(entity).orderBy(F.col(order).asc_nulls_last())
    return df.withColumn(out, F.when(F.col(order).isNotNull(), (F.row_number().over(w) - 1).cast("int")))


def top_k(df: DataFrame, by: str, k: int, where: Column | None = None) -> DataFrame:
    src = df.where(where) if where is not None else df
    return src.orderBy(F.col(by).desc()).limit(k)
