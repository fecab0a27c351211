"""Aggregation operators (A1–A20): grouped summaries, stat counters, pivots,
confusion matrix, entropy, word counts, conditional counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_summary(df: DataFrame, by: Sequence[str], value: str, where: Column | None = None,
                  count_name: str = "n", mean_name: str | None = None, order_by: Sequence | None = None) -> DataFrame:
    """Filter → group → count + mean → sort (partial aggregation before the shuffle)."""
    src = df.where(where) if where is not None else df
    aggs = [F.count(F.lit(1)).alias(count_name), F.avg(value).alias(mean_name or f"avg_{value}")]
    out = src.groupBy(*by).agg(*aggs)
    return out.orderBy(*order_by) if order_by else out


def stat_counter(df: DataFrame, group: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Mergeable per-group statistics of many metrics, long form.

    For each metric: non-missing count, mean, population stdev, max, min and
    missing count; NaN counts as missing. One hash aggregate (partial +
    final) over all metrics, then ``unpivot`` to (group…, metric, stats…).
    """
    aggs = []
    for m in metrics:
        v = F.nanvl(F.col(m).cast("double"), F.lit(None))
        aggs += [F.count(v).alias(f"{m}__count"), F.avg(v).alias(f"{m}__mean"),
                 F.stddev_pop(v).alias(f"{m}__stdev"), F.max(v).alias(f"{m}__max"),
                 F.min(v).alias(f"{m}__min"), F.count_if(v.isNull()).alias(f"{m}__missing")]
    wide = df.groupBy(*group).agg(*aggs)
    structs = [F.struct(F.lit(m).alias("metric"), *[F.col(f"{m}__{s}").cast("double").alias(s) for s in
                                                     ("count", "mean", "stdev", "max", "min", "missing")])
               for m in metrics]
    return (wide.select(*group, F.explode(F.array(*structs)).alias("_s"))
            .select(*group, "_s.*")
            .withColumn("count", F.col("count").cast("long"))
            .withColumn("missing", F.col("missing").cast("long")))


def stat_counter_wide(df: DataFrame, group: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Same statistics in wide form, columns named ``<metric>_<stat>``."""
    aggs = []
    for m in metrics:
        v = F.nanvl(F.col(m).cast("double"), F.lit(None))
        aggs += [F.count(v).alias(f"{m}_count"), F.avg(v).alias(f"{m}_mean"),
                 F.stddev_pop(v).alias(f"{m}_stdev"), F.max(v).alias(f"{m}_max"), F.min(v).alias(f"{m}_min")]
    return df.groupBy(*group).agg(*aggs)


def pivot_mean(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence, value: str,
               digits: int | None = None) -> DataFrame:
    """Long → wide: one column per pivot value holding the mean of ``value``.

    Pivot values are explicit (no extra job to discover them; required for streams).
    """
    v = F.col(value)
    agg = F.avg(F.round(v, digits) if digits is not None else v)
    return df.groupBy(*keys).pivot(pivot_col, list(values)).agg(agg)


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: Sequence) -> DataFrame:
    """Rows = actual label, one count column per predicted class, zero filled."""
    out = df.groupBy(label).pivot(prediction, list(classes)).count().na.fill(0)
    return out.select(label, *[F.col(str(c)).cast("long").alias(str(c)) for c in classes])


def cluster_entropy(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Size-weighted mean entropy (natural log) of label distributions over clusters.

    Two aggregations: counts per (cluster, label), then per cluster
    ``n_c * H_c = n_c*ln(n_c) - sum n_cl*ln(n_cl)`` — every step is a
    partial-aggregated groupBy, so a huge cluster never sits in one task.
    """
    per = df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("_n"))
    per_c = per.groupBy(cluster).agg(F.sum("_n").alias("_nc"), F.sum(F.col("_n") * F.log("_n")).alias("_s"))
    weighted = F.col("_nc") * F.log("_nc") - F.col("_s")
    return per_c.agg((F.sum(weighted) / F.sum("_nc")).alias("entropy"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counter of values, NULL is its own group."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def fraction_where(df: DataFrame, group: Sequence[str], pred: Column, name: str = "fraction", count_name: str = "n") -> DataFrame:
    """Share of rows for which ``pred`` holds, and the number of rows, per group in one pass."""
    return df.groupBy(*group).agg(F.avg(pred.cast("double")).alias(name), F.count(F.lit(1)).alias(count_name))


def conditional_counts(df: DataFrame, preds: dict[str, Column], extra: dict[str, Column] | None = None) -> DataFrame:
    """Several predicate counts (plus any other aggregates) in one pass."""
    aggs = [F.count_if(p).alias(n) for n, p in preds.items()]
    aggs += [c.alias(n) for n, c in (extra or {}).items()]
    return df.agg(*aggs)


def scaled_intensity(df: DataFrame, count_col: str, out: str = "intensity", lo: int = 1, hi: int = 100) -> DataFrame:
    """Counts scaled to ``round(count / max * hi)`` with a floor of ``lo``.

    The (aggregated) input is materialised once with a reliable checkpoint, so
    reading its max and scaling it do not recompute the upstream; the max is a
    single value fetched as a literal — no single-partition window, no cross join.
    """
    from stratum.session import cut_lineage

    df = cut_lineage(df)
    mx = df.agg(F.max(count_col)).first()[0] or 1
    return df.withColumn(out, F.greatest(F.lit(lo), F.round(F.col(count_col) / F.lit(float(mx)) * hi)).cast("int"))
