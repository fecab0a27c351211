"""Join operators (J family): shifted, prior-period, anti, nested enrichment,
interval (range) join, double dimension lookup."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def lookup_join(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join with a dimension table. One lazy plan at every size: adaptive execution broadcasts the side if its
    measured bytes allow it and splits skewed partitions otherwise."""
    return big.join(small, on, how)


def shifted_date_join(a: DataFrame, b: DataFrame, a_date: str, b_date: str, days: int = 1,
                      how: str = "inner") -> DataFrame:
    """Rows of ``a`` on day d joined with rows of ``b`` on day d − ``days``.

    The shift is applied to ``b``'s key before the join so the condition stays a
    plain equi-join (hash-partitioned on the date), not a theta join.
    """
    b2 = b.withColumn("_join_day", F.date_add(F.col(b_date), days))
    return a.join(b2, a[a_date] == b2["_join_day"], how).drop("_join_day")


def prior_period_pairs(df: DataFrame, key: str, period: str, cols: Sequence[str],
                       prior_suffix: str = "0") -> DataFrame:
    """Each (key, period p) row paired with the same key's row at p − 1.

    A self equi-join on (key, period) — a gap period gives no pair, which a
    ``lag`` would wrongly fill.
    """
    prev = df.select(F.col(key), (F.col(period) + 1).alias(period),
                     *[F.col(c).alias(f"{c}{prior_suffix}") for c in cols])
    cur = df.select(key, period, *cols)
    return cur.join(prev, [key, period], "inner")


def exclude(df: DataFrame, excluded: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Exclusion (anti) join: rows whose key appears in ``excluded`` are dropped."""
    return df.join(excluded, on, "left_anti")


def enrich_nested(df: DataFrame, annotations: DataFrame, on: str, root: str) -> DataFrame:
    """Left enrichment by key, the annotation columns nested under struct ``root``."""
    cols = [c for c in annotations.columns if c != on]
    ann = annotations.select(on, F.struct(*cols).alias(root))
    return df.join(ann, on, "left")


def interval_semi_join(points: DataFrame, intervals: DataFrame, contig: str = "contig", pos: str = "pos",
                       start: str = "start", end: str = "end", bin_size: int = 1_000_000) -> DataFrame:
    """Points inside any interval ``[start, end]`` of the same contig (semi join).

    Range join as an equi-join on (contig, bin): each interval is replicated to
    the bins it covers, each point maps to one bin, then the exact range
    predicate filters. The shuffle is on (contig, bin), so a long contig is
    spread over many tasks; ``left_semi`` keeps each point once.
    """
    iv = intervals.select(F.col(contig).alias("_c"), F.col(start).alias("_lo"), F.col(end).alias("_hi"))
    iv = iv.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_lo") / bin_size).cast("long"),
                                                   F.floor(F.col("_hi") / bin_size).cast("long"))))
    p = points.withColumn("_bin", F.floor(F.col(pos) / bin_size).cast("long"))
    cond = ((p[contig] == iv["_c"]) & (p["_bin"] == iv["_bin"]) & (p[pos] >= iv["_lo"]) & (p[pos] <= iv["_hi"]))
    return p.join(iv, cond, "left_semi").drop("_bin")


def double_lookup(df: DataFrame, dim: DataFrame, dim_key: str, left_keys: Sequence[str],
                  prefixes: Sequence[str]) -> DataFrame:
    """Look a dimension up once per key column (e.g. origin and destination coordinates)."""
    out = df
    for k, p in zip(left_keys, prefixes):
        d = dim.select(*[F.col(c).alias(f"{p}{c}") for c in dim.columns])
        out = out.join(d, out[k] == d[f"{p}{dim_key}"], "inner")
    return out


def sum_by_key(frames: Sequence[DataFrame], key: Sequence[str] | str, value_cols: Sequence[str],
               out: str = "total") -> DataFrame:
    """N frames that share a key: per-key sum of their value columns.

    Union + one aggregate instead of an N-way join: one shuffle, partial
    aggregation, and no join explosion on duplicate keys.
    """
    keys = [key] if isinstance(key, str) else list(key)
    parts = [f.select(*keys, F.col(v).cast("double").alias("_v")) for f, v in zip(frames, value_cols)]
    u = functools.reduce(DataFrame.unionByName, parts)
    return u.groupBy(*keys).agg(F.sum("_v").alias(out))


def cond(*cs: Column) -> Column:
    return functools.reduce(lambda a, b: a & b, cs)
