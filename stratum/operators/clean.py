"""Cleaning, recoding and row-selection operators (P family, U4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.functions.scalar import labelled_bucket, unhot


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN and NULL both mean "missing": normalise float NaN to NULL once, at ingest."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cols = [c for c in (cols or fl) if c in fl]
    return df.select(*[F.nanvl(F.col(c), F.lit(None)).alias(c) if c in cols else F.col(c) for c in df.columns])


def fill_missing(df: DataFrame, value=0.0, subset: Sequence[str] | None = None) -> DataFrame:
    """Empty / missing numeric cells → ``value`` (typed CSV read gives NULL for empty cells)."""
    return nan_to_null(df, subset).na.fill(value, subset=list(subset) if subset else None)


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows with any NULL (in ``subset``) removed."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def drop_junk_lines(lines: DataFrame, col: str = "value", header_marker: str | None = None,
                    require: str = ",", strip: str | None = "*") -> DataFrame:
    """Line-level cleaning of text files: drop repeated header lines and lines without a
    delimiter, strip a marker character."""
    c = F.col(col)
    out = lines.where(c.contains(require))
    if header_marker:
        out = out.where(~c.contains(header_marker))
    if strip:
        out = out.withColumn(col, F.replace(c, F.lit(strip), F.lit("")))
    return out


def recode_values(df: DataFrame, col: str, keep: str, other: str) -> DataFrame:
    c = F.col(col)
    return df.withColumn(col, F.when(c.isNull() | (c == keep), c).otherwise(F.lit(other)))


def shift_codes(df: DataFrame, cols: Sequence[str], by: int = 1) -> DataFrame:
    """Category codes shifted to start at zero (``code - by``), typed double for ML."""
    return df.select(*[(F.col(c).cast("double") - by).alias(c) if c in cols else F.col(c) for c in df.columns])


def add_bucket(df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[str] | None = None,
               out: str = "bucket") -> DataFrame:
    return df.withColumn(out, labelled_bucket(col, edges, labels))


def add_unhot(df: DataFrame, cols: Sequence[str], out: str, drop: bool = True) -> DataFrame:
    """One-hot block → one 0-based category index (−1 when no column is hot)."""
    res = df.withColumn(out, unhot(cols))
    return res.drop(*cols) if drop else res


def head_rest_split(df: DataFrame, order_by: Sequence[str], n: int) -> tuple[DataFrame, DataFrame]:
    """Positional split: the first ``n`` rows in ``order_by`` order, and the rest.

    ``limit`` gives a top-n (TakeOrderedAndProject, bounded per task); the rest
    is an anti join on the full key, so no single-partition window is needed.
    """
    head = df.orderBy(*order_by).limit(n)
    rest = df.join(head.select(*order_by), list(order_by), "left_anti")
    return head, rest


def preferred_row(df: DataFrame, keys: Sequence[str], prefer: Column, tiebreak: Sequence[Column]) -> DataFrame:
    """One row per ``keys``: the row where ``prefer`` is true wins, else the first by ``tiebreak``.

    Expressed as ``max_by`` over a struct ordering key, combined before the shuffle, so a hot key is one row per map
    task and never buffered whole in one task (unlike a window row_number). Rows with strings cannot be kept in a
    hash aggregate's fixed-width buffer: Spark sorts by the keys and aggregates runs, spilling where it must.
    """
    order = F.struct(prefer.cast("int").alias("_p"), *[t.alias(f"_t{i}") for i, t in enumerate(tiebreak)])
    others = [c for c in df.columns if c not in keys]
    payload = F.struct(*[F.col(c) for c in others])
    return (df.groupBy(*keys).agg(F.max_by(payload, order).alias("_row"))
            .select(*keys, *[F.col("_row")[c].alias(c) for c in others]))


def feature_columns(columns: Sequence[str], exclude: Sequence[str] = (), extra: Sequence[str] = ()) -> list[str]:
    """Ordered feature list: ``columns`` minus ``exclude`` plus ``extra`` (stable order, no set)."""
    out = [c for c in columns if c not in set(exclude)]
    out += [c for c in extra if c not in out]
    return out


def keep_true_or_missing(df: DataFrame, pred: Column) -> DataFrame:
    return df.where(F.coalesce(pred, F.lit(True)))
