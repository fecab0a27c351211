"""Sinks and catalog lifecycle (K1–K11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def external_table(spark: SparkSession, name: str, location: str, fmt: str = "parquet", schema_ddl: str | None = None,
                   options: dict[str, str] | None = None) -> DataFrame:
    """External table over files (e.g. CSV with a header line, or Parquet) in the catalog."""
    opts = ""
    if options:
        opts = " OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in options.items()) + ")"
    cols = f" ({schema_ddl})" if schema_ddl else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name}{cols} USING {fmt}{opts} LOCATION '{location}'")
    return spark.table(name)


def write_parquet(df: DataFrame, path: str, compression: str = "snappy", mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = False, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, sep=sep, header=header)


def write_text(df: DataFrame, path: str, col: str = "value", mode: str = "overwrite") -> None:
    df.select(col).write.mode(mode).text(path)


def export_delimited(df: DataFrame, path: str, sep: str = "\t", header: bool = True) -> None:
    """Chosen fields (flatten structs first with ``select("a", "s.*")``) as delimited text."""
    df.write.mode("overwrite").csv(path, sep=sep, header=header)


def fetch(df: DataFrame, max_rows: int = 100_000):
    """Bring a *reduced* result to the driver as pandas; refuses results above ``max_rows``."""
    n = df.limit(max_rows + 1).count()
    if n > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; aggregate or limit before fetching")
    return df.toPandas()


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
