"""Sensor-table operators: enrichment by tag, daily means."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators.joins import lookup_join


def enrich(readings: DataFrame, tags: DataFrame, key: str = "tag_id") -> DataFrame:
    """Readings joined with the tag → sensor-name table."""
    return lookup_join(readings, tags, key)


def daily_sensor_means(readings: DataFrame, tags: DataFrame, ts: str = "record_time", value: str = "value") -> DataFrame:
    """Average value per (day, sensor)."""
    r = enrich(readings, tags)
    return r.groupBy(F.to_date(ts).alias("day"), "sensor_name").agg(F.avg(value).alias("avg_value"))
