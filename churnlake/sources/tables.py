"""Scans of the supplied tables with pinned schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .schemas import BASE_SCHEMAS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan with an explicit schema; Catalyst prunes columns and
    pushes filters into the scan."""
    reader = spark.read
    if name in BASE_SCHEMAS:
        reader = reader.schema(BASE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=None) -> None:
    for n in names or BASE_SCHEMAS:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
