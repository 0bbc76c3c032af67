"""Namespace and view DDL (S6, S7) on the session catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def create_namespace(spark: SparkSession, name: str, use: bool = True) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` then ``USE``."""
    if not name.replace("_", "").isalnum():
        raise ValueError(f"bad namespace name {name!r}")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")
    if use:
        spark.sql(f"USE `{name}`")


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """S3/S4 into the catalog: an overwrite-mode managed table."""
    df.write.mode(mode).saveAsTable(name)
