"""Sinks: overwrite tables, nested JSON reports, CSV exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

# Writers cut timestamps to milliseconds by default; keep microseconds.
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> str:
    """Overwrite (or append) a parquet table; the write is a committed job,
    so a lost executor only re-runs its own tasks."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def overwrite_roundtrip(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write to the shared table folder and scan it back."""
    path = write_table(df, scratch_path(spark, name))
    return spark.read.schema(df.schema).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Nested reports (S10, S11, S13) as JSON lines."""
    (df.write.mode(mode).option("timestampNTZFormat", TS_NTZ_FORMAT)
     .option("timestampFormat", TS_FORMAT).json(path))
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV export with header and microsecond timestamps."""
    (df.write.mode(mode).option("header", True).option("timestampNTZFormat", TS_NTZ_FORMAT)
     .option("timestampFormat", TS_FORMAT).csv(path))
    return path


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return (spark.read.schema(schema).option("header", True)
            .option("timestampNTZFormat", TS_NTZ_FORMAT).option("timestampFormat", TS_FORMAT).csv(path))


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return (spark.read.schema(schema).option("timestampNTZFormat", TS_NTZ_FORMAT)
            .option("timestampFormat", TS_FORMAT).json(path))
