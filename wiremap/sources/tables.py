"""Batch table scans (parquet paths or catalog tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wiremap.functions.columns import to_ltz


def read_table(spark: SparkSession, base: str, name: str, ltz: bool = True) -> DataFrame:
    """Read ``<base>/<name>.parquet`` (a file or a folder); NTZ -> timestamp."""
    df = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    return to_ltz(df) if ltz else df


def read_catalog(spark: SparkSession, name: str, ltz: bool = True) -> DataFrame:
    df = spark.read.table(name)
    return to_ltz(df) if ltz else df
