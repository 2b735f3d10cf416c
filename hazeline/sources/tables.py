"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    """Scan a Parquet table, independent of the session's default source."""
    return spark.read.parquet(path)
