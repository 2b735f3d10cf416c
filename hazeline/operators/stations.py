"""Selecting stations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The states kept by default.
WEST_COAST = ("CA", "OR", "WA")


def filter_states(stations: DataFrame, states: Sequence[str] = WEST_COAST) -> DataFrame:
    """Keep stations whose state code is exactly one of ``states``; null is not kept."""
    return stations.filter(F.col("State code").isin(list(states)))


def project_locations(stations: DataFrame) -> DataFrame:
    return stations.select("TWC code", "Latitude", "Longitude")


def table_shape(df: DataFrame) -> DataFrame:
    """One row with the number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))
