"""Ranking stored readings, by DataFrame or SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.operators import filter_parameter, rank_by_aqi, top_aqi
from hazeline.operators.ranking import unused
from hazeline.sources import scan_table


def rank_table(spark: SparkSession, path: str, parameter: str = "PM2.5") -> DataFrame:
    """All readings of one parameter in a stored table, highest index first.

    Ties are ordered by the position of the row in its file. No two rows have the same sort
    key then, so the sort divides any number of equal or identical rows between tasks.
    """
    readings = scan_table(spark, path)
    position = {
        unused("_file", readings): F.xxhash64("_metadata.file_path"),
        unused("_row", readings): F.col("_metadata.row_index"),
    }
    placed = filter_parameter(readings, parameter).select(
        "*", *[column.alias(name) for name, column in position.items()]
    )
    return rank_by_aqi(placed, tuple(position)).drop(*position)


def top_table(
    spark: SparkSession, path: str, parameter: str = "PM2.5", k: int = 20
) -> DataFrame:
    """The ``k`` readings of one parameter in a stored table with the highest index."""
    return top_aqi(scan_table(spark, path), parameter, k)


def rank_sql(spark: SparkSession, view: str, parameter: str = "PM2.5") -> DataFrame:
    """The same ranking as SQL over a registered view; ties as in ``rank_by_aqi``."""
    return spark.sql(
        """
        SELECT reading.*
        FROM (
            SELECT struct(*) AS reading, xxhash64(*) AS tie, monotonically_increasing_id() AS place
            FROM IDENTIFIER(:view)
            WHERE ParameterName = :parameter
        )
        ORDER BY reading.AQI DESC NULLS LAST, tie, place
        """,
        args={"view": view, "parameter": parameter},
    )
