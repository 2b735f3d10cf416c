"""Ranking readings by air-quality index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_parameter(readings: DataFrame, parameter: str = "PM2.5") -> DataFrame:
    return readings.filter(F.col("ParameterName") == parameter)


def unused(name: str, rows: DataFrame) -> str:
    """A column name like ``name`` that ``rows`` has not."""
    taken = {column.lower() for column in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _order(readings: DataFrame, tie_break: Sequence[Column | str]) -> list[Column | str]:
    ties = list(tie_break) or [F.xxhash64(*[F.col(f"`{name}`") for name in readings.columns])]
    return [F.col("AQI").desc_nulls_last(), *ties]


def rank_by_aqi(readings: DataFrame, tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """All readings, highest index first, nulls last.

    Equal index values are ordered by ``tie_break``, or else by a hash of the row. Rows that are
    alike in that, too, are told apart by their place, so that the range-partitioned sort divides
    any number of equal or identical rows between tasks.
    """
    place = unused("_place", readings)
    placed = readings.withColumn(place, F.monotonically_increasing_id())
    return placed.orderBy(*_order(readings, tie_break), place).drop(place)


def top_aqi(
    readings: DataFrame,
    parameter: str = "PM2.5",
    k: int = 20,
    tie_break: Sequence[Column | str] = (),
) -> DataFrame:
    """The ``k`` readings of one parameter with the highest index; needs no full sort."""
    chosen = filter_parameter(readings, parameter)
    return chosen.orderBy(*_order(chosen, tie_break)).limit(k)
