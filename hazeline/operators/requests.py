"""Requests for the readings around each station."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.functions import coordinate_text, is_coordinate

# Service paths.
ENDPOINTS = {
    "observation": "aq/observation/latLong/current/",
    "forecast": "aq/forecast/latLong/",
}


def build_requests(
    locations: DataFrame, endpoint: str, date: str | datetime.date, distance: int = 1
) -> DataFrame:
    """Add the relative ``url`` of each location, without host and API key.

    The URL is null where a coordinate is missing or no number; see ``split_locations``.
    """
    day = datetime.date.fromisoformat(str(date)).isoformat()
    url = F.concat(
        F.lit(f"{ENDPOINTS[endpoint]}?format=application/json&latitude="),
        coordinate_text(F.col("Latitude")),
        F.lit("&longitude="),
        coordinate_text(F.col("Longitude")),
        F.lit(f"&date={day}&distance={int(distance)}"),
    )
    return locations.withColumn("url", url)


def split_locations(locations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Locations a request can be built for, and those without usable coordinates."""
    usable = is_coordinate(F.col("Latitude")) & is_coordinate(F.col("Longitude"))
    return locations.filter(usable), locations.filter(~F.coalesce(usable, F.lit(False)))
