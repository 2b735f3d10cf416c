"""Air-quality readings on Spark: stations, API responses, typed tables, rankings."""

from hazeline.schemas import FORECAST, OBSERVATION, STATION

__all__ = ["FORECAST", "OBSERVATION", "STATION"]
