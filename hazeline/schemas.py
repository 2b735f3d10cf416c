"""Declared record layouts. Every field is nullable."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def _layout(fields: list[tuple[str, str]]) -> StructType:
    schema = StructType()
    for name, kind in fields:
        schema = schema.add(name, kind)
    return schema


# Field names, order and types of the three record layouts.
STATION = _layout(
    [
        ("Reporting area", "string"),
        ("State code", "string"),
        ("Country code", "string"),
        ("Forecasts", "string"),
        ("Action Day name", "string"),
        ("Latitude", "float"),
        ("Longitude", "float"),
        ("GMT offset", "float"),
        ("Daylight savings", "string"),
        ("Standard time zone label", "string"),
        ("Daylight savings time zone label", "string"),
        ("TWC code", "string"),
        ("USA Today", "string"),
        ("Forecast Source", "string"),
    ]
)

OBSERVATION = _layout(
    [
        ("DateObserved", "string"),
        ("HourObserved", "string"),
        ("LocalTimeZone", "string"),
        ("ReportingArea", "string"),
        ("StateCode", "string"),
        ("Latitude", "float"),
        ("Longitude", "float"),
        ("ParameterName", "string"),
        ("AQI", "float"),
    ]
)

FORECAST = _layout(
    [
        ("DateIssue", "string"),
        ("DateForecast", "string"),
        ("ReportingArea", "string"),
        ("StateCode", "string"),
        ("Latitude", "float"),
        ("Longitude", "float"),
        ("ParameterName", "string"),
        ("AQI", "float"),
    ]
)


def with_corrupt(schema: StructType) -> StructType:
    """The schema plus the column in which Spark's readers keep unparsable input."""
    return StructType(schema.fields + [StructField(CORRUPT, StringType(), True)])
