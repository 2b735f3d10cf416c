"""Stations, readings and API replies made from the driver's ``customer`` and ``events`` tables."""

from __future__ import annotations

import json
import sys
from urllib.parse import parse_qs, urlsplit

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.schemas import STATION
from hazeline.sources.web import Reply, Transport

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATES = ("CA", "OR", "WA", "NV", "AZ", "CO")
PARAMETERS = {"view": "PM2.5", "click": "O3", "purchase": "PM10", "signup": "NO2", "error": "CO"}


def _text(value: str | None) -> Column:
    return F.lit(value).cast("string")


def _coordinate(key: Column, start: float, factor: int, span: int) -> Column:
    return F.lit(start) + ((key * factor) % span) / 10000.0


def stations(spark: SparkSession, sf_dir: str, shared: bool = False) -> DataFrame:
    """One station per customer; ``shared`` puts every third one at the same place."""
    key = F.col("c_custkey")
    latitude = _coordinate(key, 32.5, 7919, 170000)
    longitude = _coordinate(key, -124.5, 104729, 100000)
    if shared:
        third = key % 3 == 0
        latitude = F.when(third, 34.05).otherwise(latitude)
        longitude = F.when(third, -118.25).otherwise(longitude)
    state = F.element_at(
        F.array(*map(F.lit, STATES)), (F.col("c_nationkey") % len(STATES) + 1).cast("int")
    )
    columns = [
        F.col("c_name"),
        state,
        _text("US"),
        F.when(F.col("c_acctbal") < 0, "No").otherwise("Yes"),
        _text(None),
        latitude.cast("float"),
        longitude.cast("float"),
        F.lit(-8.0).cast("float"),
        _text("Yes"),
        _text("PST"),
        _text("PDT"),
        F.concat(F.lit("TWC"), key.cast("string")),
        _text(None),
        F.concat(F.lit("Año "), F.col("c_mktsegment")),
    ]
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return customer.select(*[c.alias(name) for c, name in zip(columns, STATION.names)])


def write_station_file(stations: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    writer = stations.write.option("sep", "|").option("encoding", encoding)
    writer.option("quote", "").csv(path)


def _parameter() -> Column:
    parameter = F.lit(None).cast("string")
    for kind, name in PARAMETERS.items():
        parameter = F.when(F.col("event_type") == kind, name).otherwise(parameter)
    return parameter


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per event: day, hour, pollutant, index and ``k``."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("DateObserved"),
        F.hour("ts").cast("string").alias("HourObserved"),
        _parameter().alias("ParameterName"),
        F.col("value").cast("float").alias("AQI"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def _category() -> Column:
    k = F.get_json_object("props", "$.k").cast("bigint")
    return F.struct(k.alias("Number"), F.concat(F.lit("level "), k.cast("string")).alias("Name"))


def _place() -> list[Column]:
    return [
        F.concat(F.lit("Area "), F.col("event_id").cast("string")).alias("ReportingArea"),
        F.lit("CA").alias("StateCode"),
        _coordinate(F.col("event_id"), 32.5, 7919, 170000).alias("Latitude"),
        _coordinate(F.col("event_id"), -124.5, 104729, 100000).alias("Longitude"),
        _parameter().alias("ParameterName"),
        F.col("value").alias("AQI"),
        _category().alias("Category"),
    ]


def _entries(
    spark: SparkSession, sf_dir: str, entry: Column, pretty: bool, numbered: bool
) -> DataFrame:
    """The entry of each event as JSON text, on request spread over lines or with its number."""
    text = F.to_json(entry, {"pretty": "true"} if pretty else {}).alias("entry")
    number = ["event_id"] if numbered else []
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(*number, text)


def arrays(entries: DataFrame, size: int, separator: str) -> DataFrame:
    """Arrays of up to ``size`` numbered entries each, as text without a closing object."""
    group = F.floor(F.col("event_id") / size).alias("group")
    joined = F.concat(F.lit("["), F.concat_ws(separator, F.collect_list("entry")), F.lit("]"))
    return entries.groupBy(group).agg(joined.alias("value")).select("value")


def observation_entries(
    spark: SparkSession, sf_dir: str, pretty: bool = False, numbered: bool = False
) -> DataFrame:
    """One observation entry per event, as JSON text."""
    entry = F.struct(
        F.date_format("ts", "yyyy-MM-dd").alias("DateObserved"),
        F.hour("ts").alias("HourObserved"),
        F.lit("PST").alias("LocalTimeZone"),
        *_place(),
    )
    return _entries(spark, sf_dir, entry, pretty, numbered)


def forecast_entries(
    spark: SparkSession, sf_dir: str, pretty: bool = False, numbered: bool = False
) -> DataFrame:
    """One forecast entry per event, as JSON text, with fields no table declares."""
    entry = F.struct(
        F.date_format("ts", "yyyy-MM-dd").alias("DateIssue"),
        F.date_format(F.date_add("ts", 1), "yyyy-MM-dd").alias("DateForecast"),
        *_place(),
        F.lit(False).alias("ActionDay"),
        F.lit("Smoke, \"haze\"\nand wind").alias("Discussion"),
    )
    return _entries(spark, sf_dir, entry, pretty, numbered)


def damaged_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per event: an entry, one cut off, or one with text for a number."""
    index = (
        F.when(F.col("event_type") == "error", "")
        .when(F.col("event_type") == "signup", '"high"}')
        .otherwise(F.concat(F.get_json_object("props", "$.k"), F.lit("}")))
    )
    area = F.col("event_id").cast("string")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.concat(F.lit('{"ReportingArea":"Area '), area, F.lit('","AQI":'), index).alias("value")
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored reply per event, with two entries or none; some failed."""
    reading = F.struct(
        "event_id", _parameter().alias("ParameterName"), F.col("value").alias("AQI"),
        _category().alias("Category"),
    )
    second = F.struct(
        "event_id", F.lit("second").alias("ParameterName"), F.lit(1.5).alias("AQI"),
        _category().alias("Category"),
    )
    kind = F.col("event_type")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.concat(F.lit("event/"), F.col("event_id").cast("string")).alias("url"),
        (F.col("event_id") % 3 + 1).alias("n_requests"),
        F.when(kind == "error", 503).otherwise(200).alias("status"),
        F.when(kind == "error", F.lit(None))
        .when(kind == "signup", "[]")
        .when(kind == "purchase", "no array")
        .otherwise(F.to_json(F.array(reading, second)))
        .alias("body"),
        F.when(kind == "error", "HTTP 503").alias("error"),
    )


def cut_off(replies: DataFrame) -> DataFrame:
    """Replies whose arrays of entries end in the middle of the last entry."""
    short = F.substring(F.col("body"), F.lit(1), F.length("body") - 5)
    return replies.withColumn("body", F.when(F.col("body").startswith("[{"), short).otherwise(F.col("body")))


class Overloaded:
    """A transport that gets too many calls for latitudes ending in an even digit, and otherwise another."""

    def __init__(self, transport: Transport) -> None:
        self.transport = transport

    def __call__(self, url: str) -> Reply:
        latitude = parse_qs(urlsplit(url).query)["latitude"][0]
        return Reply(429, None, "HTTP 429") if latitude[-1] in "02468" else self.transport(url)


class NoForecasts:
    """A transport that answers for observations only."""

    def __init__(self, transport: Transport) -> None:
        self.transport = transport

    def __call__(self, url: str) -> Reply:
        return Reply(503, None, "HTTP 503") if "forecast" in url else self.transport(url)


class CannedBytes:
    """An opener whose replies follow from the number in the URL; every third is no UTF-8."""

    status = 200

    def __init__(self, body: bytes = b"") -> None:
        self.body = body

    def __call__(self, url: str, timeout: float) -> CannedBytes:
        number = int(url.rpartition("/")[2])
        return CannedBytes(b"[\xff]" if number % 3 == 0 else f"[\"é {number}\"]".encode())

    def read(self) -> bytes:
        return self.body

    def __enter__(self) -> CannedBytes:
        return self

    def __exit__(self, *_: object) -> None:
        pass


class CannedApi:
    """A transport whose replies follow from the coordinates in the URL.

    Latitudes ending in 9 fail, in 8 have no readings, in 7 give a broken body; all others
    have an ozone and a PM2.5 entry.
    """

    def __call__(self, url: str) -> Reply:
        parts = urlsplit(url)
        query = {name: values[0] for name, values in parse_qs(parts.query).items()}
        latitude, longitude = query["latitude"], query["longitude"]
        if latitude.endswith("9"):
            return Reply(503, None, "HTTP 503")
        if latitude.endswith("8"):
            return Reply(200, "[]", None)
        if latitude.endswith("7"):
            return Reply(200, "<html>", None)
        place = {
            "ReportingArea": f"Area {latitude}",
            "StateCode": "CA",
            "Latitude": float(latitude),
            "Longitude": float(longitude),
        }
        category = {"Category": {"Number": 1, "Name": "Good"}}
        if "forecast" in parts.path:
            when = {"DateIssue": query["date"], "DateForecast": query["date"]}
            category.update(ActionDay=False, Discussion="Clear")
        else:
            when = {"DateObserved": query["date"] + " ", "HourObserved": 12, "LocalTimeZone": "PST"}
        readings = [("O3", int(float(latitude))), ("PM2.5", abs(float(longitude)))]
        return Reply(
            200,
            json.dumps(
                [when | place | {"ParameterName": p, "AQI": a} | category for p, a in readings]
            ),
            None,
        )
