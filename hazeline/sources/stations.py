"""Station files: headerless text, one station per line, fields separated by pipes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hazeline.functions import decode_line, split_fields, whole_rows
from hazeline.schemas import STATION, with_corrupt


def scan_stations(
    spark: SparkSession, path: str, encoding: str = "UTF-8", malformed: bool = False
) -> DataFrame:
    """Scan with the declared schema; empty fields are null and blank lines are skipped.

    Unparsable numbers become null, short lines are padded with nulls and surplus fields are
    dropped. With ``malformed=True`` an extra ``_corrupt_record`` column holds the text of
    every such line.
    """
    schema = with_corrupt(STATION) if malformed else STATION
    reader = spark.read.schema(schema).option("sep", "|").option("encoding", encoding)
    rows = reader.csv(path)
    if malformed:
        rows = whole_rows(rows)
    return rows


def scan_stations_raw(
    spark: SparkSession, path: str, encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Scan without types or quoting: every field a string, empty fields ``''``.

    Blank lines stay as one empty field. ``fields`` holds the whole split line; the station
    columns take its first fourteen values, null where the line is shorter.
    """
    lines = spark.read.text(path).select(decode_line(F.col("value"), encoding).alias("line"))
    fields = lines.select(split_fields(F.col("line")).alias("fields"))
    named = [F.get("fields", i).alias(name) for i, name in enumerate(STATION.names)]
    return fields.select("fields", *named)


def stations_from_rows(spark: SparkSession, rows: Iterable[Sequence[str]]) -> DataFrame:
    """A small in-memory list of split lines as a frame of strings, named by position."""
    schema = StructType([StructField(name, StringType(), True) for name in STATION.names])
    return spark.createDataFrame(list(rows), schema)
