"""Entry files to typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from hazeline.plans.rejects import write_with_rejects
from hazeline.schemas import FORECAST, OBSERVATION
from hazeline.sources import scan_json_array, scan_json_lines

FORMS = ("lines", "array")


def _scan(
    spark: SparkSession,
    source: str,
    schema: StructType | None,
    form: str,
    keep_terminator: bool,
    layout: str,
) -> DataFrame:
    if form not in FORMS:
        raise ValueError(f"form must be one of {FORMS}, not {form!r}")
    if form == "lines":
        return scan_json_lines(spark, source, schema)
    return scan_json_array(spark, source, schema, layout, keep_terminator)


def transform_observations(
    spark: SparkSession,
    source: str,
    target: str,
    rejects: str,
    schema: StructType | None = OBSERVATION,
    form: str = "lines",
    keep_terminator: bool = False,
    layout: str = "entries",
) -> int:
    """Store observation entries as a table; returns the number of rejects.

    ``schema=None`` keeps every field with its inferred type. ``form="array"`` reads array
    files in the given ``layout`` of ``scan_json_array``, and ``keep_terminator`` then keeps their
    closing object as an all-null row. Input of which nothing can be used is an error and leaves
    the table as it is.
    """
    rows = _scan(spark, source, schema, form, keep_terminator, layout)
    return write_with_rejects(rows, target, rejects)


def transform_forecasts(
    spark: SparkSession,
    source: str,
    target: str,
    rejects: str,
    form: str = "lines",
    keep_terminator: bool = False,
    layout: str = "entries",
) -> int:
    """Store forecast entries with their declared fields; returns the number of rejects."""
    rows = _scan(spark, source, FORECAST, form, keep_terminator, layout)
    return write_with_rejects(rows, target, rejects)
