"""Small helpers the operators of this package share."""

from __future__ import annotations

import math
import os
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from hazeline.workspace import fresh_path

#: Words are runs of anything but ASCII white space; used by Spark and by DuckDB alike.
WORDS = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder.

    Tasks import this package. On a cluster it comes with the job (``--py-files``) or is installed;
    the tasks of a local session are told where the driver has it.
    """
    context = spark.sparkContext
    if context.master.startswith("local"):
        root = str(Path(__file__).resolve().parents[2])
        paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
        if root not in paths:
            context.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read back.

    Cuts the lineage: a lost executor costs its own tasks, not all that led here.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(name: str, taken: Iterable[str]) -> str:
    """A column name like ``name`` that none of those taken is, in any case."""
    known = {column.lower() for column in taken}
    while name.lower() in known:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    """The number of shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def power_of_two(least: int) -> int:
    """The exponent of the smallest power of two that is at least ``least``."""
    return max(0, math.ceil(math.log2(max(1, least))))
