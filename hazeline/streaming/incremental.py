"""Recurring loads that read each landed file once, or only the latest delivery."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazeline.schemas import with_corrupt
from hazeline.sinks import write_table
from hazeline.sources import list_source_files, scan_json_lines

#: Input that one file of a snapshot is made of.
BYTES_PER_FILE = 1 << 28


def load_increment(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    schema: StructType,
    max_files: int | None = None,
) -> None:
    """Append the entries of all JSON Lines files that arrived since the last call.

    Works through the backlog, in batches of ``max_files`` files if given, and stops. The
    checkpoint and the table's log make each file count exactly once, also after a failure.
    The table keeps ``_corrupt_record``, so no entry is lost; ``split_rejects`` separates them.
    """
    reader = spark.readStream.schema(with_corrupt(schema))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.json(landing)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(table)
    )
    query.awaitTermination()


def load_latest(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    schema: StructType,
    folders: str = "*",
    bytes_per_file: int = BYTES_PER_FILE,
) -> None:
    """Replace the table by the latest delivery of JSON Lines files, if any file arrived since the last call.

    A delivery is a folder under ``landing``, the latest the one with the greatest name; ``folders`` is a
    pattern of the names that count. The checkpoint tells which files are new. What the table then holds
    follows from the landing folder alone, not from the batch: a batch that is repeated after a failure gives the
    same rows, a late file of an old delivery changes nothing, and one of the latest is added. The table
    has a file per ``bytes_per_file`` of input, however many landed, and keeps ``_corrupt_record``.
    """
    source = f"{landing.rstrip('/')}/{folders}"

    def replace(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        landed = list_source_files(spark, source).withColumn("folder", _folder(F.col("path")))
        name = _name(F.col("folder"))
        newest = landed.groupBy("folder").agg(F.sum("length").alias("bytes")).orderBy(name.desc(), "folder").first()
        rows = scan_json_lines(spark, newest.folder, schema)
        write_table(rows, table, files=max(1, math.ceil(newest.bytes / bytes_per_file)))

    query = (
        spark.readStream.format("text").load(source)
        .writeStream.foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def _name(folder: Column) -> Column:
    return F.element_at(F.split(folder, "/"), -1)
