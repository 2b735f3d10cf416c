"""Writers. Each replaces what the target path held before, unless told to append.

To replace, the new files are written beside the target and take its place when all of them are there: a
write that fails leaves the old ones, and a frame may be written over the table it is read from.
On file systems that rename folders in one step, readers meet no half-written table, and none at all for a
moment at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline import files as fs


def replacing(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a fresh folder, then put that in the place of ``path``."""
    staged = fs.beside(path, "new")
    try:
        write(staged)
        fs.replace(spark, staged, path)
    except BaseException:
        fs.delete(spark, staged)
        raise


def _save(df: DataFrame, path: str, mode: str, write: Callable[[DataFrame, str, str], None]) -> None:
    if mode == "overwrite":
        replacing(df.sparkSession, path, lambda staged: write(df, staged, "error"))
    else:
        write(df, path, mode)


def write_table(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite") -> None:
    """Write Parquet; ``files`` spreads the rows evenly over that many files first."""
    if files is not None:
        df = df.repartition(files)
    _save(df, path, mode, lambda rows, place, how: rows.write.mode(how).parquet(place))


def write_entries(entries: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the ``entry`` texts as JSON Lines, with all their fields.

    The result splits by line and needs no closing entry.
    """
    lines = entries.select(F.coalesce("entry", F.lit("null")).alias("value"))
    _save(lines, path, mode, lambda rows, place, how: rows.write.mode(how).text(place))


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write typed rows as JSON Lines; null fields are left out."""
    _save(df, path, mode, lambda rows, place, how: rows.write.mode(how).json(place))


def write_json_array(
    entries: DataFrame, path: str, files: int | None = None, entries_per_file: int | None = None
) -> None:
    """Write the ``entry`` texts as array files, one or more complete arrays per partition.

    Meant for consumers that expect this layout; ``write_entries`` is the better choice
    otherwise. ``files`` spreads the entries over that many partitions first. Consumers that
    read an array as one document hold all of it in memory: ``entries_per_file`` limits its
    size without moving any entry.
    """
    if entries_per_file is not None and entries_per_file < 1:
        raise ValueError("entries_per_file must be at least 1")

    def frame(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines(values: list[str] | pa.Array) -> pa.RecordBatch:
            return pa.record_batch({"value": values})

        written = 0
        yield lines(["["])
        for batch in batches:
            rest = batch.column("value")
            while len(rest):
                if written == entries_per_file:
                    yield lines(["{}", "]", "["])
                    written = 0
                room = len(rest) if entries_per_file is None else entries_per_file - written
                part, rest = rest.slice(0, room), rest.slice(room)
                yield lines(part)
                written += len(part)
        yield lines(["{}", "]"])

    text = F.coalesce("entry", F.lit("null"))
    values = entries.select(F.concat(text, F.lit(",")).alias("value"))
    if files is not None:
        values = values.repartition(files)
    writer = values.mapInArrow(frame, "value string").write
    if entries_per_file is not None:
        # Spark starts the next file after this many lines: a full array with its three others.
        writer = writer.option("maxRecordsPerFile", entries_per_file + 3)
    replacing(entries.sparkSession, path, writer.text)
