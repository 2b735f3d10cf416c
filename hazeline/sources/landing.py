"""Raw files and text in and out of the landing zone."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline import files
from hazeline.sinks import replacing

# Names of files that Spark's text reader decompresses, and what it leaves out at a start.
COMPRESSED = r"\.(gz|bz2|deflate|lz4|snappy|zst|zstd)$"
BYTE_ORDER_MARK = "EFBBBF"


def land_raw(spark: SparkSession, source: str, target: str) -> None:
    """Copy text files from any Hadoop file system URI to another, overwriting the target, as one table of lines.

    Large files are split over the executors. The bytes of each line are copied as they are,
    without decoding, so any single-byte or UTF-8 encoding survives. The files are not: the last
    line gets a line break if it had none, a UTF-8 byte-order mark at the start of a file is left
    out, and compressed input is stored decompressed. ``land_files`` keeps all of that.
    """
    lines = spark.read.option("lineSep", "\n").text(source)
    replacing(spark, target, lines.write.option("lineSep", "\n").text)


def land_files(spark: SparkSession, source: str, target: str) -> None:
    """Copy files from any Hadoop file system URI to a folder on another, byte by byte, replacing the folder.

    Files keep their names, which must differ. Executors read a large file in ranges, and each writes what it
    read: such a file becomes a folder of that name whose pieces, in the order of their names, are its bytes.
    Spark's text reader and writer know lines only. What they would change is made up for: a byte-order mark is
    put back in front, and a last line without a line break is written with its own last byte as the line separator.
    A compressed file, which they would open, is copied whole by one task, and can have 2 GB at most; one
    task also holds a line, so a file of other binary data should have a line break now and then. The
    driver gets names and lengths, never contents.
    """
    listed = files.listing(spark, source)
    if not listed:
        raise FileNotFoundError(source)
    names = [path.rpartition("/")[2] for path, *_ in listed]
    if len(set(names)) < len(names):
        raise ValueError(f"files of the same name in {source}")
    replacing(spark, target, lambda staged: _land(spark, listed, names, staged))


def _land(spark: SparkSession, listed: list[tuple[str, int, str]], names: list[str], staged: str) -> None:
    numbers = spark.createDataFrame(
        [(number, *file) for number, file in enumerate(listed)], "n long, of_file string, bytes long, uri string"
    )
    plain = [path for path, length, _ in listed if length and not re.search(COMPRESSED, path)]
    packed = [path for path, length, _ in listed if length and re.search(COMPRESSED, path)]
    work = files.beside(staged, "pieces")
    try:
        if plain:
            lines = _numbered_lines(spark, plain, numbers)
            body = lines.filter("NOT ends").sortWithinPartitions("n", "block", "at")
            body.select("n", F.col("line").cast("string")).write.partitionBy("n").option("lineSep", "\n").text(f"{work}/body")
            _write_exactly(lines.filter("ends").select("n", "line"), f"{work}/end")
        if packed:
            whole = spark.read.format("binaryFile").load(packed).select("path", F.col("content").alias("line"))
            _write_exactly(whole.join(F.broadcast(numbers), F.col("path") == F.col("of_file")).select("n", "line"), f"{work}/whole")
        for number, name in enumerate(names):
            _put_together(spark, work, number, listed[number][1], f"{staged}/{name}")
            if files.size(spark, f"{staged}/{name}") != listed[number][1]:
                raise OSError(f"{listed[number][0]} changed while it was copied")
    finally:
        files.delete(spark, work)


def _numbered_lines(spark: SparkSession, paths: list[str], numbers: DataFrame) -> DataFrame:
    """``n, block, at, line, ends``: the bytes of each line, in order, and whether no line break follows it.

    The length of a file tells what the reader left out: a byte-order mark of three bytes, or the line break that
    it takes every line to have.
    """
    text = spark.read.option("lineSep", "\n").text(paths)
    lines = text.select(
        F.col("value").cast("binary").alias("line"), F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"),
    )
    place = F.struct("block", "at")
    facts = (
        lines.groupBy("file")
        .agg(F.sum(F.octet_length("line") + 1).alias("read"), F.min(place).alias("first"), F.max(place).alias("last"))
        .join(F.broadcast(numbers), F.col("file") == F.col("uri"))
        .select("n", "uri", "first", "last", (F.col("bytes") - F.col("read")).alias("more"))
    )
    line = F.when(
        (place == F.col("first")) & (F.col("more") >= 2), F.concat(F.unhex(F.lit(BYTE_ORDER_MARK)), F.col("line"))
    ).otherwise(F.col("line"))
    # No line break is missing (0), the last one is (-1), a mark is (3) or both are (2).
    ends = (place == F.col("last")) & F.col("more").isin(-1, 2)
    joined = lines.join(F.broadcast(facts), F.col("file") == F.col("uri"))
    return joined.select("n", "block", "at", line.alias("line"), ends.alias("ends"))


def _write_exactly(rows: DataFrame, path: str) -> None:
    """A file ``n=…`` with the bytes of each row's ``line``: all but the last, then that as the separator."""
    size = F.octet_length("line")
    split = rows.select(
        "n", F.substring(F.col("line"), F.lit(1), size - 1).cast("string").alias("value"),
        F.hex(F.substring(F.col("line"), size, F.lit(1))).alias("byte"),
    )
    for (byte,) in split.select("byte").distinct().collect():
        writer = split.filter(F.col("byte") == byte).select("n", "value").write.mode("append").partitionBy("n")
        # In this encoding each character is the byte of its number.
        writer.option("encoding", "ISO-8859-1").option("lineSep", chr(int(byte, 16))).text(path)


def _put_together(spark: SparkSession, work: str, number: int, length: int, place: str) -> None:
    """Move the pieces of a file to its place: one as it is, several as a folder."""
    body, end, whole = (files.names(spark, f"{work}/{kind}/n={number}") for kind in ("body", "end", "whole"))
    found = [f"{work}/body/n={number}/{name}" for name in sorted(body)]
    found += [f"{work}/end/n={number}/{name}" for name in end] + [f"{work}/whole/n={number}/{name}" for name in whole]
    if not found:
        # An empty file, or a byte-order mark without any line.
        files.create(spark, place, bytes.fromhex(BYTE_ORDER_MARK) if length else b"")
    elif len(found) == 1:
        files.move(spark, found[0], place)
    else:
        for at, piece in enumerate(found):
            files.move(spark, piece, f"{place}/part-{at:08d}")


def list_source_files(spark: SparkSession, source: str) -> DataFrame:
    """Path, modification time and length of the files behind a URI; contents stay unread."""
    files = spark.read.format("binaryFile").load(source)
    return files.select("path", "modificationTime", "length")


def scan_gz_text(spark: SparkSession, path: str) -> DataFrame:
    """Lines of gzip-compressed UTF-8 text; no lines where nothing exists at the path."""
    try:
        return spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "value string")
