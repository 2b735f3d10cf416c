"""Array files in any formatting, read by many tasks each.

No JSON string holds a line break, so lines can be read anywhere in a file, and what each changes in the depth
of brackets follows from the line alone. The changes of a file's blocks, added up, give the depth at the start of
each block; a task that reads a block then knows where an entry begins and ends in it. What lies before
the first and behind the last of these places belongs to entries that cross the edge of a block; those pieces,
two per block, are put together afterwards.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARKS = re.compile(r'\\.|"(?:[^"\\]|\\.)*"|[\[\]{},]')
#: Pieces in the order in which a block has them.
HEAD, MIDDLE, TAIL, ENTRY, STRAY = range(5)
SPACE = " \t\r\n"
#: ... and a byte-order mark, in front of a file.
BLANK = SPACE + "\ufeff"
PIECES = "kind int, run bigint, text string, last boolean"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Each line with its file and block, a number for both, and whether this is all of the file."""
    place = F.col("_metadata")
    lines = spark.read.text(path).select(
        "value", place.file_path.alias("file"), place.file_block_start.alias("block"),
        (place.file_block_length >= place.file_size).alias("alone"),
    )
    return lines.withColumn("run", F.xxhash64("file", "block"))


def _with_brackets(lines: DataFrame) -> DataFrame:
    """Add how many brackets each line opens and closes outside of strings."""
    value = F.col("value")
    plain = F.when(value.contains("\\"), F.regexp_replace(value, r"(?s)\\.", "")).otherwise(value)
    bare = F.when(plain.contains('"'), F.regexp_replace(plain, '"[^"]*"', "")).otherwise(plain)

    def number(one: str, other: str) -> Column:
        # Most lines have none, which needs no regular expression to be seen.
        counted = F.regexp_count(bare, F.lit(rf"[\{one}\{other}]"))
        return F.when(value.contains(one) | value.contains(other), counted).otherwise(0)

    return lines.withColumns({"opened": number("[", "{"), "closed": number("]", "}")})


def _starts(lines: DataFrame) -> DataFrame:
    """Per block of files of several: the depth at its start, and whether the file begins like an array."""
    # As a number, so that the lines are hashed by block and not sorted.
    code, bare = F.ascii(F.ltrim("value")), F.ltrim(F.col("value"), F.lit(BLANK))
    first = F.when(code.isin(0, *map(ord, BLANK)), F.when(bare != "", F.ascii(bare))).otherwise(code)
    parts = _with_brackets(lines.filter("NOT alone"))
    placed = parts.withColumns({"first": first, "at": F.monotonically_increasing_id()})
    at = F.when(F.col("first").isNotNull(), F.col("at"))
    blocks = placed.groupBy("file", "block").agg(
        F.sum(F.col("opened") - F.col("closed")).alias("change"), F.min_by("first", at).alias("first")
    )
    by_block = Window.partitionBy("file").orderBy("block")
    whole = by_block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.sum("change").over(by_block.rowsBetween(Window.unboundedPreceding, -1))
    return blocks.select(
        F.xxhash64("file", "block").alias("of_run"),
        F.col("file").alias("of_file"),
        F.col("block").alias("of_block"),
        F.coalesce(before, F.lit(0)).alias("depth"),
        (F.first("first", ignorenulls=True).over(whole) == ord("[")).alias("is_array"),
    )


class _Block:
    """Cuts the lines of one block into pieces: either those within it or those at its edges."""

    def __init__(self, run: int, depth: int | None, is_array: bool | None, alone: bool, edges: bool) -> None:
        self.run, self.depth, self.is_array = run, depth or 0, is_array
        self.alone, self.edges = alone, edges
        self.begun_before = bool(is_array and depth)
        self.parts: list[str] = []
        self.cut = False

    def piece(self, kind: int, text: str, last: bool | None) -> tuple:
        return kind, self.run, text, last

    def lines(self, column: pa.Array, opened: np.ndarray, closed: np.ndarray) -> Iterator[tuple]:
        if self.is_array is None:
            # The first block of a file tells by its first character; blank lines tell nothing.
            first = next((text for value in column if (text := value.as_py().strip(BLANK))), None)
            self.is_array = first.startswith("[") if first else None
        after = self.depth + np.cumsum(opened - closed)
        before = after - (opened - closed)
        # Only a line on which the depth can get to that of the array has an end of an entry.
        ends = np.flatnonzero(before - closed <= 1) if self.is_array else np.zeros(0, np.int64)
        seen, skipped = 0, 0
        if self.edges and not self.begun_before:
            # Only what follows the last end matters any more.
            skipped = seen = self.last_end(column, ends, before)
            ends = ends[ends >= seen]
        values = column.slice(skipped).to_pylist()
        for at in ends.tolist():
            self.parts.extend(values[seen - skipped : at - skipped])
            yield from self.line(values[at - skipped], int(before[at]))
            seen = at + 1
        self.parts.extend(values[seen - skipped :])
        self.depth = int(after[-1])

    def last_end(self, column: pa.Array, ends: np.ndarray, before: np.ndarray) -> int:
        """The last line on which an entry, or what is none, ends; 0 if there is no such line."""
        kept, self.parts = self.parts, []
        for at in ends[::-1].tolist():
            self.cut = False
            for _ in self.line(column[at].as_py(), int(before[at])):
                pass
            self.parts = []
            if self.cut:
                return at
        self.parts = kept
        return 0

    def line(self, value: str, depth: int) -> Iterator[tuple]:
        start = 0
        for mark in MARKS.finditer(value):
            sign = mark[0]
            if sign in "[{":
                if depth == 0:
                    yield from self.stray(value[start : mark.start()])
                    start = mark.end() if sign == "[" else mark.start()
                depth += 1
            elif sign in "]}":
                depth -= 1
                if depth == 0:
                    yield from self.entry(value[start : mark.start()], True)
                    start = mark.end()
            elif sign == "," and depth == 1:
                yield from self.entry(value[start : mark.start()], False)
                start = mark.end()
        self.parts.append(value[start:])

    def taken(self, text: str) -> str:
        self.cut = True
        found = "\n".join([*self.parts, text])
        self.parts = []
        return found

    def entry(self, text: str, last: bool) -> Iterator[tuple]:
        kind, self.begun_before = (HEAD if self.begun_before else ENTRY), False
        if self.edges == (kind == HEAD):
            found = self.taken(text)
            if kind == HEAD or found.strip():
                yield self.piece(kind, found, last)
        self.parts, self.cut = [], True

    def stray(self, text: str) -> Iterator[tuple]:
        found = self.taken(text)
        if found.strip() and not self.edges:
            yield self.piece(STRAY, found, None)

    def end(self) -> Iterator[tuple]:
        if not self.is_array or self.depth <= 0 or self.alone:
            yield from self.stray(self.parts.pop() if self.parts else "")
        elif self.edges:
            yield self.piece(MIDDLE if self.begun_before else TAIL, "\n".join(self.parts), None)


def _pieces(lines: DataFrame, edges: bool) -> DataFrame:
    """Entries that lie in one block and what is none; or, with ``edges``, the pieces at the edges of blocks."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.int64(), pa.string(), pa.bool_()]
        names = ["kind", "run", "text", "last"]

        def result(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[]] * len(types)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        current = None
        for batch in batches:
            rows: list[tuple] = []
            column = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in ("opened", "closed", "run")}
            values = batch.column("value")
            bounds = [0, *(np.flatnonzero(np.diff(column["run"])) + 1).tolist(), len(values)]
            for a, b in zip(bounds, bounds[1:]):
                if a == b:
                    continue
                run = int(column["run"][a])
                if current is None or current.run != run:
                    if current is not None:
                        rows += current.end()
                    told = (batch.column(name)[a].as_py() for name in ("depth", "is_array", "alone"))
                    current = _Block(run, *told, edges)
                opened, closed = (column[name][a:b].astype(np.int64) for name in ("opened", "closed"))
                rows += current.lines(values.slice(a, b - a), opened, closed)
            yield result(rows)
        if current is not None:
            yield result(list(current.end()))

    picked = lines.select("value", "run", "opened", "closed", "depth", "is_array", "alone")
    return picked.mapInArrow(cut, PIECES)


def scan_documents(spark: SparkSession, path: str) -> DataFrame:
    """``text, last, broken``: each entry of the arrays, whether it is its array's last, or else what is no entry.

    ``broken`` are the remainder of an array that is cut off, what stands outside of arrays, and the text of files
    that don't begin like an array, per block. The entries before a break are entries. Brackets are counted in
    a pass of their own in files of several blocks, which a third pass reads for what crosses their edges.
    The table of blocks is broadcast: a row per ``spark.sql.files.maxPartitionBytes`` of such files.
    """
    lines = _lines(spark, path)
    starts = F.broadcast(_starts(lines))
    at = (F.col("run") == F.col("of_run")) & (F.col("block") == F.col("of_block"))
    placed = _with_brackets(lines.join(starts, at, "left"))
    parts = _with_brackets(lines.filter("NOT alone").join(starts, at).filter("is_array"))
    edges = _pieces(parts, True).join(starts, F.col("run") == F.col("of_run"))
    whole = _pieces(placed, False).select(
        F.trim("text", F.lit(SPACE)).alias("text"), F.coalesce("last", F.lit(False)).alias("last"),
        (F.col("kind") == STRAY).alias("broken"),
    )
    return whole.unionByName(_joined(edges))


def _joined(edges: DataFrame) -> DataFrame:
    """Entries that cross the edges of blocks: each begins with a tail and ends with a head."""
    in_file = Window.partitionBy("of_file").orderBy("of_block", "kind")
    begun = F.last(F.when(F.col("kind") == TAIL, F.col("of_block")), ignorenulls=True).over(
        in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    parts = F.sort_array(F.collect_list(F.struct("of_block", "kind", "text")))
    entries = edges.withColumn("begun", begun).groupBy("of_file", "begun").agg(
        F.trim(F.concat_ws("\n", F.transform(parts, lambda part: part.text)), F.lit(SPACE)).alias("text"),
        F.max(F.coalesce("last", F.lit(False))).alias("last"),
        (F.max(F.when(F.col("kind") == HEAD, 1)).isNull()).alias("broken"),
    )
    return entries.filter("text <> ''").select("text", "last", "broken")
