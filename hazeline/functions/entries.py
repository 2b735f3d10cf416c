"""Entries of arrays, typed rows from their text, and which of these hold anything."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazeline.schemas import with_corrupt


def parse_json(text: Column, schema: StructType) -> Column:
    """Generate the columns of ``schema`` and ``_corrupt_record`` from each JSON text.

    Going through a one-element array lets Spark parse every text just once. Selected as a
    plain struct instead, each later filter on a field would parse the text again, and for
    that field alone, which can change what counts as corrupt.
    """
    return F.inline(F.array(F.from_json(text, with_corrupt(schema))))


def hide_strings(text: Column) -> Column:
    """The text with each character inside a JSON string, and each escape, as ``_``; nothing moves.

    What then looks like a bracket or a comma is one. An unclosed string goes to the end.
    """
    parts = F.split(F.regexp_replace(text, r"(?s)\\.", "__"), '"', -1)
    hidden = F.transform(
        parts, lambda part, at: F.when(at % 2 == 1, F.repeat(F.lit("_"), F.length(part))).otherwise(part)
    )
    return F.concat_ws('"', hidden)


def complete_end(array: Column) -> Column:
    """The number of characters up to the end of the last complete entry of an array; 0 if there is none.

    An entry is complete when it is closed, or a comma follows it.
    """
    tokens = F.regexp_extract_all(hide_strings(array), F.lit(r"[\[\]{},]|[^\[\]{},]+"), 0)
    zero = F.lit(0)
    start = F.struct(zero.alias("at"), zero.alias("depth"), zero.alias("end"))

    def step(seen: Column, token: Column) -> Column:
        after = seen.at + F.length(token)
        opens, closes = token.isin("[", "{"), token.isin("]", "}")
        depth = seen.depth + F.when(opens, 1).when(closes, -1).otherwise(0)
        end = (
            F.when(closes & (depth == 1), after)
            .when((token == ",") & (depth == 1), seen.at)
            .otherwise(seen.end)
        )
        return F.struct(after.alias("at"), depth.alias("depth"), end.alias("end"))

    return F.aggregate(tokens, start, step, lambda seen: seen.end)


def opened_array(text: str) -> Column:
    """Generate ``texts``, the entries of the array in a text column, and ``rest``, what of it is no entry.

    A text that is no array has null ``texts`` and no ``rest``. One that is cut off has the complete entries, and
    the remainder as ``rest``; the common case, a whole array, is parsed once and not searched.
    """
    return F.inline(F.array(_salvaged(F.col(text))))


def _salvaged(text: Column) -> Column:
    def entries(array: Column) -> Column:
        return F.from_json(array, "array<string>")

    def cut(end: Column) -> Column:
        upto = F.when(end > 0, F.concat(F.substring(text, F.lit(1), end), F.lit("]")))
        rest = F.ltrim(F.substring(text, end + 1, F.length(text)), F.lit(" \t\r\n,"))
        return F.struct(entries(upto).alias("texts"), rest.alias("rest"))

    # One-element arrays keep what they hold from being computed once per use.
    def once(value: Column, then: Callable[[Column], Column]) -> Column:
        return F.get(F.transform(F.array(value), then), 0)

    nothing = F.struct(F.lit(None).cast("array<string>").alias("texts"), F.lit(None).cast("string").alias("rest"))

    def salvage(found: Column) -> Column:
        return F.when(found.texts.isNotNull(), found).otherwise(nothing)

    def choose(whole: Column) -> Column:
        complete = F.struct(whole.alias("texts"), F.lit(None).cast("string").alias("rest"))
        broken = F.when(F.ltrim(text).startswith("["), once(complete_end(text), lambda end: once(cut(end), salvage)))
        return F.when(whole.isNotNull(), complete).otherwise(F.coalesce(broken, nothing))

    return once(entries(text), choose)


def whole_rows(rows: DataFrame) -> DataFrame:
    """The same rows, with every column read whatever a query goes on to select.

    Spark's file readers check only the columns they have to produce. Packing the row makes
    that all of them, so that a selection does not change which records count as corrupt.
    """
    return rows.select(F.inline(F.array(F.struct("*"))))


def any_value(names: Sequence[str]) -> Column:
    """Whether at least one of the named columns is not null."""
    return reduce(or_, [F.col(f"`{name}`").isNotNull() for name in names])
