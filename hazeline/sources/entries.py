"""Files of JSON entries, in two layouts.

*JSON Lines* has one entry per line. An *array file* starts with ``[``, has one entry and a
comma per line, then an empty object that closes the list, then ``]``. The brackets may also
stand on the lines of entries, several entries on a line, or a whole array on one.

Both scans add ``_corrupt_record``, the text of entries that did not fit the schema; see
``split_rejects`` in ``hazeline.operators``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazeline.functions import opened_array, whole_rows
from hazeline.schemas import CORRUPT, with_corrupt
from hazeline.sources.documents import scan_documents
from hazeline.workspace import scratch

LAYOUTS = ("entries", "document")
# A closing brace with something behind it that cannot belong to the same entry.
AFTER_AN_ENTRY = r'\}(?!\s*(,\s*"[^"\\]*"\s*:|[}\]]|,?\s*$))'


def scan_json_lines(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """Scan JSON Lines. Without a schema, one distributed pass infers it first."""
    schema = schema or infer_entry_schema(spark, path)
    return whole_rows(spark.read.schema(with_corrupt(schema)).json(path))


def scan_json_array(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    layout: str = "entries",
    keep_terminator: bool = False,
) -> DataFrame:
    """Scan array files.

    ``layout="entries"`` relies on entries not being broken over lines and therefore splits
    large files over many tasks. It recognises the closing empty object by its missing comma,
    so an entry that happens to be empty is kept; a file cut off in the middle still yields
    its complete entries. A line that is a complete array, without a comma behind it, is taken
    apart, and there an empty object in last place is the closing one; an array followed by a
    comma is an entry, and no object. A line of any other form ends up in ``_corrupt_record``,
    so does each line of a pretty-printed array.

    ``layout="document"`` reads arrays formatted in any way, with strings in double quotes; a large file
    feeds many tasks, too. There, the closing object is an empty one in last place. The remainder of an array that
    is cut off ends up in ``_corrupt_record``, and so does what stands outside of arrays.

    Without a schema, one distributed pass infers it first.
    ``keep_terminator=True`` returns the closing object as an all-null row.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    if schema is None:
        schema = infer_entry_schema(spark, path, layout)
    return _parse_texts(_texts(spark, path, layout, keep_terminator), schema)


def _texts(spark: SparkSession, path: str, layout: str, keep_terminator: bool) -> DataFrame:
    """``entry, broken``: the text of each entry, and whether it is something else that stood there."""
    if layout == "entries":
        return _entries_of_arrays(_arrays_of_lines(spark, path, keep_terminator))
    found = scan_documents(spark, path)
    if not keep_terminator:
        found = found.filter(~(F.col("last") & F.col("text").rlike(r"^\{\s*\}$")))
    return found.select(F.col("text").alias("entry"), "broken")


def _without_terminator(texts: Column) -> Column:
    before_last = F.size(texts) - 1
    closed = F.get(texts, before_last) == "{}"
    return F.when(closed, F.slice(texts, F.lit(1), before_last)).otherwise(texts)


def _arrays_of_lines(spark: SparkSession, path: str, keep_terminator: bool) -> DataFrame:
    """``value``, ``texts``, the entries it holds, and ``rest`` of each line that is not just a bracket."""
    frame = ["", "[", "]"] if keep_terminator else ["", "[", "]", "{}"]
    line = F.trim("value")
    whole = line.startswith("[") & line.endswith("]")
    # A bracket that opens or closes the array on the line of its first or last entry.
    opens = line.startswith("[") & ~line.rlike(r"\]\s*,?$")
    closes = ~line.startswith("[") & line.rlike(r"\}\s*\]$")
    bare = (
        F.when(opens, F.ltrim(F.substring(line, F.lit(2), F.length(line))))
        .when(closes, F.rtrim(F.substring(line, F.lit(1), F.length(line) - 1)))
        .otherwise(F.col("value"))
    )
    lines = spark.read.text(path).filter(~line.isin(frame))
    lines = lines.withColumns({"_bare": bare, "_whole": whole})
    if not keep_terminator:
        lines = lines.filter(F.col("_whole") | (F.trim("_bare") != "{}"))
    texts = _entries_of_line(F.col("_bare"), F.col("_whole"))
    # Out of a generator, so that what follows doesn't parse the line again.
    opened = lines.select("value", "_whole", F.inline(F.array(F.struct(texts.alias("_texts")))))
    # An array that is cut off in the line that opens it.
    cut = F.when(F.trim("value").startswith("[") & F.col("_texts").isNull(), F.trim("value"))
    opened = opened.withColumn("_cut", cut).select("*", opened_array("_cut"))
    found = F.coalesce("_texts", "texts")
    if not keep_terminator:
        found = F.when(F.col("_whole"), _without_terminator(found)).otherwise(found)
    return opened.select("value", found.alias("texts"), "rest")


def _entries_of_line(line: Column, whole: Column) -> Column:
    """The entries a line holds: nearly always one, which then needs no parsing to be found."""
    array = F.concat(F.lit("["), F.rtrim(line, F.lit(", ")), F.lit("]"))
    one = ~whole & F.ltrim(line).startswith("{") & ~line.rlike(AFTER_AN_ENTRY)
    parsed = F.from_json(F.when(whole, line).otherwise(array), "array<string>")
    return F.when(one, F.array(line)).otherwise(parsed)


def _entries_of_arrays(arrays: DataFrame) -> DataFrame:
    """``entry, broken`` from ``texts``, the entries of each array; a ``value`` without them is broken.

    Taking the array apart first keeps what follows a broken or badly typed entry. Spark's
    multi-line reader would also copy the text of the whole file to each row of such a file.
    """
    def entry(text: Column, broken: bool) -> Column:
        return F.struct(text.alias("entry"), F.lit(broken).alias("broken"))

    entries = F.transform("texts", lambda text: entry(text, False))
    more = F.when(F.col("rest") != "", F.array(entry(F.col("rest"), True))).otherwise(F.array())
    broken = F.array(entry(F.col("value"), True))
    return arrays.select(F.inline(F.when(F.col("texts").isNull(), broken).otherwise(F.concat(entries, more))))


def _parse_texts(texts: DataFrame, schema: StructType) -> DataFrame:
    nothing = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema]
    text = F.coalesce("entry", F.lit("null"))
    parsed = F.from_json(text, with_corrupt(schema))
    row = F.when(F.col("broken"), F.struct(*nothing, text.alias(CORRUPT))).otherwise(parsed)
    return texts.select(F.inline(F.array(row)))


def infer_entry_schema(
    spark: SparkSession, path: str, layout: str = "entries"
) -> StructType:
    """Infer the fields of all entries, in alphabetical order.

    This reads the whole input once, and writes its entries as lines, which Spark's reader then infers from.
    Keep the result and pass it to later scans, both to save that pass and because the inferred
    types may differ from one run to the next.
    """
    seen = Observation()
    entries = _texts(spark, path, layout, keep_terminator=False).filter("NOT broken").select(
        # Line breaks stand between the parts of an entry, never inside a string.
        F.translate(F.coalesce("entry", F.lit("null")), "\r\n", "  ").alias("value")
    )
    fields = []
    with scratch(spark) as fresh:
        lines = fresh("lines")
        entries.observe(seen, F.count(F.lit(1)).alias("entries")).write.text(lines)
        if seen.get["entries"]:
            fields = [field for field in spark.read.json(lines).schema.fields if field.name != CORRUPT]
    if not fields:
        raise ValueError(f"no entries to infer a schema from in {path}; declare one")
    return StructType(fields)
