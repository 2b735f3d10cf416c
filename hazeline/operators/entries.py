"""From response bodies to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazeline.functions import any_value, opened_array, parse_json
from hazeline.schemas import CORRUPT
from hazeline.sources.web import OK

# Characters of an array's remainder that its reject quotes.
REST = 200
COPIES_IN_PLACE = 100
COPIES_PER_SHARE = 10_000


def _succeeded() -> Column:
    return F.col("error").isNull() & F.col("status").eqNullSafe(OK)


def open_responses(responses: DataFrame) -> DataFrame:
    """The entries of each response as ``texts``, and the ``reason`` why there are none, or not all.

    Keeps ``url, n_requests, status``. Each body is parsed once, whatever is selected from the
    result: ``texts`` comes out of a generator, which nothing is pushed through. A body that was cut off has
    the entries before the break, and a reason.
    """
    failure = F.coalesce("error", F.concat(F.lit("HTTP "), "status"), F.lit("no reply"))
    reason = (
        F.when(~_succeeded(), failure)
        .when(F.col("body").isNull(), "no body")
        .when(F.col("texts").isNull(), "body is not a JSON array")
        .when(F.col("rest").isNotNull(), F.concat(F.lit("array is cut off at: "), F.left("rest", F.lit(REST))))
    )
    opened = responses.select("*", opened_array("body"))
    texts = F.when(_succeeded(), F.col("texts"))
    return opened.select("url", "n_requests", "status", texts.alias("texts"), reason.alias("reason"))


def explode_responses(responses: DataFrame) -> DataFrame:
    """One row per entry of each response array, as JSON text with all its fields.

    Returns ``url, n_requests, entry``. An empty array gives no row; failed calls and bodies
    that are no array give none either and are listed by ``response_rejects``, as are arrays that were
    cut off.
    """
    opened = open_responses(responses.filter(_succeeded()))
    return opened.select("url", "n_requests", F.explode("texts").alias("entry"))


def response_rejects(responses: DataFrame) -> DataFrame:
    """Responses without usable entries, or with an array that was cut off, each with a ``reason``."""
    return open_responses(responses).filter("reason IS NOT NULL").drop("texts")


def entries_or_reasons(responses: DataFrame) -> DataFrame:
    """``url, n_requests, status, reason, entry``: a row per entry, and one with each reason.

    Both halves of the responses in one pass; an empty array gives neither.
    """
    no_reason = F.lit(None).cast("string").alias("reason")
    texts = F.coalesce("texts", F.array().cast("array<string>"))
    rows = F.transform(texts, lambda text: F.struct(no_reason, text.alias("entry")))
    failure = F.struct(F.col("reason").alias("reason"), F.lit(None).cast("string").alias("entry"))
    both = F.when(F.col("reason").isNull(), rows).otherwise(F.concat(rows, F.array(failure)))
    return open_responses(responses).select("url", "n_requests", "status", F.inline(both))


def repeat_entries(
    entries: DataFrame, in_place: int = COPIES_IN_PLACE, per_share: int = COPIES_PER_SHARE
) -> DataFrame:
    """Repeat each row ``n_requests`` times, and return its other columns.

    This gives the rows that one call per request would have given. Parse entries first: then
    a place that very many stations share has its entry parsed once. Rows with up to ``in_place``
    copies are repeated where they are read, which bounds how much larger the output of a task
    gets than its input. The others are first cut into shares of at most ``per_share`` copies and
    these spread over the cluster, so that no task writes all copies of one row, nor those of
    many such rows that happen to lie together.
    """
    n, one = F.col("n_requests"), F.lit(1).cast("bigint")
    share = F.lit(per_share).cast("bigint")
    common = entries.filter(n <= in_place)
    shares = entries.filter(n > in_place).withColumn(
        "_first", F.explode(F.sequence(one, n, share))
    )
    spread = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frequent = (
        shares.withColumn("n_requests", F.least(share, n - F.col("_first") + one))
        .drop("_first")
        .repartition(spread)
    )

    def copies(rows: DataFrame) -> DataFrame:
        repeated = F.explode(F.sequence(one, F.col("n_requests")))
        return rows.select("*", repeated.alias("_copy")).drop("n_requests", "_copy")

    return copies(common).unionByName(copies(frequent))


def parse_entries(
    entries: DataFrame, schema: StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """Typed columns of each ``entry``, plus ``_corrupt_record`` for those that do not fit.

    ``keep`` names columns to keep in front of them.
    """
    return entries.select(*keep, parse_json(F.col("entry"), schema))


def drop_terminator(rows: DataFrame) -> DataFrame:
    """Drop rows without any value, such as those a stored closing object left in a table.

    The scans tell the closing object from other empty entries; once it is a row, it looks
    like them.
    """
    return rows.filter(any_value(rows.columns))


def split_rejects(
    rows: DataFrame, declared: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Usable rows, without ``_corrupt_record``, and the rows that have one.

    A row of which some of the ``declared`` columns (all by default) could be read is in both; a
    row of which none could be read is a reject only.
    """
    names = [name for name in declared or rows.columns if name != CORRUPT]
    damaged = F.col(CORRUPT).isNotNull()
    return rows.filter(~damaged | any_value(names)).drop(CORRUPT), rows.filter(damaged)
