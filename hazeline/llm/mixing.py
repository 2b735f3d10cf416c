"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.llm.tables import WORDS, partitions, power_of_two, stored

#: Sources by code point, null last, weigh these in turn.
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    """Number of words of a text; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    Targets divide ``share`` times the total size by weight. None exceeds ``cap`` times its
    source's size; the excess goes to the others by weight until none is above. That is the
    water level at which ``min(cap * size, level * weight)`` adds up: with sources ordered by
    the level that fills them, each place in that order gives a level if all before it are full,
    and the highest of these is the water level.
    Sums are over one row per source, never over documents.
    """
    whole = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    filled = Window.orderBy("fills", F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    rest = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    turn = F.element_at(
        F.array(*[F.lit(int(w)) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    ).cast("long")
    level = (
        F.lit(share) * F.sum("source_size").over(whole)
        - F.lit(cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    ) / F.sum("weight").over(rest)
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", turn)
        .withColumn("fills", F.lit(cap) * F.col("source_size") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("water", F.max("level").over(whole))
        .select(
            "source",
            "source_size",
            F.least(F.lit(cap) * F.col("source_size"), F.col("water") * F.col("weight")).alias("target"),
        )
    )


def _key(value: Column) -> Column:
    return F.md5(F.coalesce(value.cast("string"), F.lit("")))


def mix(
    sizes: DataFrame,
    *,
    id_col: str = "doc_id",
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    cap: float = 2.0,
) -> DataFrame:
    """How often the mix takes each row of ``sizes`` (an id, ``source``, ``size``).

    Adds ``source_size``, ``target`` and ``copies``. Each row of a source is expected
    ``target / source_size`` times. The running sum of that, in an order fixed by size class and
    by a hash of the id, plus one offset per source drawn from a hash of its name, is cut at the
    whole numbers: a row is taken once per number it crosses, so never more than ``cap`` times
    rounded up, and every size class is represented evenly.

    The running sum needs no source in one task: rows are numbered within slices of
    (source, size class, leading bits of the hash), slices are added up within size classes, and
    those within sources. A source that holds most rows is thus spread over all tasks.

    Null ids, null sources and repeated rows are rows like others (null sorts last among the
    sources). A source of size 0 has target 0 and its rows are not taken. An empty table gives
    an empty result. Other columns of ``sizes`` are kept, unless named like those added.
    """
    bits = power_of_two(partitions(sizes.sparkSession))
    slice_of = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    keyed = (
        sizes.drop("source_size", "target", "copies")
        .withColumn("_class", F.floor(F.log2(F.col("size") + 1) * 4).cast("int"))
        .withColumn("_key", _key(F.col(id_col)))
        .withColumn("_slice", F.shiftright(slice_of, 32 - bits))
    )
    within = ["source", "_class", "_slice"]
    slices = keyed.groupBy(*within).agg(F.count(F.lit(1)).alias("_rows"))
    by_slice = Window.partitionBy("source", "_class").orderBy("_slice")
    by_class = Window.partitionBy("source").orderBy("_class")
    preceding = Window.unboundedPreceding, -1
    starts = (
        slices.withColumn("_sum", F.sum("_rows").over(by_slice))
        .withColumn("_in_class", F.col("_sum") - F.col("_rows"))
    )
    classes = (
        slices.groupBy("source", "_class")
        .agg(F.sum("_rows").alias("_class_rows"))
        .withColumn("_before", F.coalesce(F.sum("_class_rows").over(by_class.rowsBetween(*preceding)), F.lit(0)))
        .select(F.col("source").alias("_s"), F.col("_class").alias("_c"), "_before")
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = F.conv(F.substring(_key(F.col("source")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    targets = source_targets(sizes, weights, share, cap).select(
        F.col("source").alias("_t"), "source_size", "target", rate.alias("_rate"), offset.alias("_offset")
    )
    starts = (
        starts.join(classes, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_class") == F.col("_c")))
        .drop("_s", "_c")
        .join(targets, F.col("source").eqNullSafe(F.col("_t")))
        .select(
            F.col("source").alias("_s"), F.col("_class").alias("_c"), F.col("_slice").alias("_p"),
            (F.col("_in_class") + F.col("_before")).alias("_first"),
            "source_size", "target", "_rate", "_offset",
        )
    )
    in_slice = Window.partitionBy(*within).orderBy("_key", F.col(id_col), "size")
    numbered = keyed.withColumn("_row", F.row_number().over(in_slice) - 1).join(
        starts,
        F.col("source").eqNullSafe(F.col("_s"))
        & (F.col("_class") == F.col("_c")) & (F.col("_slice") == F.col("_p")),
    )
    at, rate, offset = F.col("_first") + F.col("_row"), F.col("_rate"), F.col("_offset")
    return numbered.withColumn(
        "copies",
        (F.floor((at + 1) * rate + offset) - F.floor(at * rate + offset)).cast("long"),
    ).drop(
        "_class", "_key", "_slice", "_row", "_first", "_s", "_c", "_p", "_rate", "_offset"
    )


def mix_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """``mix`` over documents: ``id, source, size, source_size, target, copies, taken``.

    ``size`` counts words; ``taken`` is ``copies * size``. Sizes are stored first, so that texts
    are read and counted once.
    """
    sizes = docs.select(
        F.col(id_col).alias(id_col),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
    )
    mixed = mix(stored(sizes, "sizes"), id_col=id_col, **options)
    return mixed.withColumn("taken", F.col("copies") * F.col("size"))


def take(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with its own columns.

    Copies follow id, source and size. Rows alike in all three divide the copies of their group
    evenly among themselves.
    """
    text_col, source_col = options.get("text_col", "text"), options.get("source_col", "source")

    def key(source: Column, size: Column) -> Column:
        return F.concat_ws(
            "|",
            F.coalesce(F.col(id_col).cast("string"), F.lit("-")),
            size.cast("string"),
            F.coalesce(F.concat(F.lit("="), source), F.lit("-")),
        )

    mine = docs.select(
        F.struct("*").alias("whole"),
        key(F.col(source_col).cast("string"), word_count(F.col(text_col))).alias("_key"),
        F.xxhash64(F.col(text_col)).alias("tie"),
    )
    counts = (
        mix_documents(docs, id_col=id_col, **options)
        .select(key(F.col("source"), F.col("size")).alias("_key"), "copies")
        .groupBy("_key")
        .agg(F.sum("copies").alias("_all"), F.count(F.lit(1)).alias("_rows"))
        .filter("_all > 0")
    )
    alike = Window.partitionBy("_key").orderBy("tie")
    row = F.row_number().over(alike)
    upto = [F.floor(n * F.col("_all") / F.col("_rows")) for n in (row, row - 1)]
    return (
        mine.join(counts, "_key")
        .withColumn("_copies", (upto[0] - upto[1]).cast("int"))
        .filter("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select("whole.*")
    )
