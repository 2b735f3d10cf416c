"""Exact duplicates by counting quotient filters, and bytes compared where a filter counts two.

Texts are equal when they are identical after deleting ASCII white space. Each partition counts the
64-bit fingerprints of its texts in quotient filters, one per range of fingerprints; the filters of
a range merge by their sorted remainders. A fingerprint counted once belongs to a text that has no
equal, and that text goes no further. Texts whose fingerprint counts more are grouped by
their bytes.

Keys that hold a large part of all rows: a partition's filters have one entry for a fingerprint however
often it comes, and texts are grouped in each task before they are shuffled. Fingerprints and
groups with more than one in ``SHARE`` of all rows (at most ``SHARE`` of them, then) are told to rows by a
broadcast; the others by a shuffle, in which none of them can weigh much.

Null texts count as empty. Empty texts equal each other. Null ids sort last. Of rows alike in text, id and
length one stays. An empty table gives an empty result. Ids may be of any type that has an order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hazeline.llm import quotient
from hazeline.llm.tables import partitions, power_of_two, stored

#: White space that does not count.
SPACE = r"[\x20\x09-\x0D]+"
#: More rows than one in so many make a key common; a common key has at least ``COMMON`` rows.
SHARE, COMMON = 10_000, 1000
#: Fingerprints of one range, and those a task counts before it hands on its filters.
RANGE, HELD = 1 << 20, 1 << 21


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def repeated_fingerprints(rows: DataFrame, column: str, n_rows: int) -> DataFrame:
    """``fingerprint, copies`` of the 64-bit values that occur in more than one row."""
    bits = power_of_two(max(partitions(rows.sparkSession), -(-n_rows // RANGE)))

    def filters(held: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        found, counts = held
        numbers = (found >> quotient.U(64 - bits)).astype(np.int64) if bits else np.zeros(len(found), np.int64)
        edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1), len(numbers)] if len(numbers) else [0]
        spans = list(zip(edges, edges[1:]))
        packed = [quotient.pack(found[a:b], counts[a:b], bits) for a, b in spans]
        return pa.record_batch({"number": pa.array(numbers[edges[:-1]], pa.int64()), "packed": pa.array(packed, pa.binary())})

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = quotient.merge([])
        for batch in batches:
            own = quotient.counted(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            held = quotient.merge([held, own])
            if len(held[0]) > HELD:
                yield filters(held)
                held = quotient.merge([])
        yield filters(held)

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        number = key[0].as_py()
        found, counts = quotient.merge([quotient.unpack(p, bits, number) for p in table.column("packed").to_pylist()])
        again = counts > 1
        return pa.table({"fingerprint": found[again].view(np.int64), "copies": counts[again]})

    packed = rows.select(column).mapInArrow(count, "number long, packed binary")
    return packed.groupBy("number").applyInArrow(merge, "fingerprint long, copies long")


def _common(n_rows: int) -> int:
    return max(COMMON, n_rows // SHARE)


def _told(rows: DataFrame, facts: DataFrame, keys: list[str], copies: str, n_rows: int) -> DataFrame:
    """``rows`` left joined with ``facts`` on ``keys``; facts of more than a share of rows by broadcast."""
    common = F.col(copies) >= _common(n_rows)
    near = rows.join(F.broadcast(facts.filter(common)), keys, "left")
    told = near.filter(F.col(copies).isNotNull())
    rest = near.filter(F.col(copies).isNull()).select(*rows.columns)
    return told.unionByName(rest.join(facts.filter(~common), keys, "left"))


def _order(id_name: str) -> Column:
    """Most code points first, then the smallest id, null last."""
    return F.struct((-F.col("length")).alias("a"), F.col(id_name).isNull().alias("b"), F.col(id_name).alias("c"))


def _keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    text = F.col(f"`{text_col}`")
    picked = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.char_length(text), F.lit(0)).cast("long").alias("length"),
        normalised(text).alias("bytes"),
        *more,
    )
    return picked.withColumn("fingerprint", F.xxhash64("bytes"))


def _repeated(keyed: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """A stored table of all rows without texts, one of repeated fingerprints, and the number of rows."""
    seen = Observation()
    narrow = keyed.select(
        "id", "length", "fingerprint", F.sha2(F.col("bytes").cast("binary"), 256).alias("sha256"),
        F.monotonically_increasing_id().alias("row"),
    ).observe(seen, F.count(F.lit(1)).alias("rows"))
    rows = stored(narrow, "dedup-rows")
    n_rows = seen.get["rows"]
    return rows, stored(repeated_fingerprints(rows, "fingerprint", n_rows), "dedup-repeated"), n_rows


def members(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``keep_id, group_size, kept, text_sha256``.

    ``keep_id`` is the id of the row that stays of all with an equal text: the one with the most code
    points before white space was deleted, then the smallest id.
    """
    keyed = _keyed(docs, id_col, text_col)
    rows, repeated, n_rows = _repeated(keyed)
    shared = _told(keyed, repeated, ["fingerprint"], "copies", n_rows).filter("copies IS NOT NULL")
    groups = (
        shared.groupBy("fingerprint", "bytes")
        .agg(F.count(F.lit(1)).alias("size"), F.min_by(F.struct("id", "length"), _order("id")).alias("best"))
        .select(
            "fingerprint", F.sha2(F.col("bytes").cast("binary"), 256).alias("sha256"), "size",
            F.col("best.id").alias("best_id"), F.col("best.length").alias("best_length"),
        )
    )
    key = ["fingerprint", "sha256"]
    told = stored(_told(rows, stored(groups, "dedup-groups"), key, "size", n_rows), "dedup-members")
    best = told.filter(F.col("id").eqNullSafe(F.col("best_id")) & (F.col("length") == F.col("best_length")))
    first = best.groupBy(*key).agg(F.min("row").alias("row")).select("row", F.lit(True).alias("first"))
    alone = F.col("size").isNull()
    return told.join(first, "row", "left").select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.coalesce("first", F.lit(False))).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


def distinct(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever these are called."""
    keyed = _keyed(docs, id_col, text_col, F.struct("*").alias("whole"))
    _, repeated, n_rows = _repeated(keyed)
    told = _told(keyed, repeated, ["fingerprint"], "copies", n_rows)
    alone = told.filter("copies IS NULL").select("whole")
    # Of rows alike in text, length and id the one with the least hash of what else they have stays.
    hashed = [F.col("whole")[f.name] for f in docs.schema if "map<" not in f.dataType.simpleString()]
    best = told.filter("copies IS NOT NULL").groupBy("fingerprint", "bytes").agg(
        F.min_by("whole", F.struct(_order("id").alias("order"), F.xxhash64(*hashed).alias("tie"))).alias("whole")
    )
    return alone.unionByName(best.select("whole")).select("whole.*")
