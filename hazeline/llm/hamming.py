"""Exact nearest binary codes by incremental multi-index hashing."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from hazeline.llm.tables import stored

#: Bits of a segment, by whose value codes are looked up.
SEGMENT = 16
#: Distinct codes and distinct queries that one task holds.
INDEX_BLOCK = 50_000
QUERY_BLOCK = 20_000


def signs(df: DataFrame, vector_col: str, id_col: str) -> DataFrame:
    """``id, code``: one bit per component, set where it is above zero.

    The bits fill whole segments, with zeros after the last component. Rows without a vector
    have no code and are left out.
    """
    schema = StructType([StructField("id", df.schema[id_col].dataType), StructField("code", BinaryType())])
    width = df.agg(F.max(F.size(F.col(vector_col))).alias("n")).first().n or 0
    size = SEGMENT // 8 * max(1, math.ceil(width / SEGMENT))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(vector_col)
            codes = np.zeros((batch.num_rows, size * 8), bool)
            lengths = np.diff(lists.offsets.to_numpy())
            rows = np.repeat(np.arange(batch.num_rows), lengths)
            first = lists.offsets[0].as_py()
            values = lists.values.slice(first, int(lengths.sum()))
            columns = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            known = values.fill_null(0).to_numpy(zero_copy_only=False)
            codes[rows, columns] = (known > 0) | np.isnan(known)
            packed = np.packbits(codes, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array([row.tobytes() for row in packed], pa.binary())], ["id", "code"]
            )

    known = df.select(id_col, vector_col).filter(F.col(vector_col).isNotNull())
    return known.mapInArrow(run, schema)


@lru_cache(maxsize=None)
def _flips(weight: int) -> np.ndarray:
    """All segment values with so many bits set."""
    return np.array([sum(1 << bit for bit in bits) for bits in combinations(range(SEGMENT), weight)], np.int64)


class Index:
    """Codes by the value of each segment."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.segments = codes.view(">u2").astype(np.int64)
        self.orders, self.begins = [], []
        for segment in self.segments.T:
            order = np.argsort(segment, kind="stable")
            self.orders.append(order)
            self.begins.append(np.searchsorted(segment[order], np.arange((1 << SEGMENT) + 1)))

    def nearest(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and distances of all codes no farther than the k-th nearest.

        The search radius grows segment by segment. Once segments up to the i-th are searched to
        radius r and the rest to r - 1, a code not met differs from the query in at least
        r * m + i + 1 bits of m segments, so the search ends when the k-th distance met is less.
        """
        m = len(self.orders)
        values = query.view(">u2").astype(np.int64)
        seen = np.zeros(len(self.codes), bool)
        numbers, distances = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for radius in range(SEGMENT + 1):
            for i in range(m):
                looked = values[i] ^ _flips(radius)
                starts, ends = self.begins[i][looked], self.begins[i][looked + 1]
                some = ends > starts
                starts, lengths = starts[some], (ends - starts)[some]
                at = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths - starts, lengths)
                met = self.orders[i][at]
                met = met[~seen[met]]
                seen[met] = True
                numbers = np.concatenate([numbers, met])
                off = np.bitwise_count(self.codes[met] ^ query).sum(axis=1, dtype=np.int64)
                distances = np.concatenate([distances, off])
                covered = radius * m + i
                if len(distances) > k:
                    worst = np.partition(distances, k - 1)[k - 1]
                    near = distances <= worst
                    numbers, distances = numbers[near], distances[near]
                    if worst <= covered:
                        return numbers, distances
                elif len(distances) == k and distances.max() <= covered:
                    return numbers, distances
        return numbers, distances


def _within(cell: pa.Table, k: int) -> pa.Table:
    """The nearest rows in a block of codes, for a block of queries, as ``query, id, distance``."""
    codes = cell.column("code").to_pylist()
    ids = cell.column("ids").to_pylist()
    queries = [code for code, own in zip(codes, ids, strict=True) if own is None]
    index = [(code, own) for code, own in zip(codes, ids, strict=True) if own is not None]
    found_q, found_i, found_d = [], [], []
    if index and queries:
        table = Index(np.frombuffer(b"".join(code for code, _ in index), np.uint8).reshape(len(index), -1))
        for query in queries:
            numbers, distances = table.nearest(np.frombuffer(query, np.uint8), k)
            rows = sorted((int(d), i) for n, d in zip(numbers, distances, strict=True) for i in index[n][1])[:k]
            found_q += [query] * len(rows)
            found_d += [d for d, _ in rows]
            found_i += [i for _, i in rows]
    kind = cell.schema.field("ids").type.value_type
    return pa.table(
        {"query": pa.array(found_q, pa.binary()), "id": pa.array(found_i, kind), "distance": pa.array(found_d, pa.int32())}
    )


def search(codes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, id, distance``: the k nearest other rows of ``codes`` for each row of
    ``queries`` (both ``id, code``), by Hamming distance and then by id.

    Equal codes are one entry with their k + 1 smallest ids, and equal queries are asked once, so
    a code that very many rows share costs no more than another. Distinct codes and queries are
    cut in blocks; each task searches one block of codes for one block of queries, and only the
    k + 1 best of each come together. Rows with a null id are no neighbours and no queries; a
    row listed twice counts once. Without other rows a query has no result.
    """
    spark = codes.sparkSession
    known = codes.filter(F.col("id").isNotNull()).select("id", "code").distinct()
    by_id = Window.partitionBy("code").orderBy("id")
    index = stored(
        known.withColumn("n", F.row_number().over(by_id))
        .filter(F.col("n") <= k + 1)
        .groupBy("code")
        .agg(F.sort_array(F.collect_list("id")).alias("ids")),
        "codes",
    )
    asked = queries.filter(F.col("id").isNotNull()).select(F.col("id").alias("query_id"), F.col("code").alias("query")).distinct()
    asked = stored(asked, "queries")
    distinct = asked.select(F.col("query").alias("code")).distinct()
    blocks = [max(1, math.ceil(df.count() / most)) for df, most in ((index, INDEX_BLOCK), (distinct, QUERY_BLOCK))]

    def block(n: int, number: int):
        return F.pmod(F.xxhash64("code"), F.lit(n)).cast("int").alias(("code_block", "query_block")[number])

    def every(n: int, number: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(("code_block", "query_block")[number])

    id_type = codes.schema["id"].dataType.simpleString()
    cells = index.select("code", "ids", block(blocks[0], 0), every(blocks[1], 1)).unionByName(
        distinct.select("code", F.lit(None).cast(f"array<{id_type}>").alias("ids"), block(blocks[1], 1), every(blocks[0], 0))
    )
    part = cells.groupBy("code_block", "query_block").applyInArrow(
        lambda cell: _within(cell, k + 1), f"query binary, id {id_type}, distance int"
    )
    nearest = Window.partitionBy("query").orderBy("distance", "id")
    best = part.withColumn("n", F.row_number().over(nearest)).filter(F.col("n") <= k + 1).drop("n")
    ranks = Window.partitionBy("query_id").orderBy("distance", "id")
    return (
        asked.join(best, "query")
        .filter(F.col("id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(ranks))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "id", "distance")
    )
