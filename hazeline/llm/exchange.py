"""Blocks of documents that trade packed keys with buckets of keys.

An operator that compares keys of all documents (phrases, shingles, n-grams) would move a row per
key. Instead, documents are dealt to blocks by a hash of their id; a block sends each bucket, a
range of key hashes, one row with all its distinct keys packed, and the bucket answers each block
with one packed row. A key that many documents share is one entry per block, so no bucket grows
with it. Blocks and buckets are groups of a bounded number of bytes, and their number grows with
the input.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm.tables import partitions, power_of_two, unused

#: Bytes of text in a block, about, and of the texts whose keys a bucket gets.
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
#: Where documents without an id stand: after all others.
NO_ID = np.iinfo(np.int64).max

PACKED = "bucket long, block int, packed binary"

#: Bytes of rows that a task gathers before it packs those of each block, and how hard it tries.
GATHERED_BYTES = 32 << 20
LEVEL = 3
_TEXTS = pa.schema([("id", pa.int64()), ("text", pa.large_string())])


@dataclass(frozen=True)
class Layout:
    """How many blocks there are, and into how many buckets (as bits) keys divide."""

    blocks: int
    bits: int


def layout(
    docs: DataFrame, text_col: str, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES
) -> Layout:
    """Enough blocks and buckets for the texts and for the cluster."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_col))).alias("n")).first().n or 0
    tasks = partitions(docs.sparkSession)
    return Layout(
        max(2 * tasks, math.ceil(size / block_bytes)),
        power_of_two(max(tasks, math.ceil(size / bucket_bytes))),
    )


def blocked(
    docs: DataFrame, plan: Layout, id_col: str, text_col: str, carry: Sequence[str] | None = None
) -> DataFrame:
    """``block, id, text``, dealt by block, and in ``row`` the columns to ``carry`` along.

    Null ids become ``NO_ID`` and are dealt by their text, null texts empty ones. The rows are
    dealt before anything else happens, so that all passes over them share one shuffle.
    """
    number = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    block = F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text))), F.lit(plan.blocks))
    row = [] if carry is None else [
        # Never without a field, which Arrow could not carry.
        F.struct(F.lit(True).alias(unused("_", carry)), *[F.col(f"`{c}`") for c in carry]).alias("row")
    ]
    return docs.select(block.cast("int").alias("block"), number.alias("id"), text.alias("text"), *row)


def compressed(
    docs: DataFrame, plan: Layout, id_col: str, text_col: str, gathered_bytes: int = GATHERED_BYTES
) -> DataFrame:
    """``block, size, packed``: the rows of ``blocked``, several of a block in one compressed row.

    For operators whose shuffle of texts counts: Zstandard takes some 0.6 of the bytes that the usual
    codec of a shuffle leaves. ``opened`` has the rows again. A piece of a block is what a task has of
    it among ``gathered_bytes``, so texts are packed alike whatever their length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if held and size + batch.nbytes > gathered_bytes:
                yield _pieces(held)
                held, size = [], 0
            held.append(batch)
            size += batch.nbytes
        if held:
            yield _pieces(held)

    return blocked(docs, plan, id_col, text_col).mapInArrow(run, "block int, size long, packed binary")


def _pieces(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """A row for each block that the batches have rows of."""
    table = pa.Table.from_batches(batches)
    by = pc.sort_indices(table.column("block"))
    block = table.column("block").take(by).to_numpy()
    rows = table.select(_TEXTS.names).cast(_TEXTS).take(by).combine_chunks()
    codec = pa.Codec("zstd", compression_level=LEVEL)
    starts = np.flatnonzero(np.diff(block, prepend=-1))
    sizes, packed = [], []
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(block)], strict=True):
        piece = rows.slice(start, end - start).to_batches()[0].serialize()
        sizes.append(piece.size)
        packed.append(codec.compress(piece, asbytes=True))
    return pa.record_batch(
        {"block": pa.array(block[starts], pa.int32()), "size": pa.array(sizes, pa.int64()), "packed": pa.array(packed, pa.binary())}
    )


def opened(table: pa.Table) -> pa.Table:
    """``id, text`` of the rows that ``compressed`` has packed."""
    codec = pa.Codec("zstd")
    sizes, packed = table.column("size").to_pylist(), table.column("packed")
    return pa.Table.from_batches(
        [
            pa.ipc.read_record_batch(codec.decompress(piece.as_buffer(), decompressed_size=size), _TEXTS)
            for size, piece in zip(sizes, packed, strict=True)
        ],
        _TEXTS,
    )


def ordered(table: pa.Table) -> tuple[list[int], list[tuple[int, str]]]:
    """The rows of a block by id and text, and where in the table each is.

    Rows arrive in any order; every pass sees them in this one.
    """
    ids, texts = table.column("id").to_pylist(), table.column("text").to_pylist()
    order = sorted(range(len(ids)), key=lambda at: (ids[at], texts[at]))
    return order, [(ids[at], texts[at]) for at in order]


def bucket_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of each 64-bit key: its leading bits."""
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def cuts(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """Bucket, start and end of each run of sorted keys that share a bucket."""
    if not len(keys):
        return []
    buckets = bucket_of(keys, bits)
    starts = np.flatnonzero(np.diff(buckets, prepend=-1))
    ends = np.append(starts[1:], len(keys))
    return list(zip(buckets[starts].tolist(), starts.tolist(), ends.tolist(), strict=True))


def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length, byte by byte: all first bytes of a column, then all second ones.

    Bytes that are mostly zero thus stand together and are compressed away when moved.
    """
    parts = [len(columns[0]).to_bytes(4, "little")]
    for column in columns:
        column = np.ascontiguousarray(column)
        parts.append(column.view(np.uint8).reshape(len(column), column.itemsize).T.tobytes())
    return b"".join(parts)


def unpack(packed: bytes, kinds: Sequence[str]) -> list[np.ndarray]:
    """The columns of ``pack``, by their types."""
    n = int.from_bytes(packed[:4], "little")
    at, columns = 4, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(packed, np.uint8, n * width, at).reshape(width, n)
        columns.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * width
    return columns


def delta(ordered: np.ndarray) -> np.ndarray:
    """Differences of sorted unsigned integers, the first from zero; ``np.cumsum`` undoes it."""
    return np.diff(ordered, prepend=ordered.dtype.type(0))


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys in little more than the bits they need.

    Of each difference to the key before, the low bits are stored as they are, as many as an
    average difference has, and the rest as that many zeros and a one (Rice's code).
    """
    gaps = delta(keys)
    bits = int(gaps.mean()).bit_length() - 1 if len(gaps) else 0
    bits = max(0, bits)
    low = np.unpackbits(gaps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :bits]
    ends = np.cumsum((gaps >> np.uint64(bits)).astype(np.int64) + 1)
    rest = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    rest[ends - 1] = 1
    parts = [np.packbits(low.ravel(), bitorder="little").tobytes(), np.packbits(rest, bitorder="little").tobytes()]
    head = len(keys).to_bytes(4, "little") + bits.to_bytes(1, "little") + len(parts[1]).to_bytes(4, "little")
    return b"".join([head, *parts])


def unpack_sorted(packed: bytes) -> tuple[np.ndarray, bytes]:
    """The keys of ``pack_sorted``, and what follows them."""
    n, bits, size = int.from_bytes(packed[:4], "little"), packed[4], int.from_bytes(packed[5:9], "little")
    at = 9 + -(-n * bits // 8)
    low = np.zeros((n, 64), np.uint8)
    read = np.unpackbits(np.frombuffer(packed, np.uint8, at - 9, 9), count=n * bits, bitorder="little")
    low[:, :bits] = read.reshape(n, bits)
    gaps = np.packbits(low, axis=1, bitorder="little").reshape(-1).view("<u8").astype(np.uint64)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8, size, at), bitorder="little"))
    gaps += (np.diff(ends, prepend=-1).astype(np.uint64) - np.uint64(1)) << np.uint64(bits)
    return np.cumsum(gaps, dtype=np.uint64), packed[at + size :]
