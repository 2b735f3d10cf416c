import random

import numpy as np
import pyarrow as pa
import pytest

from hazeline.llm import exchange
from tests.llm.conftest import words


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
@pytest.mark.parametrize("top", [1 << 6, 1 << 33, 1 << 50, (1 << 64) - 1])
def test_sorted_keys(n, top):
    rng = np.random.default_rng(n)
    keys = np.sort(rng.integers(0, top, n, dtype=np.uint64))
    packed = exchange.pack_sorted(keys)
    back, rest = exchange.unpack_sorted(packed + b"rest")
    assert np.array_equal(back, keys) and rest == b"rest"
    if n == 50_000 and top > 1 << 40:
        assert len(packed) * 8 < n * (np.log2(float(top)) - np.log2(n) + 2.2)


def test_uneven_keys():
    keys = np.array([0, 0, 0, 1, 2**63, 2**64 - 1], np.uint64)
    assert np.array_equal(exchange.unpack_sorted(exchange.pack_sorted(keys))[0], keys)


def test_columns():
    columns = [np.arange(5, dtype=np.uint32), np.arange(5, dtype=np.int64) - 2, np.ones(5, np.uint8)]
    back = exchange.unpack(exchange.pack(*columns), ("u4", "i8", "u1"))
    assert all(np.array_equal(a, b) for a, b in zip(columns, back, strict=True))
    assert exchange.cuts(np.zeros(0, np.uint64), 4) == []
    keys = np.array([1, 2, 1 << 62, 3 << 62], np.uint64)
    assert exchange.cuts(keys, 2) == [(0, 0, 2), (1, 2, 3), (3, 3, 4)]
    assert exchange.cuts(keys, 0) == [(0, 0, 4)]


def _dealt(df, plan, **options):
    rows = exchange.compressed(df, plan, "doc_id", "text", **options)
    schema = pa.schema([("id", pa.int64()), ("text", pa.string())])
    found = rows.groupBy("block").applyInArrow(lambda key, table: exchange.opened(table).cast(schema), "id long, text string")
    return rows.collect(), sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("gathered", [1, 32 << 20])
def test_compressed_texts(odd, odd_rows, gathered):
    plan = exchange.Layout(4, 2)
    packed, found = _dealt(odd, plan, gathered_bytes=gathered)
    assert found == sorted((exchange.NO_ID if row[0] is None else row[0], row[1] or "") for row in odd_rows)
    of = {row.block for row in exchange.blocked(odd, plan, "doc_id", "text").collect()}
    assert {row.block for row in packed} == of


@pytest.mark.parametrize("most", ["100", "10000"])
def test_size_of_compressed_texts(spark, most):
    """What a shuffle moves of ordinary texts is half of them, whether a task gets its rows in few batches or in many."""
    rng = random.Random(1)
    rows = [(number, " ".join(words(rng, rng.randint(5, 300)))) for number in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
    try:
        packed, found = _dealt(df, exchange.Layout(16, 4))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert found == sorted(rows) and len(packed) <= 2 * 16
    assert sum(len(row.packed) for row in packed) < 0.5 * sum(len(text) for _, text in rows)


def test_compressed_nothing(no_docs):
    assert _dealt(no_docs, exchange.Layout(4, 2)) == ([], [])
