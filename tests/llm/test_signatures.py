import random

import duckdb
import pytest

from hazeline.llm import signatures
from hazeline.llm.oracle import SEARCH

ITEMS = "item_id long, text string"


def expected(rows, items):
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    duck.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    return duck.sql(SEARCH).fetchall()


def key(row):
    return tuple((value is None, value) for value in row)


def found(docs, items, **options):
    return sorted(map(tuple, signatures.search(signatures.build(docs), docs, items, **options).collect()), key=key)


@pytest.fixture(scope="module")
def items(odd_rows):
    rng = random.Random(4)
    texts = [row[1] for row in odd_rows if row[1]]
    rows = [(number, " ".join(rng.choice(texts).split()[:30])) for number in range(12)]
    return rows + [(12, None), (13, ""), (14, "nothing-of-this is_there"), (15, "one ONE two"), (None, "Three zz")]


@pytest.mark.parametrize("query_bytes", [1 << 20, 200])
def test_odd_documents(spark, odd, odd_rows, items, query_bytes, monkeypatch):
    monkeypatch.setattr(signatures, "QUERY_BYTES", query_bytes)
    asked = spark.createDataFrame([(*row, 1, 2) for row in items], f"{ITEMS}, query int, rank int")
    assert found(odd, asked) == sorted(expected([row[:2] for row in odd_rows], items), key=key)


def test_bounds_hold_when_every_bit_is_set(spark, odd, odd_rows, items, monkeypatch):
    monkeypatch.setattr(signatures, "MOST_BITS", 8)
    monkeypatch.setattr(signatures, "BLOCK_DOCS", 8)
    assert found(odd, spark.createDataFrame(items, ITEMS)) == sorted(expected([r[:2] for r in odd_rows], items), key=key)


def test_many_ties_go_to_the_smaller_id(spark):
    rows = [(number, "alpha beta") for number in range(3000)] + [(5000, "alpha"), (5001, "gamma"), (None, "alpha beta")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    items = [(1, "alpha"), (2, "beta alpha gamma"), (3, "alpha")]
    assert found(docs, spark.createDataFrame(items, ITEMS)) == sorted(expected(rows, items), key=key)


def test_documents_are_excluded_by_their_bounds(spark):
    rng = random.Random(2)
    names = [f"w{number}" for number in range(2000)]
    rows = [(number, " ".join(rng.choices(names, k=60))) for number in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    index = signatures.build(docs)
    item = rows[17][1]
    weights = signatures._weights(index, [(0, signatures.terms(item))], spark)
    queries = signatures._Queries([(0, signatures.terms(item))], weights, index)
    tenth = signatures.search(index, docs, spark.createDataFrame([(0, item)], ITEMS), k=10).collect()
    least = min(row.score for row in tenth)
    exact = {number: queries.score(0, signatures.Counter(signatures.terms(text)), 60) for number, text in rows}
    bounds = {}
    for block in index.blocks.collect():
        values = queries.bounds(signatures.np.array(block.lengths), block.bits, block.matrix)[0]
        bounds |= dict(zip(block.ids, values.tolist()))
    assert bounds.keys() == exact.keys() and all(bounds[n] >= exact[n] for n in exact)
    assert sum(bound >= least for bound in bounds.values()) < 200


def test_empty_tables(spark, no_docs):
    items = spark.createDataFrame([(1, "a b")], ITEMS)
    assert found(no_docs, items) == []
    blank = spark.createDataFrame([(1, None), (2, " ,;")], "doc_id long, text string")
    assert found(blank, items) == []
    docs = spark.createDataFrame([("x", "a b")], "doc_id string, text string")
    assert found(docs, spark.createDataFrame([], ITEMS)) == []
    assert [row[2] for row in found(docs, items)] == ["x"]
