"""Ranked lexical search over bit-sliced Bloom signatures.

``build`` makes an index of documents: blocks of documents of like size, each with a matrix of bits that
has a column per document and a row per hash value (a slice), and a table of how many documents hold
each term. A document sets the bits of each of its terms, once per step of ``STEPS`` that the term's
frequency reaches. ``search`` ands the slices of a term into the set of documents that may hold it so
often, too many rather than too few, and adds up weights over these sets: an upper bound of each
document's score. The documents with the highest bounds are scored exactly, from their texts; the k-th of
these scores is one that a document has to reach. All documents whose bound reaches it are scored exactly.

A term's weight is ``floor(1000 ln((2N + 2) / (2 df + 1)))``, a document's score the sum over distinct
query terms of ``weight * (10^9 tf div (1000 tf + 20 m))`` with ``m = 50 + 50 n N div L``: N documents have
terms, L in all, n the document; tf of them are the term, which df documents hold.

Null texts and queries have no terms; such documents are in no block, such queries get no rows. Repeated rows
are documents like others; ties go to the smaller id, null last. Ids may be of any type that has an order.
A long document is read whole; a signature has at most ``MOST_BITS`` bits, beyond which more documents
look as if they held a term and are scored. An empty table of either kind gives an empty result.

Queries are taken in blocks of ``QUERY_BYTES``; a block's terms, weights and thresholds are what the driver and
each task hold of them. At most ``k`` documents per query of a block are broadcast.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from hazeline.llm.tables import stored

#: Bytes that separate terms, as blanks, and A-Z in lower case.
_TERM = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if 48 <= byte <= 57 or 97 <= byte <= 122 or byte >= 128 else 32
    for byte in range(256)
)
#: Frequencies a document's bits tell apart, and what is known of one that reaches a step but not the next.
STEPS = (1, 2, 3, 4, 5, 7, 9, 13, 17, 25, 33, 49, 65)
#: Slices per term and step, and bits per entry of the largest document of a block.
HASHES, BITS = 4, 12
MOST_BITS = 1 << 22
#: Documents of a block, and bytes of its matrix.
BLOCK_DOCS, BLOCK_BYTES = 1024, 1 << 23
#: Distinct terms a task counts before it hands on the counts.
HELD_TERMS = 1 << 18
QUERY_BYTES = 1 << 20
#: A score can't come from a frequency higher than this part alone: 10^9 tf div (1000 tf + 20 m) < 10^6.
_LIMIT = 1_000_000


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in order and with repeats."""
    return (text or "").encode().translate(_TERM).split()


def _slices(term: bytes, step: int, bits: int) -> list[int]:
    """The rows of a matrix of ``bits`` rows that tell of a term and a step."""
    value = xxhash.xxh64_intdigest(term, step)
    first, stride = value & 0xFFFFFFFF, (value >> 32) | 1
    return [(first + at * stride) % bits for at in range(HASHES)]


@dataclass
class Index:
    """Stored tables: ``blocks`` of signatures and ``document_counts`` of terms; and two sums."""

    blocks: DataFrame
    document_counts: DataFrame
    documents: int
    terms: int


class _Block:
    """Documents of one class of sizes, gathered until their matrix is full."""

    def __init__(self, size_class: int):
        self.bits = min(MOST_BITS, BITS << size_class)
        self.room = max(8, min(BLOCK_DOCS, BLOCK_BYTES * 8 // self.bits))
        self.ids: list = []
        self.lengths: list[int] = []
        self.hashes: list[np.ndarray] = []

    def add(self, number: object, length: int, hashes: np.ndarray) -> bool:
        self.ids.append(number)
        self.lengths.append(length)
        self.hashes.append(hashes)
        return len(self.ids) == self.room

    def matrix(self) -> bytes:
        """All slices one after the other, each with a bit per document."""
        width = (len(self.ids) + 7) // 8
        cells = np.zeros(self.bits * width, np.uint8)
        for column, hashes in enumerate(self.hashes):
            first, stride = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
            for at in range(HASHES):
                slices = ((first + np.uint64(at) * stride) % np.uint64(self.bits)).astype(np.int64)
                # Within one document and one hash function, equal places get equal bytes.
                cells[slices * width + column // 8] |= np.uint8(128 >> column % 8)
        return cells.tobytes()


def build(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of ``docs``, in one pass over the texts, stored in the shared folder."""
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = StructType(
        [
            StructField("ids", ArrayType(picked.schema["id"].dataType)), StructField("lengths", ArrayType(LongType())),
            StructField("bits", IntegerType()), StructField("matrix", BinaryType()),
            StructField("terms", ArrayType(BinaryType())), StructField("counts", ArrayType(LongType())),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: dict[int, _Block] = {}
        counts: Counter[bytes] = Counter()
        types: dict[str, pa.DataType] = {}

        def row(**values: object) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([values.get(name)], kind) for name, kind in types.items()], list(types)
            )

        def block(full: _Block) -> pa.RecordBatch:
            return row(ids=full.ids, lengths=full.lengths, bits=full.bits, matrix=full.matrix())

        def counted() -> pa.RecordBatch:
            return row(terms=list(counts), counts=list(counts.values()))

        for batch in batches:
            types = types or {
                "ids": pa.list_(batch.schema.field("id").type), "lengths": pa.list_(pa.int64()), "bits": pa.int32(),
                "matrix": pa.binary(), "terms": pa.list_(pa.binary()), "counts": pa.list_(pa.int64()),
            }
            for number, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                found = Counter(terms(text.as_py()))
                if not found:
                    continue
                counts.update(found.keys())
                entries = [
                    xxhash.xxh64_intdigest(term, step)
                    for term, times in found.items() for step in STEPS if step <= times
                ]
                size_class = max(4, (len(entries) - 1).bit_length())
                own = gathered.setdefault(size_class, _Block(size_class))
                if own.add(number, found.total(), np.array(entries, np.uint64)):
                    yield block(gathered.pop(size_class))
                if len(counts) > HELD_TERMS:
                    yield counted()
                    counts.clear()
        for left in gathered.values():
            yield block(left)
        if counts:
            yield counted()

    made = stored(picked.mapInArrow(run, schema), "signatures")
    pairs = made.filter("terms IS NOT NULL").select(F.explode(F.arrays_zip("terms", "counts")).alias("pair"))
    document_counts = pairs.groupBy(F.col("pair.terms").alias("term")).agg(F.sum("pair.counts").alias("df"))
    blocks = made.filter("ids IS NOT NULL").select("ids", "lengths", "bits", "matrix")
    sums = blocks.agg(
        F.sum(F.size("ids")).cast("long").alias("documents"),
        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda total, n: total + n)).alias("terms"),
    ).first()
    return Index(blocks, stored(document_counts, "document-counts"), sums.documents or 0, sums.terms or 0)


class _Queries:
    """A block of queries: their distinct terms, and per query which of them and what they weigh."""

    def __init__(self, items: list[tuple[object, list[bytes]]], weights: dict[bytes, int], index: Index):
        known = [(item, sorted(set(own) & weights.keys())) for item, own in items]
        known = [(item, own) for item, own in known if own]
        self.items = [item for item, _ in known]
        self.terms = sorted({term for _, own in known for term in own})
        at = {term: place for place, term in enumerate(self.terms)}
        self.places = [np.array([at[term] for term in own]) for _, own in known]
        self.weights = np.array([weights[term] for term in self.terms], np.int64)
        self.of_term = weights
        self.own = [own for _, own in known]
        self.documents, self.all_terms = index.documents, index.terms

    def norm(self, length: int) -> int:
        return 50 + 50 * length * self.documents // self.all_terms

    def score(self, query: int, found: Counter[bytes], length: int) -> int:
        m, total = self.norm(length), 0
        for term in self.own[query]:
            times = found[term]
            if times:
                total += self.of_term[term] * (1_000_000_000 * times // (1000 * times + 20 * m))
        return total

    def bounds(self, lengths: np.ndarray, bits: int, matrix: bytes) -> np.ndarray:
        """A bound of the score of each document of a block (columns) for each query (rows)."""
        width = (len(lengths) + 7) // 8
        slices = np.frombuffer(matrix, np.uint8).reshape(bits, width)
        norms = np.array([self.norm(int(length)) for length in lengths], np.int64)
        total = np.zeros((len(self.items), len(lengths)), np.int64)
        places, held, before = np.arange(len(self.terms)), None, np.zeros(len(lengths), np.int64)
        for number, step in enumerate(STEPS):
            rows = np.array([_slices(self.terms[at], step, bits) for at in places]).reshape(-1, HASHES)
            sets = np.bitwise_and.reduce([slices[rows[:, at]] for at in range(HASHES)])
            if held is not None:
                sets &= held
            some = sets.any(axis=1)
            places, held = places[some], sets[some]
            if not len(places):
                break
            if number + 1 < len(STEPS):
                upto = STEPS[number + 1] - 1
                gain = 1_000_000_000 * upto // (1000 * upto + 20 * norms)
            else:
                gain = np.full(len(norms), _LIMIT)
            # Weights of the sets, summed per query; only the rows of terms with a set are opened.
            opened = np.unpackbits(held, axis=1, count=len(lengths)).astype(np.float64) * self.weights[places, None]
            row_of = np.full(len(self.terms), -1)
            row_of[places] = np.arange(len(places))
            for query, own in enumerate(self.places):
                mine = row_of[own]
                mine = mine[mine >= 0]
                if len(mine):
                    # Sums of integers far below 2^53 are exact as doubles.
                    total[query] += opened[mine].sum(axis=0).astype(np.int64) * (gain - before)
            before = gain
        return total


def _weights(index: Index, items: list[tuple[object, list[bytes]]], spark) -> dict[bytes, int]:
    """The weight of each term of a block of queries that some document holds."""
    wanted = sorted({term for _, own in items for term in own})
    frame = spark.createDataFrame([(bytearray(term),) for term in wanted], "term binary")
    n = index.documents
    found = index.document_counts.join(F.broadcast(frame), "term").collect()
    return {bytes(row.term): math.floor(1000 * math.log((2 * n + 2) / (2 * row.df + 1))) for row in found}


def _best(scores: DataFrame, item: str, k: int, *order) -> DataFrame:
    """The first ``k`` rows per item, numbered; tasks cut theirs to as many before the shuffle."""
    window = Window.partitionBy(item).orderBy(*order)
    return scores.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def _bounded(index: Index, queries: _Queries, least: list[int], k: int | None, schema: StructType) -> DataFrame:
    """``query, id, bound`` of all documents whose bound reaches the query's least; a task's first ``k`` if given."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type = None
        floors = np.maximum(np.array(least, np.int64), 1)
        kept: list[list[tuple[int, object]]] = [[] for _ in least]

        def result(query: list[int], ids: list, bounds: list[int]) -> pa.RecordBatch:
            columns = [pa.array(query, pa.int32()), pa.array(ids, id_type), pa.array(bounds, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["query", "id", "bound"])

        for batch in batches:
            id_type = batch.schema.field("ids").type.value_type
            for ids, lengths, bits, matrix in zip(*(column.to_pylist() for column in batch.columns)):
                bounds = queries.bounds(np.array(lengths, np.int64), bits, matrix)
                rows, columns = np.nonzero(bounds >= floors[:, None])
                if k is None:
                    yield result(rows.tolist(), [ids[at] for at in columns], bounds[rows, columns].tolist())
                    continue
                for query in np.unique(rows):
                    own = np.flatnonzero(bounds[query] >= floors[query])
                    values = bounds[query, own].tolist()
                    kept[query] += [(value, ids[at]) for value, at in zip(values, own)]
                    if len(kept[query]) > k:
                        kept[query] = sorted(kept[query], key=lambda pair: -pair[0])[:k]
                        floors[query] = max(floors[query], kept[query][-1][0])
        for query, pairs in enumerate(kept):
            if pairs:
                yield result([query] * len(pairs), [number for _, number in pairs], [bound for bound, _ in pairs])

    return index.blocks.mapInArrow(run, schema)


def _scored(docs: DataFrame, wanted: DataFrame, queries: _Queries, least: list[int], schema: StructType) -> DataFrame:
    """``query, id, score`` of the wanted queries of each document, from its text, if they reach the least."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: tuple[list, list, list] = ([], [], [])
            ids, asked = batch.column("id").to_pylist(), batch.column("asked").to_pylist()
            for number, text, own in zip(ids, batch.column("text"), asked):
                counts = Counter(terms(text.as_py()))
                length = counts.total()
                for query in own:
                    score = queries.score(query, counts, length)
                    if score >= max(1, least[query]):
                        for column, value in zip(found, (query, number, score)):
                            column.append(value)
            types = [pa.int32(), batch.schema.field("id").type, pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, types)], ["query", "id", "score"])

    joined = docs.join(wanted, docs["id"].eqNullSafe(wanted["wanted_id"])).select("id", "text", "asked")
    return joined.mapInArrow(run, schema)


def _per_document(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(F.col("id").alias("wanted_id")).agg(F.collect_set("query").alias("asked"))


def search(
    index: Index, docs: DataFrame, items: DataFrame, *, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score`` (named as the columns given): each item's ``k`` best documents.

    ``docs`` are the documents that the index was built of. Rows with the same item id are one query each, ranked
    on their own.
    """
    spark = docs.sparkSession
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type, item_type = picked.schema["id"].dataType, items.schema[item_col].dataType
    asked = items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text_col}`").cast("string").alias("text"))
    volume = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    blocks = max(1, math.ceil(volume / QUERY_BYTES))
    result_type = StructType(
        [
            StructField(item_col, item_type), StructField("rank", IntegerType()), StructField(id_col, id_type),
            StructField("score", LongType()),
        ]
    )
    bound_type = StructType([StructField("query", IntegerType()), StructField("id", id_type), StructField("bound", LongType())])
    score_type = StructType([StructField("query", IntegerType()), StructField("id", id_type), StructField("score", LongType())])
    results = spark.createDataFrame([], result_type)
    for number in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number).collect()
        read = [(row.item, terms(row.text)) for row in part]
        queries = _Queries(read, _weights(index, read, spark) if index.documents else {}, index)
        if not queries.items:
            continue
        nothing = [0] * len(queries.items)
        highest = _best(_bounded(index, queries, nothing, k, bound_type), "query", k, F.col("bound").desc(), F.col("id").asc_nulls_last())
        first = _scored(picked, F.broadcast(_per_document(highest)), queries, nothing, score_type)
        ranked = _best(first, "query", k, F.col("score").desc(), F.col("id").asc_nulls_last())
        least = list(nothing)
        for row in ranked.filter(F.col("rank") == k).select("query", "score").collect():
            least[row["query"]] = row["score"]
        pairs = _per_document(_bounded(index, queries, least, None, bound_type))
        scores = _scored(picked, pairs, queries, least, score_type)
        found = _best(scores, "query", k, F.col("score").desc(), F.col("id").asc_nulls_last())
        names = spark.createDataFrame(
            list(enumerate(queries.items)), StructType([StructField("query", IntegerType()), StructField("item", item_type)])
        )
        told = found.join(F.broadcast(names), "query").select(
            F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"),
            F.col("id").alias(id_col), F.col("score").alias("score"),
        )
        results = results.unionByName(told)
    return results
