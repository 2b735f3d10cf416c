"""Quality classifier: a factorisation machine over hashed words and the structure of a text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType
)

from hazeline.llm import arrays

#: Buckets that words hash into.
BUCKETS = 1 << 14
#: Labelled documents a model is fitted on, at most; they are chosen by a hash of their ids.
FITTED = 4000

STRUCTURE = (
    "bytes", "words", "bytes_per_word", "upper", "digits", "stops", "symbols", "bars", "breaks",
    "beyond_ascii", "distinct", "again", "commonest", "capitalised", "symbol_ends", "one",
)
_UPPER, _LOWER_CASE, _DIGIT, _STOP, _BAR, _BREAK, _SPACE, _SYMBOL, _BEYOND = range(9)


def _kinds() -> np.ndarray:
    kinds = np.full(256, _SYMBOL, np.uint8)
    kinds[65:91], kinds[97:123], kinds[48:58], kinds[128:] = _UPPER, _LOWER_CASE, _DIGIT, _BEYOND
    kinds[[ord(c) for c in ".,;:'\"()?-"]] = _STOP
    kinds[ord("|")], kinds[10] = _BAR, _BREAK
    kinds[[9, 11, 12, 13, 32]] = _SPACE
    return kinds


_KINDS = _kinds()


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of several texts: text, feature and value of each entry, in order of text.

    Features below ``BUCKETS`` are hashed words with dampened counts, scaled to length one in
    each text; those from there on are ``STRUCTURE``. A text without words has structure only.
    """
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    kinds = np.zeros(9 * n, np.int64)
    for start in range(0, len(data), arrays.STEP_BYTES):
        end = min(start + arrays.STEP_BYTES, len(data))
        first = int(np.searchsorted(offsets, start, "right")) - 1
        last = int(np.searchsorted(offsets, end, "left"))
        inside = np.diff(np.clip(offsets[first : last + 1], start, end))
        of_byte = np.repeat(np.arange(last - first), inside)
        kinds[9 * first : 9 * last] += np.bincount(of_byte * 9 + _KINDS[data[start:end]], minlength=9 * (last - first))
    kinds = kinds.reshape(n, 9).astype(float)
    hashes, starts, ends, of_word = arrays.hashed_words(data, offsets)
    counts = np.bincount(of_word, minlength=n).astype(float)
    key, times = np.unique(of_word * BUCKETS + (hashes % BUCKETS).astype(np.int64), return_counts=True)
    row, bucket = key // BUCKETS, key % BUCKETS
    value = 1 + np.log(times)
    norm = np.sqrt(np.bincount(row, value * value, minlength=n))
    value = value / norm[row]

    per_word, per_byte = 1 / np.maximum(counts, 1), 1 / np.maximum(lengths, 1)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
    commonest = np.zeros(n)
    np.maximum.at(commonest, row, times)
    letters = np.maximum(kinds[:, _UPPER] + kinds[:, _LOWER_CASE], 1)
    last = _KINDS[data[ends - 1]] if len(ends) else np.zeros(0, np.uint8)
    first = _KINDS[data[starts]] if len(starts) else np.zeros(0, np.uint8)
    dense = np.column_stack(
        [
            np.log1p(lengths) / 10,
            np.log1p(counts) / 8,
            np.minimum((lengths - kinds[:, _SPACE] - kinds[:, _BREAK]) * per_word / 10, 4),
            kinds[:, _UPPER] / letters,
            kinds[:, _DIGIT] * per_byte * 5,
            np.minimum(kinds[:, _STOP] * per_word * 2, 4),
            np.minimum(kinds[:, _SYMBOL] * per_word, 4),
            np.minimum(kinds[:, _BAR] * per_word * 2, 4),
            np.minimum(kinds[:, _BREAK] * per_word * 5, 4),
            kinds[:, _BEYOND] * per_byte * 4,
            np.bincount(row, minlength=n) * per_word,
            np.bincount(of_word, again, minlength=n) * per_word * 2,
            commonest * per_word * 2,
            np.bincount(of_word, first == _UPPER, minlength=n) * per_word,
            np.bincount(of_word, last == _SYMBOL, minlength=n) * per_word,
            np.ones(n),
        ]
    )
    rows = np.concatenate([row, np.repeat(np.arange(n), len(STRUCTURE))])
    at = np.argsort(rows, kind="stable")
    columns = np.concatenate([bucket, np.tile(np.arange(BUCKETS, BUCKETS + len(STRUCTURE)), n)])
    return rows[at], columns[at], np.concatenate([value, dense.ravel()])[at]


@dataclass
class Machine:
    """Weights of a factorisation machine: a bias, one weight and one vector per feature."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def margins(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        """The score of each row before the logistic function, in time linear in the entries.

        The sum over pairs of ``<v_i, v_j> x_i x_j`` is half of the squared sum of ``v_i x_i``
        minus the sum of their squares, component by component.
        """
        total = self.bias + np.bincount(rows, self.weights[columns] * values, minlength=n)
        for vector in self.vectors.T:
            part = vector[columns] * values
            sums = np.bincount(rows, part, minlength=n)
            total += (sums * sums - np.bincount(rows, part * part, minlength=n)) / 2
        return total


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, y: np.ndarray,
    rank: int = 4, epochs: int = 12, rate: float = 0.1, decay: float = 1e-4, seed: int = 7,
) -> Machine:
    """Fit by AdaGrad on the logistic loss, in batches; classes weigh the same in total."""
    size = BUCKETS + len(STRUCTURE)
    random = np.random.default_rng(seed)
    machine = Machine(0.0, np.zeros(size), random.normal(0, 0.05, (size, rank)))
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, rank), 1e-6), 1e-6
    share = y.mean() if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        machine.bias = 4.0 if share >= 1 else -4.0 if len(y) else 0.0
        machine.vectors[:] = 0
        return machine
    importance = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    begins = np.searchsorted(rows, np.arange(len(y) + 1))
    for _ in range(epochs):
        order = random.permutation(len(y))
        for start in range(0, len(y), 64):
            some = order[start : start + 64]
            n = len(some)
            at = arrays.ranges(begins[some], begins[some + 1] - begins[some])
            r = np.repeat(np.arange(n), begins[some + 1] - begins[some])
            c, x = columns[at], values[at]
            wrong = (sigmoid(machine.margins(r, c, x, n)) - y[some]) * importance[some] / n
            seen_b += (g := wrong.sum()) ** 2
            machine.bias -= rate * g / np.sqrt(seen_b)
            own, index = np.unique(c, return_inverse=True)
            g = np.bincount(index, wrong[r] * x) + decay * machine.weights[own]
            new_v = np.empty((len(own), rank))
            for f in range(rank):
                v = machine.vectors[c, f]
                sums = np.bincount(r, v * x, minlength=n)
                new_v[:, f] = np.bincount(index, wrong[r] * x * (sums[r] - v * x))
            new_v += decay * machine.vectors[own]
            seen_w[own] += g * g
            machine.weights[own] -= rate * g / np.sqrt(seen_w[own])
            seen_v[own] += new_v * new_v
            machine.vectors[own] -= rate * new_v / np.sqrt(seen_v[own])
    return machine


def in_fold(id_col: Column) -> Column:
    """Whether the row of an id is held out: crc32 of the id as text is 1 modulo 3."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, fitted: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``text, y`` of at most ``fitted`` labelled documents that are not held out.

    The choice is by a hash of the id, and small by its parameter, so it is sent to the tasks
    that read the documents. A document counts once, whatever the number of its rows.
    """
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~in_fold(F.col(id_col)))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(F.col(label).cast("int")).alias("y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(fitted)
    )
    found = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    # Of several texts with one id the same counts in any order of rows.
    least = F.min_by(F.struct("text", "y"), F.struct(F.xxhash64("text"), F.col("text"))).alias("row")
    return found.join(F.broadcast(chosen), "_id").groupBy("_id").agg(least).select("_id", "row.text", "row.y")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", fitted: int = FITTED, **options) -> Machine:
    """A machine fitted to ``labels`` of documents that are not held out.

    At most ``fitted`` documents become sparse rows on the executors; the driver gets those
    rows, never texts. Without any labelled row the machine scores 0.5.
    """
    rows = StructType(
        [
            StructField("y", IntegerType()),
            StructField("_id", docs.schema[options.get("id_col", "doc_id")].dataType),
            StructField("columns", ArrayType(IntegerType(), False)),
            StructField("values", ArrayType(FloatType(), False)),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.texts(batch.column("text"))
            for start, end in arrays.steps(offsets):
                own = offsets[start : end + 1] - offsets[start]
                r, c, x = features(data[offsets[start] : offsets[end]], own)
                ends = np.searchsorted(r, np.arange(end - start + 1)).astype(np.int32)
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("y"),
                        part.column("_id"),
                        pa.ListArray.from_arrays(ends, pa.array(c.astype(np.int32))),
                        pa.ListArray.from_arrays(ends, pa.array(x.astype(np.float32))),
                    ],
                    rows.names,
                )

    sample = labelled(docs, labels, label, fitted, **options).select("text", "y", "_id")
    got = sample.mapInArrow(run, rows).toArrow().sort_by("_id").combine_chunks()
    if not got.num_rows:
        return train(*(np.zeros(0, int),) * 2, np.zeros(0), np.zeros(0))
    columns, values = (got.column(c).combine_chunks() for c in ("columns", "values"))
    lengths = np.diff(columns.offsets.to_numpy())
    return train(
        np.repeat(np.arange(len(lengths)), lengths),
        columns.values.to_numpy(),
        values.values.to_numpy().astype(float),
        got.column("y").to_numpy().astype(float),
    )


def score(
    df: DataFrame, machine: Machine, *, text_col: str = "text", score_col: str = "score",
    keep: Iterable[str] | None = None,
) -> DataFrame:
    """Add the score of each text, between 0 and 1, to the columns of ``df``, or to those in
    ``keep``.

    Only the text is looked at. Null texts count as empty and get the score of a text without
    words. A column that already has the score's name is replaced. Rows are scored one by one,
    so repeated rows, ties and an empty table need no rule.
    """
    names = [c for c in (df.columns if keep is None else keep) if c != score_col]
    schema = StructType([*[df.schema[c] for c in names], StructField(score_col, DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.texts(batch.column(text_col))
            scores = [np.zeros(0)]
            for start, end in arrays.steps(offsets):
                own = offsets[start : end + 1] - offsets[start]
                found = features(data[offsets[start] : offsets[end]], own)
                scores.append(sigmoid(machine.margins(*found, end - start)))
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, names), pa.array(np.concatenate(scores))], schema.names
            )

    return df.select(*{text_col: None, **dict.fromkeys(names)}).mapInArrow(run, schema)
