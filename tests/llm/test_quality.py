import random

import numpy as np
from pyspark.sql import functions as F

from hazeline.llm import quality
from tests.llm.conftest import words


def test_margin_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(1)
    machine = quality.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, 3)))
    columns, values = np.array([1, 4, 7, 9, 30]), rng.normal(size=5)
    expected = 0.3 + machine.weights[columns] @ values
    for i in range(5):
        for j in range(i):
            expected += machine.vectors[columns[i]] @ machine.vectors[columns[j]] * values[i] * values[j]
    assert np.isclose(machine.margins(np.zeros(5, int), columns, values, 1)[0], expected)


def test_training_learns_an_interaction():
    """Neither of two features tells, only both together do."""
    rng = np.random.default_rng(2)
    rows, columns, values, y = [], [], [], []
    for row in range(1200):
        a, b = rng.integers(0, 2, 2)
        for column, value in ((0, 2 * a - 1), (1, 2 * b - 1), (2 + rng.integers(0, 50), 1)):
            rows.append(row), columns.append(column), values.append(float(value))
        y.append(int(a == b))
    data = np.array(rows), np.array(columns), np.array(values), np.array(y, float)
    machine = quality.train(*data, epochs=25)
    assert ((machine.margins(*data[:3], 1200) > 0) == (data[3] == 1)).mean() > 0.95


def corpus(spark):
    rng = random.Random(7)
    docs, labels = [], []
    for number in range(900):
        own = words(rng, rng.randint(5, 150))
        good = rng.random() < 0.7
        if not good:
            own = [word + rng.choice(["%%%", "&&&"]) for word in own] if number % 2 else [w.upper() + "!!" for w in own]
        docs.append((number, " ".join(own), "x"))
        labels.append((number, int(good)))
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels)


def test_held_out_documents(spark):
    docs, labels, good = corpus(spark)
    machine = quality.fit(docs, labels)
    held = quality.score(docs, machine).withColumn("held", quality.in_fold(F.col("doc_id"))).filter("held").collect()
    assert len(held) > 200
    assert np.mean([(row.score >= 0.5) == bool(good[row.doc_id]) for row in held]) > 0.98
    again = quality.fit(docs.repartition(7), labels.repartition(3))
    assert np.array_equal(machine.weights, again.weights) and np.array_equal(machine.vectors, again.vectors)


def test_fold_is_not_learned_from(spark):
    docs, labels, _ = corpus(spark)
    held = quality.in_fold(F.col("doc_id"))
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(quality.fit(docs, labels).weights, quality.fit(docs, flipped).weights)


def test_odd_documents(spark, odd, odd_rows, no_docs):
    docs, labels, _ = corpus(spark)
    machine = quality.fit(docs, labels)
    scored = quality.score(odd, machine)
    assert sorted(scored.columns) == sorted(odd.columns)
    rows = scored.collect()
    assert len(rows) == len(odd_rows) and all(0 <= row.score <= 1 for row in rows)
    by_text = {}
    for row in rows:
        assert by_text.setdefault(row.text, row.score) == row.score
    assert by_text[None] == by_text[""]
    assert quality.score(no_docs, machine).count() == 0
    none = labels.filter("doc_id < 0")
    assert {row.score for row in quality.score(odd, quality.fit(odd, none)).collect()} == {0.5}
    one_class = spark.createDataFrame([(100, 1), (None, 0), (101, None)], "doc_id long, quality int")
    assert all(row.score > 0.5 for row in quality.score(odd, quality.fit(odd, one_class)).collect())


def test_features_do_not_depend_on_the_batch():
    texts = [b"one two", b"", b"three", b"\xc3\xa9t\xc3\xa9 || x"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    together = quality.features(data, np.cumsum([0, *map(len, texts)]))
    for number, text in enumerate(texts):
        rows, columns, values = quality.features(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        own = together[0] == number
        assert np.array_equal(columns, together[1][own]) and np.allclose(values, together[2][own])
