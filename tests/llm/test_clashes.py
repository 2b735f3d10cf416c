"""Operators on tables with columns named like those they work with, on repeated labelled rows, and very many buckets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hazeline.llm import exact_dedup, exchange, fingerprints, mixing, ngram_join, quality, suffix_dedup, toxicity
from tests.llm import test_suffix_dedup

NAMES = """_all _rows _copy _key _copies copies _class _slice _first _none _score score _bits _found _marked _terms _
    _range _tie _next _n _before _r row id block text_ node n at key tie whole bytes fingerprint_ size component
    label bucket packed kept_text lang_ keep_id length""".split()


@pytest.fixture(scope="module")
def clashing(spark, odd_rows):
    """Documents with a column per working name, each with a value that follows from the row."""
    rows = [(*row, *(hash((at, name)) % 1000 for name in NAMES)) for at, row in enumerate(odd_rows)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema + "".join(f", `{name}` int" for name in NAMES)).repartition(3)


def rows(df):
    return sorted(map(str, df.collect()))


def plain(df):
    return df.select("doc_id", "text", "lang", "source", "n_chars")


@pytest.mark.parametrize("name, operator", [
    ("mix", mixing.take),
    ("similar", ngram_join.representatives),
    ("repeats", suffix_dedup.without_repeats),
    ("dedup", exact_dedup.distinct),
])
def test_rows_keep_their_other_columns(clashing, name, operator):
    found = operator(clashing)
    assert found.columns == clashing.columns
    # The values are those of a row of the table, and the rows those of the table without extra columns.
    known = {tuple(row[c] for c in ["doc_id", "source", "n_chars", *NAMES]) for row in clashing.collect()}
    assert {tuple(row[c] for c in ["doc_id", "source", "n_chars", *NAMES]) for row in found.collect()} <= known
    # (Which of the rows that only differ in other columns stays, these decide.)
    compared = ["doc_id", "text"] if name in ("dedup", "similar") else plain(found).columns
    assert rows(found.select(*compared)) == rows(operator(plain(clashing)).select(*compared))


def test_scores_and_fingerprints_keep_other_columns(spark, clashing):
    machine = quality.train(np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.zeros(0))
    frames = {
        "score": quality.score(clashing, machine),
        "toxic": toxicity.score(clashing, toxicity.Lexicon([("bad", False)])).withColumnRenamed("score", "toxic"),
        "fingerprint": fingerprints.fingerprint(clashing),
    }
    for name, found in frames.items():
        others = [c for c in clashing.columns if c not in ("score", "hashes")]
        assert set(others) <= set(found.columns), name
        assert rows(found.select(*[f"`{c}`" for c in others])) == rows(clashing.select(*[f"`{c}`" for c in others])), name
    assert rows(fingerprints.fingerprint(clashing).select("doc_id", "fingerprint")) == rows(
        fingerprints.fingerprint(plain(clashing)).select("doc_id", "fingerprint")
    )


def test_the_quality_stage_keeps_its_rows(spark, clashing, tmp_path):
    labels = spark.createDataFrame([(number, number % 2, 0) for number in range(100, 180)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    found = corpus_pipeline.keep_quality(spark, clashing, str(tmp_path))
    assert found.columns == clashing.columns
    assert set(rows(found)) <= set(rows(clashing))


def test_models_do_not_depend_on_the_order_of_rows(spark):
    docs = [(number, f"text {number} of {copy} " + "bad words here " * (copy == 2) + "w%d " % (number % 7) * 20)
            for number in range(300) for copy in range(3)]
    labels = spark.createDataFrame([(n, n % 2, int(n % 3 == 0)) for n in range(300)], "doc_id long, quality int, toxic int")
    machines, lexicons = [], []
    for parts, seed in ((1, 1), (7, 2), (3, 3)):
        table = spark.createDataFrame(docs, "doc_id long, text string").orderBy(F.rand(seed)).repartition(parts)
        machines.append(quality.fit(table, labels))
        lexicons.append(toxicity.learn(table, labels))
    for machine in machines[1:]:
        assert np.array_equal(machine.weights, machines[0].weights) and np.array_equal(machine.vectors, machines[0].vectors)
    for lexicon in lexicons[1:]:
        assert lexicon.terms == lexicons[0].terms and lexicon.evidence == lexicons[0].evidence
        assert lexicon.weights == lexicons[0].weights


def test_a_text_with_clashing_labels_is_toxic(spark):
    docs = spark.createDataFrame([(n, "same text") for n in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(n, 0, int(n == 40)) for n in range(60)], "doc_id long, quality int, toxic int")
    sample = quality.labelled(docs, labels, "toxic", 100)
    assert sample.select("_id").distinct().count() == sample.count()


def test_very_many_buckets_and_parts(spark, monkeypatch):
    """A line in 400 documents, each time between other words, with 2^23 buckets of up to 256 parts and more."""
    monkeypatch.setattr(suffix_dedup, "layout", lambda *_: exchange.Layout(3, 23))
    monkeypatch.setattr(suffix_dedup, "PART", 1)
    line = "this line of well over fifty bytes stands in every document of the test"
    texts = [(n, f"{n * 7919 % 1000:03d} before {line} behind {n * 104729 % 1000:03d}") for n in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = test_suffix_dedup.run(docs, listed=4)
    assert sorted(found) == sorted(test_suffix_dedup.brute(texts))


def test_sizes_of_blocks_and_buckets_are_arguments(spark, odd, odd_rows, monkeypatch):
    plans = []
    plan = exchange.layout
    for module in (suffix_dedup, ngram_join):
        monkeypatch.setattr(module, "layout", lambda *given: plans.append(plan(*given)) or plans[-1])
    few = suffix_dedup.repeats(odd, block_bytes=1 << 30, bucket_bytes=1 << 30)
    many = suffix_dedup.repeats(odd, block_bytes=2000, bucket_bytes=2000)
    assert plans[0].blocks < plans[1].blocks and plans[0].bits < plans[1].bits
    assert rows(few) == rows(many)
    same = [rows(ngram_join.similar(odd, block_bytes=size, bucket_bytes=size)) for size in (1 << 30, 2_000)]
    assert same[0] == same[1] and plans[2].blocks < plans[3].blocks
