"""From raw documents to training tokens: filter, deduplicate, mix, encode.

Each stage takes the documents that the one before kept and returns those that it keeps, with the
columns of ``documents``; the last returns tokens. ``run`` writes each stage's result to the shared
folder and reads it back.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm import bpe, mixing, ngram_join, quality, suffix_dedup
from hazeline.llm.queries import RANKS
from hazeline.llm.tables import read, stored, unused


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, fitted to the labels, scores at least 0.5."""
    machine = quality.fit(docs, read(spark, sf_dir, "labels"))
    score = unused("_score", docs.columns)
    return quality.score(docs, machine, score_col=score).filter(F.col(score) >= 0.5).select(*docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a Jaccard index of 0.8 or more, the one with the smallest id."""
    return ngram_join.representatives(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 bytes or more that a document with a smaller id has.

    A document that loses all its text stays, with an empty one.
    """
    cut = suffix_dedup.without_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.take(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each text, with hashes of the ids and of the text they decode to."""
    vocabulary = bpe.vocabulary(bpe.read_ranks(public_tokenizers.path(RANKS)), public_tokenizers.PATTERN)
    return bpe.encode(docs, vocabulary, keep=["doc_id", "source"], round_trip=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("similar", keep_one_of_similar),
    ("repeats", cut_repeats),
    ("mix", mix_sources),
    ("tokens", encode_tokens),
]

#: Neither the classifier nor the tokenizer can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` to tokens; empty if no document is left on the way."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
