"""The registered queries of the operators. Each takes a session and the folder of tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm import (
    backoff,
    bpe,
    conversations,
    exact_dedup,
    fingerprints,
    hamming,
    html_extract,
    mixing,
    ngram_join,
    quality,
    signatures,
    suffix_dedup,
    toxicity,
)
from hazeline.llm.tables import read as table

RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = bpe.vocabulary(bpe.read_ranks(public_tokenizers.path(RANKS)), public_tokenizers.PATTERN)
    encoded = bpe.encode(docs, vocabulary, keep=["doc_id"], round_trip=True)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(
        table(spark, sf_dir, "documents"), columns=("n_bytes", "n_removed", "n_spans", "kept_sha256")
    )


def op3_similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents"), links=True)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, lexicon, keep=["doc_id"]).select(
        "doc_id",
        quality.in_fold(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages, keep=["page_id", "url"])


def op6_nearest_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    codes = hamming.signs(vectors, "embedding", "vec_id")
    return hamming.search(codes, codes.filter("id % 50 = 0"), k=10)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edits(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = quality.fit(docs, table(spark, sf_dir, "labels"))
    # The texts go no further than the scoring task: its result has ids and scores only.
    scored = quality.score(docs, machine, keep=["doc_id"])
    return scored.select(
        "doc_id",
        quality.in_fold(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.score(table(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversations.damage(table(spark, sf_dir, "conversations"))
    found = conversations.reports(damaged, id_col="id", gone_col="gone")
    counts = [F.col(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(F.col("id").alias("conv_id"), *counts, "audit", "repaired_sha256")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return signatures.search(signatures.build(docs), docs, table(spark, sf_dir, "benchmark"), k=50)


def op13_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.members(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_repeated_passages": op2_repeated_passages,
    "op3_similar_documents": op3_similar_documents,
    "op4_toxicity": op4_toxicity,
    "op5_html_text": op5_html_text,
    "op6_nearest_codes": op6_nearest_codes,
    "op7_fingerprints": op7_fingerprints,
    "op8_quality": op8_quality,
    "op9_backoff_scores": op9_backoff_scores,
    "op10_mix_sources": op10_mix_sources,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_ranked_search": op12_ranked_search,
    "op13_exact_duplicates": op13_exact_duplicates,
}
