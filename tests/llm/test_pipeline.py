from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from hazeline.llm import bpe, mixing
from hazeline.llm.queries import RANKS
from hazeline.llm.tables import read as table
from hazeline.llm.tables import stored
from tests.llm import test_ngram_join, test_suffix_dedup

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs = table(spark, SF_DIR, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), name)
        out.append(docs)
    return out


def rows(df):
    return [(row.doc_id, row.text) for row in df.collect()]


def test_stages_return_documents(results):
    for docs in results[1:-1]:
        assert docs.columns == results[0].columns


def test_quality_keeps_clean_documents(results, spark):
    labels = {row.doc_id: row.quality for row in table(spark, SF_DIR, "labels").collect()}
    kept = Counter(rows(results[1]))
    assert kept <= Counter(rows(results[0]))
    ids = {number for number, _ in kept}
    good = [number for number, quality in labels.items() if quality]
    assert sum(number in ids for number in good) >= 0.97 * len(good)


def test_one_of_each_group_stays(results):
    before = rows(results[1])
    groups = test_ngram_join.brute(before)
    expected = {(number, text) for (number, text), (_, n, group) in zip(before, groups, strict=True) if not n or group == number}
    assert Counter(rows(results[2])) == Counter(expected)


def test_repeats_go(results):
    expected = [(number, kept.decode("utf-8", "ignore")) for number, *_, kept in test_suffix_dedup.brute(rows(results[2]))]
    assert Counter(rows(results[3])) == Counter(expected)
    assert all(row.n_chars == len(row.text) for row in results[3].collect())


def test_mix_takes_what_it_says(results):
    copies = defaultdict(int)
    for row in mixing.mix_documents(results[3]).collect():
        copies[row.doc_id] += row.copies
    assert Counter(number for number, _ in rows(results[4])) == Counter({n: c for n, c in copies.items() if c})
    assert set(rows(results[4])) <= set(rows(results[3]))


def test_tokens(results):
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = dict(rows(results[4]))
    tokens = results[5].collect()
    assert len(tokens) == results[4].count()
    assert all(row.ids == encoding.encode_ordinary(texts[row.doc_id]) for row in tokens)


def test_run(spark, results):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.columns == results[-1].columns
    assert sorted(map(str, found.collect())) == sorted(map(str, results[-1].collect()))


def test_no_documents(spark, no_docs, tmp_path):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, SF_DIR, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_documents(spark, odd, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, SF_DIR, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
