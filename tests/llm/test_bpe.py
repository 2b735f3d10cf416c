import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from hazeline.llm import bpe
from hazeline.llm.queries import RANKS


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path(RANKS))


@pytest.fixture(scope="module")
def vocabulary(ranks):
    return bpe.vocabulary(ranks, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def encoding(ranks):
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_rank_library(vocabulary, encoding, ranks):
    rng = random.Random(1)
    coder = bpe.Codec(vocabulary)
    tokens = [token.decode("utf-8", "ignore") for token in ranks]
    alphabet = "aab'sreé  \n\t\r\x0b\x1c\x85  　1٣⅔!?—漢字\U0001f600\U00010ee7́"
    texts = ["", " ", "\n\n", "a" * 3000, "=" * 999, "'s 're 'll don't", "<|endoftext|>", "a\ue000b \ue000", "\ue000", " \ue000\ue000x"]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 80))) for _ in range(1500)]
    texts += ["".join(rng.choices(tokens, k=8)) for _ in range(1500)]
    texts += ["".join(rng.choices("ab", k=40)) + "".join(rng.choices("-=", k=30)) for _ in range(500)]
    texts += ["".join(map(chr, range(start, start + 900))) for start in (0, 0x300, 0xA000, 0x10D00, 0x1E000, 0x31000)]
    for text, packed in zip(texts, coder.encode(texts), strict=True):
        ids = list(struct.unpack(f"<{len(packed) // 4}I", packed))
        assert ids == encoding.encode_ordinary(text), text
        assert coder.decode(ids) == text.encode()


def test_odd_documents(spark, odd, odd_rows, vocabulary, encoding):
    encoded = bpe.encode(odd, vocabulary, round_trip=True)
    added = ["ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(encoded.columns) == sorted({*odd.columns, *added})
    rows = bpe.decode(encoded, vocabulary).select("doc_id", "text", *added, "decoded").collect()
    assert len(rows) == len(odd_rows)
    for row in rows:
        ids = encoding.encode_ordinary(row.text or "")
        assert row.ids == ids and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert bytes(row.decoded) == (row.text or "").encode()
        assert row.decoded_sha256 == hashlib.sha256(row.decoded).hexdigest()


def test_spans_and_split_characters(spark, vocabulary):
    text = "naïve \U0001f9ff漢 text"
    df = spark.createDataFrame([(text,), (None,), ("",)], "text string")
    rows = bpe.decode(bpe.encode(df, vocabulary, spans=True), vocabulary, strings=True).collect()
    row = next(row for row in rows if row.text == text)
    assert "".join(row.pieces) == text
    assert "" in row.pieces  # an id that only begins a character adds nothing yet
    for start, end, piece in zip(row.starts, row.ends, row.pieces, strict=True):
        assert piece in ("", *(text[start:end],)) or piece.strip() in text[start:end]
    assert row.ends[-1] == len(text)
    assert all(row.ids == [] and row.pieces == [] for row in rows if not row.text)


def test_broken_bytes_decode_to_replacements(vocabulary):
    coder = bpe.Codec(vocabulary)
    half = coder.token_bytes.index(b"\xc3")
    assert coder.strings([half]) == ["�"]
    assert coder.strings([]) == []


def test_no_rows(no_docs, vocabulary):
    assert bpe.decode(bpe.encode(no_docs, vocabulary), vocabulary).count() == 0
