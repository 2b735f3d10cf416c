import random
import tracemalloc

import numpy as np
import pytest

from hazeline.llm import arrays, ngram_join, quality
from hazeline.llm.backoff import Block


def table(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    return data, np.cumsum([0, *(len(text.encode()) for text in texts)])


def whole(data, offsets):
    low = arrays.lower(data)
    starts, ends, of = arrays.words(low, offsets)
    return arrays.Hasher(low)(starts, ends), starts, ends, of


@pytest.mark.parametrize("step", [1, 2, 5, 16, 100, 10_000])
def test_words_by_pieces(monkeypatch, step):
    rng = random.Random(step)
    texts = ["", "a", " ", "Ab  c", "x" * 300, "x" * 300 + " y", "", " " * 40, "é" * 33, "end"]
    texts += ["".join(rng.choices("aB é\t\n", k=rng.randrange(60))) for _ in range(100)]
    rng.shuffle(texts)
    data, offsets = table(texts)
    expected = whole(data, offsets)
    monkeypatch.setattr(arrays, "STEP_BYTES", step)
    assert all(np.array_equal(a, b) for a, b in zip(arrays.hashed_words(data, offsets), expected, strict=True))
    cut = [(a, b) for a, b in arrays.pieces(data, offsets)]
    assert [a for a, _ in cut] == [0, *(b for _, b in cut[:-1])] and cut[-1][1] == len(data)


def test_no_bytes():
    assert all(len(column) == 0 for column in arrays.hashed_words(*table([])))
    assert all(len(column) == 0 for column in arrays.hashed_words(*table(["", ""])))


def test_results_do_not_depend_on_the_pieces(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["alpha", "Beta", "c.", "|", "9"], k=rng.randrange(80))) for _ in range(60)] + ["", "z" * 99]
    rows = [text.encode() for text in texts]
    sets, kinds = ngram_join.shingles(rows), quality.features(*table(texts))
    monkeypatch.setattr(arrays, "STEP_BYTES", 11)
    assert all(np.array_equal(a, b) for a, b in zip(ngram_join.shingles(rows), sets, strict=True))
    assert all(np.array_equal(a, b) for a, b in zip(quality.features(*table(texts)), kinds, strict=True))


LONG = 64 << 20


@pytest.mark.parametrize("kind", ["words", "one word"])
@pytest.mark.parametrize("operator", ["shingles", "features", "n-grams"])
def test_a_text_of_64_megabytes_takes_less_than_a_gigabyte(operator, kind):
    import pyarrow as pa

    line = b"Lorem ipsum dolor sit amet, consectetur adipiscing elit. " if kind == "words" else b"x" * 64
    text = (line * (LONG // len(line) + 1))[:LONG]
    tracemalloc.start()
    try:
        if operator == "shingles":
            ngram_join.shingles([text])
        elif operator == "features":
            quality.features(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        else:
            Block(pa.table({"id": [1], "text": [text.decode()]}), 3).distinct()
        assert tracemalloc.get_traced_memory()[1] < 1 << 30
    finally:
        tracemalloc.stop()
