"""NumPy over the bytes of an Arrow batch: words, hashes and sums, without a Python step per word."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes that one step holds in its arrays; one longer text makes a step of its own.
STEP_BYTES = 2_000_000

_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of each 64-bit integer (the splitmix64 finaliser)."""
    x = x.astype(U)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


#: What each byte counts as in a hash.
LETTERS = mixed(np.arange(1, 257, dtype=U))


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    with np.errstate(over="ignore"):
        up = np.full(n, _BASE, U)
        up[0] = 1
        down = np.full(n, pow(_BASE, -1, 1 << 64), U)
        down[0] = 1
        return np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)


class Hasher:
    """Hashes of any ranges of a byte array, each in constant time after one pass."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(max(20, int(len(data)).bit_length()))
        self.sums = np.zeros(len(data) + 1, U)
        np.cumsum(LETTERS[data] * up[: len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(U))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column, and where each text starts and the last ends.

    Null texts are empty.
    """
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if pa.types.is_string(column.type) else column
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(ends):
        ends = np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def steps(offsets: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``most`` bytes, or of one longer text."""
    start, last = 0, len(offsets) - 1
    while start < last:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        yield start, end
        start = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of several texts, and the text each word is of."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _WORD[data]
    starts_word = inside[1:] & ~inside[:-1]
    ends_word = inside[:-1] & ~inside[1:]
    # A text that ends in a word, next to one that starts with a word, is a border between words.
    border = offsets[1:-1]
    border = border[(border > 0) & (border < len(data))]
    touching = border[inside[border] & inside[border + 1]]
    starts_word[touching] = True
    ends_word[touching] = True
    starts, ends = np.flatnonzero(starts_word), np.flatnonzero(ends_word)
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``STEP_BYTES``, cut between texts or behind white space; a longer word is one range."""
    start, total = 0, len(data)
    while start < total:
        end = min(start + STEP_BYTES, total)
        if end < total:
            border = int(offsets[np.searchsorted(offsets, end, "right") - 1])
            blanks = np.flatnonzero(~_WORD[data[start:end]])
            end = max(border, start + int(blanks[-1]) + 1 if len(blanks) else 0)
            if end <= start:
                end = _word_end(data, start + STEP_BYTES, int(offsets[np.searchsorted(offsets, start, "right")]))
        yield start, end
        start = end


def _word_end(data: np.ndarray, at: int, last: int) -> int:
    """Where the word that goes on at ``at`` ends."""
    while at < last:
        blanks = np.flatnonzero(~_WORD[data[at : min(at + STEP_BYTES, last)]])
        if len(blanks):
            return at + int(blanks[0])
        at += STEP_BYTES
    return last


def _hash_whole(data: np.ndarray) -> np.ndarray:
    """What ``Hasher`` gives for all of a long array, from parts of it."""
    up = _powers(STEP_BYTES.bit_length())[0]
    total, factor = U(0), U(1)
    with np.errstate(over="ignore"):
        for start in range(0, len(data), STEP_BYTES):
            part = data[start : start + STEP_BYTES]
            total += (LETTERS[part] * up[: len(part)]).sum(dtype=U) * factor
            factor *= up[STEP_BYTES]
        return mixed(np.array([total + U(len(data))], U))


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash in lower case, start and end of each word of several texts, and the text it is of.

    Works on a piece at a time, so that what it holds besides the result is bounded, whatever the
    length of a text or of a word.
    """
    found = [(np.zeros(0, U), *(np.zeros(0, np.int64) for _ in range(2)))]
    for start, end in pieces(data, offsets):
        part = lower(data[start:end])
        inner = offsets[np.searchsorted(offsets, start, "right") : np.searchsorted(offsets, end, "left")]
        starts, ends, _ = words(part, np.concatenate([[0], inner - start, [end - start]]))
        if len(starts) == 1 and len(part) > 2 * STEP_BYTES:
            hashes = _hash_whole(part[starts[0] : ends[0]])
        else:
            hashes = Hasher(part)(starts, ends)
        found.append((hashes, starts + start, ends + start))
    hashes, starts, ends = (np.concatenate(column) for column in zip(*found))
    return hashes, starts, ends, np.searchsorted(offsets, starts, "right") - 1


def lower(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[data]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All integers of several ranges, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    firsts = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(firsts - starts, lengths)
