"""Language-model scores by stupid backoff, over n-gram counts of the whole corpus."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.llm import arrays
from hazeline.llm.exchange import (
    NO_ID, PACKED, Layout, compressed, cuts, layout, opened, ordered, pack, pack_sorted, unpack, unpack_sorted,
)

#: Words of the longest n-grams, and what each step to a shorter one costs.
ORDER = 3
ALPHA = 0.4
#: Bits of an n-gram's hash.
KEY_BITS = 64
#: Bytes of text per block and bucket; a word makes several n-grams, so buckets take less text.
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 4 << 20
U = np.uint64
EMPTY = (arrays.mixed(np.zeros(1, U)) >> U(64 - KEY_BITS)) << U(64 - KEY_BITS)


class Block:
    """The n-grams of a block's documents, in a fixed order.

    ``grams[n]`` has the hash of the n-gram that ends at each word, for those that lie within
    their text, ``fits[n]`` tells which do. The empty n-gram counts words.
    """

    def __init__(self, table: pa.Table, order: int):
        _, rows = ordered(table)
        self.ids = [number for number, _ in rows]
        texts = [text.encode() for _, text in rows]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.cumsum([0, *map(len, texts)])
        del rows, texts
        word, _, _, of = arrays.hashed_words(data, offsets)
        self.of = of.astype(np.int32)
        self.counts = np.bincount(self.of, minlength=len(self.ids))
        del data, of
        place = (np.arange(len(word)) - (np.cumsum(self.counts) - self.counts)[self.of]).astype(np.int32)
        self.fits = [place >= n - 1 for n in range(order + 1)]
        self.grams = [EMPTY]
        total = np.zeros(len(word), U)
        for n in range(1, order + 1):
            # The n-gram with one word more in front.
            total *= U(0x100000001B3)
            total[n - 1 :] += word[: len(word) - n + 1]
            keys = arrays.mixed(total[self.fits[n]] + U(n))
            self.grams.append((keys >> U(64 - KEY_BITS)) << U(64 - KEY_BITS))

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """All n-grams of the block, in order, and how often it has them."""
        found = [np.unique(keys, return_counts=True) for keys in self.grams[1:]]
        words = len(self.of)
        keys = np.concatenate([EMPTY[: words > 0], *(keys for keys, _ in found)])
        counts = np.concatenate([[words][: words > 0], *(counts for _, counts in found)]).astype(np.int64)
        by = np.argsort(keys, kind="stable")
        return keys[by], counts[by]

    def counted(self, keys: np.ndarray, totals: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
        """How often each word's n-gram occurs in other documents, and in all; 0 where it doesn't fit."""
        if order == 0:
            total = totals[np.searchsorted(keys, EMPTY[0])]
            return total - self.counts[self.of], np.full(len(self.of), total)
        own, of = self.grams[order], self.of[self.fits[order]]
        by = np.lexsort((of, own))
        new = np.ones(len(by), bool)
        new[1:] = (own[by[1:]] != own[by[:-1]]) | (of[by[1:]] != of[by[:-1]])
        group = np.cumsum(new) - 1
        mine = np.bincount(group)[group] if len(by) else group
        elsewhere, everywhere = (np.zeros(len(self.of), np.int64) for _ in range(2))
        found = np.empty(len(by), np.int64)
        found[by] = totals[np.searchsorted(keys, own[by])]
        everywhere[self.fits[order]] = found
        found[by] -= mine
        elsewhere[self.fits[order]] = found
        return elsewhere, everywhere


def _sparse(counts: np.ndarray, usual: int) -> bytes:
    """Which counts are above the usual one, a bit each, and those."""
    above = counts > usual
    return np.packbits(above).tobytes() + pack(counts[above].astype(np.int64))


def _dense(packed: bytes, n: int, usual: int) -> np.ndarray:
    """The counts of ``_sparse``."""
    size = -(-n // 8)
    out = np.full(n, usual, np.int64)
    above = np.unpackbits(np.frombuffer(packed, np.uint8, size), count=n).astype(bool)
    out[above] = unpack(packed[size:], ("i8",))[0]
    return out


def _packed(bits: int, order: int):
    low = U((1 << (KEY_BITS - bits)) - 1)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        keys, counts = Block(opened(table), order).distinct()
        rest = (keys >> U(64 - KEY_BITS)) & low
        rows = [(bucket, pack_sorted(rest[a:b]) + _sparse(counts[a:b], 1)) for bucket, a, b in cuts(keys, bits)]
        return pa.table(
            {
                "bucket": pa.array([bucket for bucket, _ in rows], pa.int64()),
                "block": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                "packed": pa.array([packed for _, packed in rows], pa.binary()),
            }
        )

    return run


def _counted(key: tuple, table: pa.Table) -> pa.Table:
    """The count table of a bucket, joined to the n-grams of each block.

    A block is told which of its n-grams other blocks have, one bit each, and how often those do.
    """
    blocks = table.column("block").to_pylist()
    parts, counts, begins = [], [], [0]
    for packed in table.column("packed").to_pylist():
        own, rest = unpack_sorted(packed)
        parts.append(own)
        counts.append(_dense(rest, len(own), 1))
        begins.append(begins[-1] + len(own))
    keys, counts = np.concatenate(parts), np.concatenate(counts)
    del parts
    by = np.argsort(keys, kind="stable")
    new = np.ones(len(by), bool)
    new[1:] = keys[by[1:]] != keys[by[:-1]]
    others = np.empty(len(by), np.int64)
    others[by] = np.add.reduceat(counts[by], np.flatnonzero(new))[np.cumsum(new) - 1]
    others -= counts
    packed = [_sparse(others[a:b], 0) for a, b in zip(begins, begins[1:], strict=False)]
    return pa.table(
        {
            "bucket": pa.array([key[0].as_py()] * len(blocks), pa.int64()),
            "block": pa.array(blocks, pa.int32()),
            "packed": pa.array(packed, pa.binary()),
        }
    )


def _scores(block: Block, counts: list[np.ndarray], order: int, alpha: float) -> np.ndarray:
    """The logarithm of each word's score, in millionths, as integers, from the counts of its n-grams by order.

    The longest n-gram that other documents have decides: its count by that of its words but the
    last, times ``alpha`` for each order below the longest that fits. A word that no other document
    has counts once.
    """
    n = len(block.of)
    ratio, penalty, open_ = np.ones(n), np.zeros(n, np.int64), np.ones(n, bool)
    count = counts[order]
    for at in range(order, 0, -1):
        shorter = counts[at - 1]
        # What stands before the word: the n-gram one shorter that ends at the word before.
        before = np.concatenate([[0], shorter[:-1]]) if at > 1 else shorter
        if at == 1:
            count = np.maximum(count, 1)
            before = np.maximum(before, 1)
        # The count of an n-gram can't exceed that of its beginning, but for texts left out of both.
        hit = open_ & block.fits[at] & (count > 0)
        ratio[hit] = count[hit] / np.maximum(before[hit], 1)
        penalty[open_ & block.fits[at] & ~hit] += 1
        open_ &= ~hit
        count = shorter
    return np.rint(np.log(ratio * alpha**penalty) * 1e6).astype(np.int64)


def score(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, alpha: float = ALPHA,
    block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``id, n_words, micro_nats, corpus_micro_nats`` of each row of ``docs``: the log-score of its words, summed.

    Counts for ``micro_nats`` are of all other rows: a text's own words don't vouch for it, but a copy's do.
    Those for ``corpus_micro_nats`` are of all rows, so that no word backs off. Words are in ASCII lower case. Null and empty texts have no words and score 0. Rows with equal
    ids are texts of their own, null ids stay null.

    Each block sends its distinct n-grams, with counts, to the buckets that the count table is
    divided in by hash; these join them to the totals. A frequent n-gram is thus one row per
    block. N-grams are known by ``KEY_BITS`` bits of a hash. Texts are dealt to the blocks compressed,
    as they would else be a quarter of what is shuffled.
    """
    plan: Layout = layout(docs, text_col, block_bytes, bucket_bytes)
    rows, bits = compressed(docs, plan, id_col, text_col), plan.bits
    counted = (
        rows.groupBy("block").applyInArrow(_packed(bits, order), PACKED).groupBy("bucket").applyInArrow(_counted, PACKED)
    )

    def scored(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(opened(table), order)
        keys, counts = block.distinct()
        totals = counts.astype(np.int64)
        starts = {bucket: (a, b) for bucket, a, b in cuts(keys, bits)}
        for bucket, packed in zip(replies.column("bucket").to_pylist(), replies.column("packed").to_pylist(), strict=True):
            a, b = starts[bucket]
            totals[a:b] += _dense(packed, b - a, 0)
        sums = []
        found = [block.counted(keys, totals, at) for at in range(order + 1)] if len(block.of) else []
        for own in zip(*found) if found else [()] * 2:
            said = _scores(block, list(own), order, alpha) if found else np.zeros(0, np.int64)
            sums.append(np.zeros(len(block.ids), np.int64))
            np.add.at(sums[-1], block.of, said)
        return pa.table(
            {
                "id": pa.array([None if number == NO_ID else number for number in block.ids], pa.int64()),
                "n_words": pa.array(block.counts.astype(np.int64)),
                "micro_nats": pa.array(sums[0]),
                "corpus_micro_nats": pa.array(sums[1]),
            }
        )

    found = rows.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(
        scored, "id long, n_words long, micro_nats long, corpus_micro_nats long"
    )
    return found.select(F.col("id").alias(id_col), "n_words", "micro_nats", "corpus_micro_nats")
