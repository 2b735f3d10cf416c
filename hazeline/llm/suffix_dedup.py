"""Removal of passages that an earlier document has, by prefix-free parsing.

A rolling hash over K bytes picks triggers: the first least hash of each stretch of L bytes, so that
every L bytes hold one. A phrase is all text whose L-byte stretches share a trigger. Phrases
overlap by L - 1 bytes, so each L bytes of the corpus lie whole in just one phrase, and the first
L bytes of any suffix are those of a suffix of a phrase. Matches of L bytes thus follow from the
dictionary of distinct phrases, ordered by the hashes of trigger and phrase, and from the suffix array
of those of its phrases that share a trigger with another: their suffixes in the order of their first L
bytes, where equal ones are neighbours. The parse says which documents have which phrase and so carries
what the dictionary and the array tell to the corpus; as no match goes beyond a phrase, the parse needs no
suffix array of its own. Text that is copied as a whole makes the same phrases and is settled in the
dictionary; only phrases at the edges of copies have their suffixes ordered.

A passage that many documents share has other neighbours in each, and so, at its edges, as many
phrases with one trigger as there are documents. Such a common trigger is not settled by phrase: a
block lists one of its phrases only, with how many there are, and the suffixes go, each with the
smallest id that the block has of it, to parts of the bucket by their own hash, by which they are
ordered there, as their text would be sent once per document. The number of parts
grows with that of the phrases, so no group grows with the number of neighbours.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from hazeline.llm import arrays
from hazeline.llm.exchange import (
    BLOCK_BYTES, BUCKET_BYTES, NO_ID, PACKED, Layout, blocked, bucket_of, cuts, delta, layout, ordered, pack, pack_sorted, unpack, unpack_sorted,
)

#: Bytes of a match.
LENGTH = 50
#: Bytes of a trigger.
TRIGGER = 24
#: Positions of which the triggers are found at once; one fewer bit of the hashes per bit of this.
PIECE_BITS = 20
#: Phrases with one trigger that a block lists; with more, the trigger is a common one. So it is, too, with
#: this many times as many in all blocks that list theirs.
LISTED = 32
LISTED_BY_ALL = 128
#: Phrases of a common trigger for which its bucket has one more part, about.
PART = 4096
#: Phrases of which the suffixes are hashed at once, and neighbours of a suffix array compared at once.
HASHED = 1 << 15
#: What is known of a phrase: others have it, too; it is one of those of a common trigger; and from this
#: bit on how many bits the number of these phrases, or in a reply the number of parts, has.
SEVERAL, COMMON, BITS = 1, 2, 2
U = np.uint64


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    count, span, least = len(values) - width + 1, 1, values
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    return np.minimum(least[:count], least[rest : rest + count]) if rest else least[:count]


@dataclass
class Parse:
    """Phrases of some texts: hashes of trigger and phrase, text, and first and last suffix."""

    triggers: np.ndarray
    phrases: np.ndarray
    texts: np.ndarray
    firsts: np.ndarray
    lasts: np.ndarray


def parse(texts: list[bytes], length: int, trigger: int) -> Parse:
    """The phrases of each text; one shorter than a match has none."""
    found: list[tuple[np.ndarray, ...]] = []
    piece = (1 << PIECE_BITS) - length
    low = U((1 << PIECE_BITS) - 1)
    for number, text in enumerate(texts):
        data = np.frombuffer(text, np.uint8)
        for start in range(0, len(data) - length + 1, piece):
            part = data[start : start + piece + length - 1]
            hasher = arrays.Hasher(part)
            at = np.arange(len(part) - trigger + 1)
            hashes = hasher(at, at + trigger)
            # The place in the low bits makes the first of equal hashes the least.
            least = _least((hashes & ~low) | at.astype(U), length - trigger + 1)
            place = (least & low).astype(np.int64)
            firsts = np.flatnonzero(np.diff(place, prepend=-1))
            lasts = np.append(firsts[1:], len(place)) - 1
            found.append(
                (
                    arrays.mixed(hashes[place[firsts]]),  # least hashes are no even spread
                    hasher(firsts, lasts + length),
                    np.full(len(firsts), number),
                    firsts + start,
                    lasts + start,
                )
            )
    if not found:
        return Parse(np.zeros(0, U), np.zeros(0, U), *(np.zeros(0, np.int64) for _ in range(3)))
    return Parse(*(np.concatenate(column) for column in zip(*found, strict=True)))


@dataclass
class Dictionary:
    """The distinct phrases of a block, ordered by trigger and phrase.

    ``entry`` is the phrase of each place of the parse, ``where`` a place of each phrase, ``least``
    the smallest id of a document that has it, ``several`` whether others have it, too.
    """

    triggers: np.ndarray
    phrases: np.ndarray
    entry: np.ndarray
    where: np.ndarray
    least: np.ndarray
    several: np.ndarray


def dictionary(found: Parse, ids: np.ndarray, bits: int) -> Dictionary:
    """Triggers are cut to the bits of the bucket and 32 more, which is enough to group by."""
    triggers = found.triggers >> U(32 - bits)
    order = np.lexsort((found.phrases, triggers))
    t, p, own = triggers[order], found.phrases[order], ids[found.texts[order]]
    new = np.ones(len(order), bool)
    new[1:] = (t[1:] != t[:-1]) | (p[1:] != p[:-1])
    starts = np.flatnonzero(new)
    entry = np.empty(len(order), np.int64)
    entry[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(own, starts) if len(starts) else own
    most = np.maximum.reduceat(own, starts) if len(starts) else own
    return Dictionary(t[starts], p[starts], entry, order[starts], least, most != least)


@dataclass
class Suffixes:
    """Distinct suffixes of a block: part of a bucket, hash and smallest id of each, and which one
    each suffix is."""

    cells: np.ndarray
    hashes: np.ndarray
    least: np.ndarray
    entry: np.ndarray

    def cuts(self) -> list[tuple[int, int, int]]:
        starts = np.flatnonzero(np.diff(self.cells, prepend=-1))
        ends = np.append(starts[1:], len(self.cells))
        return list(zip(self.cells[starts].tolist(), starts.tolist(), ends.tolist(), strict=False))


class Block:
    """The documents of a block, in a fixed order, with their phrases."""

    def __init__(self, table: pa.Table, length: int, trigger: int, bits: int, listed: int = LISTED):
        self.order, rows = ordered(table)
        self.texts = [text.encode() for _, text in rows]
        self.ids = np.array([number for number, _ in rows], np.int64)
        self.parse = parse(self.texts, length, trigger)
        self.words = dictionary(self.parse, self.ids, bits)
        self.length, self.bits = length, bits
        self._list(listed)
        self.cuts = cuts(self.words.triggers[self.listed] << U(32 - bits), bits)

    def _list(self, listed: int) -> None:
        """The phrases that are listed, what is known of each, and which one speaks for each phrase.

        Of a trigger with more than ``listed`` phrases only the first is.
        """
        words = self.words
        n = len(words.triggers)
        new = np.ones(n, bool)
        new[1:] = words.triggers[1:] != words.triggers[:-1]
        starts = np.flatnonzero(new)
        of = np.cumsum(new) - 1
        common = np.diff(np.append(starts, n)) > listed
        self.head = np.where(common[of], starts[of], np.arange(n))
        self.listed = np.flatnonzero(self.head == np.arange(n))
        known = np.where(words.several, SEVERAL, 0)
        if n:
            own = np.minimum.reduceat(words.least, starts) != np.maximum.reduceat(words.least, starts)
            own |= np.maximum.reduceat(known, starts) > 0
            many = np.ceil(np.log2(np.diff(np.append(starts, n))[common] + 1)).astype(np.int64)
            known[starts[common]] = COMMON + np.where(own, SEVERAL, 0)[common] + (many << BITS)
        self.known = known.astype(np.uint8)

    def packed_phrases(self, block: int) -> pa.Table:
        words = self.words
        rows = []
        for bucket, start, end in self.cuts:
            some = self.listed[start:end]
            rest = (words.triggers[some] & U(0xFFFFFFFF)).astype(np.uint32)
            rows.append((bucket, pack(delta(rest), words.phrases[some], words.least[some], self.known[some])))
        return _rows(block, rows)

    def answered(self, replies: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per phrase, the smallest id of any document known to have it, whether its suffixes count,
        whether these are common ones, and into how many parts, as bits, these divide."""
        least, flags = self.words.least.copy(), np.zeros(len(self.words.least), np.uint8)
        starts = {bucket: start for bucket, start, _ in self.cuts}
        for bucket, packed in zip(replies.column("bucket").to_pylist(), replies.column("packed").to_pylist(), strict=True):
            at, other, flag = unpack(packed, ("u4", "i8", "u1"))
            at = self.listed[at.astype(np.int64) + starts[bucket]]
            least[at] = np.minimum(least[at], other)
            flags[at] = flag
        flags = flags[self.head]
        return least, (flags & SEVERAL).astype(bool), (flags & COMMON).astype(bool), (flags >> BITS).astype(U)

    def suffixes(self, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The open phrases, and where the suffixes of each start among those of all."""
        chosen = np.flatnonzero(open_)
        where = self.words.where[chosen]
        return chosen, np.cumsum(np.append(0, self.parse.lasts[where] - self.parse.firsts[where] + 1))

    def text_of(self, chosen: np.ndarray) -> list[bytes]:
        """The text of each of these phrases."""
        where = self.words.where[chosen]
        return [
            self.texts[text][first : last + self.length]
            for text, first, last in zip(
                self.parse.texts[where].tolist(), self.parse.firsts[where].tolist(), self.parse.lasts[where].tolist(),
                strict=True,
            )
        ]

    def common_suffixes(self, common: np.ndarray, parts: np.ndarray) -> Suffixes:
        """The distinct suffixes of phrases of common triggers, by part of a bucket and by hash."""
        chosen, begins = self.suffixes(common)
        counts = np.diff(begins)
        hashes, cells = np.zeros(int(begins[-1]), U), np.zeros(int(begins[-1]), np.int64)
        for start in range(0, len(chosen), HASHED):
            some = slice(start, start + HASHED)
            n, at = counts[some], slice(begins[start], begins[min(start + HASHED, len(chosen))])
            hashes[at] = _hashes(b"".join(self.text_of(chosen[some])), n, self.length)
            bits = np.repeat(parts[chosen[some]], n)
            part = np.where(bits > 0, hashes[at] >> (U(64) - np.maximum(bits, U(1))), U(0)).astype(np.int64)
            bucket = bucket_of(self.words.triggers[chosen[some]] << U(32 - self.bits), self.bits)
            cells[at] = np.repeat(bucket, n) + ((part + 1) << self.bits)
        order = np.lexsort((hashes, cells))
        h, c = hashes[order], cells[order]
        new = np.ones(len(order), bool)
        new[1:] = (c[1:] != c[:-1]) | (h[1:] != h[:-1])
        starts = np.flatnonzero(new)
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(new) - 1
        own = np.repeat(self.words.least[chosen], counts)[order]
        return Suffixes(c[starts], h[starts], np.minimum.reduceat(own, starts) if len(starts) else own, entry)

    def packed_suffixes(self, block: int, replies: pa.Table) -> pa.Table:
        """The text of open phrases, with the smallest id and the number of suffixes of each; of common
        suffixes, the hash and the smallest id."""
        _, open_, common, parts = self.answered(replies)
        chosen, begins = self.suffixes(open_ & ~common)
        counts, texts = np.diff(begins), self.text_of(chosen)
        rows = [
            (bucket, pack(self.words.least[chosen[a:b]], counts[a:b].astype(np.uint32)) + b"".join(texts[a:b]))
            for bucket, a, b in self._cut(chosen)
        ]
        found = self.common_suffixes(common, parts)
        rows += [(cell, pack_sorted(found.hashes[a:b]) + pack(found.least[a:b])) for cell, a, b in found.cuts()]
        return _rows(block, rows)

    def _cut(self, chosen: np.ndarray) -> list[tuple[int, int, int]]:
        """Bucket, start and end of the runs of chosen phrases, which are in order of trigger."""
        return cuts(self.words.triggers[chosen] << U(32 - self.bits), self.bits)

    def removed(self, replies: pa.Table) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray]]:
        """Id, bytes, and starts and ends of what goes, for each document."""
        second = np.array(replies.column("suffixes").to_pylist(), bool)
        least, open_, common, parts = self.answered(replies.filter(pa.array(~second)))
        chosen, firsts = self.suffixes(open_ & ~common)
        owners = np.repeat(least[chosen], np.diff(firsts))
        shared = self.common_suffixes(common, parts)
        starts = {bucket: firsts[start] for bucket, start, _ in self._cut(chosen)}
        cells = {cell: start for cell, start, _ in shared.cuts()}
        late = replies.filter(pa.array(second))
        for bucket, packed in zip(late.column("bucket").to_pylist(), late.column("packed").to_pylist(), strict=True):
            at, other = unpack(packed, ("u4", "i8"))
            told, begin = (shared.least, cells[bucket]) if bucket in cells else (owners, starts[bucket])
            at = at.astype(np.int64) + begin
            told[at] = np.minimum(told[at], other)
        own_first = np.zeros(len(open_), np.int64)
        own_first[chosen] = firsts[:-1]
        chosen, firsts = self.suffixes(common)
        own_first[chosen] = firsts[:-1] + len(owners)
        owners = np.concatenate([owners, shared.least[shared.entry]])
        found = self.parse
        begins = np.searchsorted(found.texts, np.arange(len(self.texts) + 1))
        for number, text in enumerate(self.texts):
            own = self.ids[number]
            places = np.arange(begins[number], begins[number + 1])
            entry = self.words.entry[places]
            gone = least[entry] < own
            edge = np.zeros(len(text) + 2, np.int64)
            np.add.at(edge, found.firsts[places[gone]], 1)
            np.add.at(edge, found.lasts[places[gone]] + self.length, -1)
            some = places[~gone & open_[entry]]
            if len(some):
                counts = found.lasts[some] - found.firsts[some] + 1
                at = arrays.ranges(found.firsts[some], counts)
                at = at[owners[arrays.ranges(own_first[entry[~gone & open_[entry]]], counts)] < own]
                np.add.at(edge, at, 1)
                np.add.at(edge, at + self.length, -1)
            covered = np.zeros(len(text) + 2, np.int8)
            covered[1:] = np.cumsum(edge[:-1]) > 0
            turns = np.diff(covered)
            yield int(own), text, np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)


def _rows(block: int, rows: list[tuple[int, bytes]]) -> pa.Table:
    return pa.table(
        {
            "bucket": pa.array([bucket for bucket, _ in rows], pa.int64()),
            "block": pa.array([block] * len(rows), pa.int32()),
            "packed": pa.array([packed for _, packed in rows], pa.binary()),
        }
    )


def _gathered(table: pa.Table, kinds: tuple[str, ...]) -> tuple[list[int], np.ndarray, list[np.ndarray]]:
    """Blocks, where each one's entries start, and the columns of all entries of a bucket."""
    parts = [unpack(packed, kinds) for packed in table.column("packed").to_pylist()]
    begins = np.cumsum([0, *(len(part[0]) for part in parts)])
    columns = [np.concatenate(column) for column in zip(*parts, strict=True)]
    columns[0] = np.concatenate([np.cumsum(part[0], dtype=part[0].dtype) for part in parts])
    return table.column("block").to_pylist(), begins, columns


def _answers(bucket: int, blocks: list[int], begins: np.ndarray, worth: np.ndarray, *columns: np.ndarray) -> pa.Table:
    """One row per block with what is worth telling it: the entry and what to know of it."""
    rows = []
    for number, block in enumerate(blocks):
        some = np.flatnonzero(worth[begins[number] : begins[number + 1]])
        if len(some):
            at = some + begins[number]
            rows.append((block, pack(some.astype(np.uint32), *(column[at] for column in columns))))
    return pa.table(
        {
            "bucket": pa.array([bucket] * len(rows), pa.int64()),
            "block": pa.array([block for block, _ in rows], pa.int32()),
            "packed": pa.array([packed for _, packed in rows], pa.binary()),
        }
    )


def _hashes(text: bytes, counts: np.ndarray, length: int) -> np.ndarray:
    """The hash of each suffix of phrases that stand one after the other, by their numbers of suffixes."""
    sizes = counts + length - 1
    at = arrays.ranges(np.cumsum(sizes) - sizes, counts)
    return arrays.Hasher(np.frombuffer(text, np.uint8))(at, at + length)


def suffix_array(text: bytes, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of phrases that stand one after the other, by their numbers of suffixes, in the order
    of their first ``length`` bytes; and which of them differ from the one before in these.
    """
    sizes = counts + length - 1
    at = arrays.ranges(np.cumsum(sizes) - sizes, counts)
    if not len(at):
        return at, np.zeros(0, bool)
    windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text, np.uint8), length)
    first = windows[at].view(f"S{length}").ravel()
    order = np.argsort(first)
    new = np.ones(len(order), bool)
    for start in range(1, len(order), HASHED):
        some = order[start - 1 : start + HASHED]
        new[start : start + HASHED] = first[some[1:]] != first[some[:-1]]
    return order, new


def _earliest(order: np.ndarray, new: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The smallest id that comes with each of some things, which are equal in an order until a new one."""
    earliest = np.empty(len(order), np.int64)
    earliest[order] = np.minimum.reduceat(own[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    return earliest


def _merge_phrases(most: int):
    """Merge the dictionaries of all blocks, in order of trigger and phrase.

    A block learns of an earlier document with its phrase, of phrases that share a trigger with
    another phrase of another document, and whether that trigger is common, to a block or with
    more than ``most`` phrases that blocks list, and how many parts its suffixes have.
    """

    def merge_phrases(key: tuple, table: pa.Table) -> pa.Table:
        return _merged(key, table, most)

    return merge_phrases


def _merged(key: tuple, table: pa.Table, most: int) -> pa.Table:
    blocks, begins, (triggers, phrases, least, several) = _gathered(table, ("u4", "u8", "i8", "u1"))
    order = np.lexsort((phrases, triggers))
    t, p, own, more = triggers[order], phrases[order], least[order], several[order]
    new_t = np.ones(len(order), bool)
    new_t[1:] = t[1:] != t[:-1]
    new_p = new_t.copy()
    new_p[1:] |= p[1:] != p[:-1]
    t_starts, p_starts = np.flatnonzero(new_t), np.flatnonzero(new_p)
    t_of, p_of = np.cumsum(new_t) - 1, np.cumsum(new_p) - 1
    earliest = np.minimum.reduceat(own, p_starts)[p_of]
    first, last = np.minimum.reduceat(own, t_starts), np.maximum.reduceat(own, t_starts)
    variants = np.bincount(t_of[p_starts], minlength=len(t_starts))
    known = np.bitwise_or.reduceat(more, t_starts)
    common = (np.bincount(t_of) > most) | (known & COMMON).astype(bool)
    open_ = ((variants > 1) | common) & ((first != last) | (known & SEVERAL).astype(bool))
    phrases_of = np.bincount(t_of, np.exp2(more >> BITS)).astype(np.int64)
    parts = np.ceil(np.log2(np.maximum(1, phrases_of / PART))).astype(np.int64)
    flags = np.where(open_, SEVERAL, 0) + np.where(common & open_, COMMON + (parts << BITS), 0)
    open_, flags = open_[t_of], flags[t_of]
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    earliest, open_, flags = earliest[back], open_[back], flags[back]
    worth = (earliest < least) | open_
    return _answers(key[0].as_py(), blocks, begins, worth, earliest, flags.astype(np.uint8))


def _merge_suffixes(length: int, bits: int):
    """The suffix array of all blocks' open phrases of a bucket, by the first bytes of the suffixes.

    Phrases that share these share their trigger, so they are in one bucket, those of a common trigger
    by hash in a part of it. A block learns, by number of the suffix, of earlier documents with it.
    """

    def common(key: tuple, table: pa.Table) -> pa.Table:
        hashes, least = [], []
        for packed in table.column("packed").to_pylist():
            keys, rest = unpack_sorted(packed)
            hashes.append(keys)
            least += unpack(rest, ("i8",))
        own, begins = np.concatenate(least), np.cumsum([0, *map(len, hashes)])
        keys = np.concatenate(hashes)
        order = np.argsort(keys, kind="stable")
        new = np.ones(len(keys), bool)
        new[1:] = keys[order[1:]] != keys[order[:-1]]
        earliest = _earliest(order, new, own)
        return _answers(key[0].as_py(), table.column("block").to_pylist(), begins, earliest < own, earliest)

    def merge_suffixes(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() >= 1 << bits:
            return common(key, table)
        least, counts, texts, begins = [], [], [], [0]
        for packed in table.column("packed").to_pylist():
            own, n = unpack(packed, ("i8", "u4"))
            n = n.astype(np.int64)
            texts.append(packed[4 + 12 * len(n) :])
            least.append(np.repeat(own, n))
            counts.append(n)
            begins.append(begins[-1] + int(n.sum()))
        count, own = np.concatenate(counts), np.concatenate(least)
        earliest = _earliest(*suffix_array(b"".join(texts), count, length), own)
        return _answers(key[0].as_py(), table.column("block").to_pylist(), np.array(begins), earliest < own, earliest)

    return merge_suffixes


COLUMNS = {
    "starts": pa.list_(pa.int64()), "ends": pa.list_(pa.int64()), "kept": pa.binary(), "kept_text": pa.string(),
    "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(),
}
SQL_TYPES = {
    pa.list_(pa.int64()): ArrayType(LongType()), pa.binary(): BinaryType(),
    pa.int64(): LongType(), pa.string(): StringType(),
}


def repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    trigger: int = TRIGGER, columns: tuple[str, ...] = tuple(COLUMNS), carry: tuple[str, ...] | None = None,
    listed: int = LISTED, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """What each document repeats of documents with smaller ids, as ``id`` and ``columns``.

    Texts are UTF-8 bytes. A byte goes if a string of ``length`` bytes over it also starts in a
    document with a smaller id; matches lie within documents and are judged on the texts as they
    are. ``starts`` and ``ends`` are the maximal runs that go, ``kept`` the other bytes joined, and
    ``kept_text`` these as text, without what is left of a character cut apart. With ``carry``, ``row`` has these columns of ``docs``.

    Null texts are empty. Null ids come after all others and stand for one document, as do rows
    with equal ids: these don't remove each other's text. There is one row per row of ``docs``.
    ``id`` is null where it was.

    Phrases are known by 96 bits of hashes, with that of their trigger, and suffixes of common triggers
    by 64; equal hashes are taken for equal text. Other suffixes are compared by their bytes. A trigger with more than ``listed`` phrases in a block is a common one; results are the
    same with any number.
    """
    plan: Layout = layout(docs, text_col, block_bytes, bucket_bytes)
    rows = blocked(docs, plan, id_col, text_col, carry)
    bits = plan.bits

    def phrases(key: tuple, table: pa.Table) -> pa.Table:
        return Block(table, length, trigger, bits, listed).packed_phrases(key[0].as_py())

    def suffixes(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        return Block(table, length, trigger, bits, listed).packed_suffixes(key[0].as_py(), replies)

    def result(key: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(table, length, trigger, bits, listed)
        out: dict[str, list] = {name: [] for name in ("id", *columns)}
        for own, text, starts, ends in block.removed(replies):
            kept = _kept(text, starts, ends)
            values = {
                "id": None if own == NO_ID else own,
                "starts": starts, "ends": ends, "kept": kept, "n_bytes": len(text),
                "kept_text": kept.decode("utf-8", "ignore") if "kept_text" in columns else None,
                "n_removed": int((ends - starts).sum()), "n_spans": len(starts),
                "kept_sha256": hashlib.sha256(kept).hexdigest() if "kept_sha256" in columns else None,
            }
            for name in out:
                out[name].append(values[name])
        found = {name: pa.array(values, COLUMNS.get(name, pa.int64())) for name, values in out.items()}
        if carry is not None:
            found["row"] = table.column("row").take(pa.array(block.order, pa.int64()))
        return pa.table(found)

    schema = StructType([StructField("id", LongType()), *(StructField(c, SQL_TYPES[COLUMNS[c]]) for c in columns)])
    if carry is not None:
        schema = schema.add(rows.schema["row"])
    first = (
        rows.groupBy("block").applyInArrow(phrases, PACKED)
        .groupBy("bucket").applyInArrow(_merge_phrases(listed * LISTED_BY_ALL), PACKED)
    )
    second = (
        rows.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(suffixes, PACKED)
        .groupBy("bucket").applyInArrow(_merge_suffixes(length, bits), PACKED)
    )
    replies = first.withColumn("suffixes", F.lit(False)).unionByName(second.withColumn("suffixes", F.lit(True)))
    found = rows.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(result, schema)
    return found.withColumnRenamed("id", id_col)


def without_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the bytes that ``repeats`` keeps as texts, all other columns as they were.

    What is left of a character cut apart is dropped from the text. Texts are never null.
    """
    others = tuple(c for c in docs.columns if c != text_col)
    found = repeats(docs, id_col=id_col, text_col=text_col, columns=("kept_text",), carry=others, **options)
    return found.select(*[F.col("kept_text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def _kept(text: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    if not len(starts):
        return text
    parts, at = [], 0
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        parts.append(text[at:start])
        at = end
    return b"".join([*parts, text[at:]])
