"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches."""

from __future__ import annotations

import base64
import codecs
import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from hazeline.llm import arrays

#: Bytes of text, and ids, that one round holds as Python objects; one longer text is a round.
ROUND_BYTES = 1_000_000
ROUND_IDS = 250_000
#: Pieces that one call of the library encodes, and the character that stands between them.
CALL = 5000
BETWEEN = "\ue000"
#: Distinct pieces whose ids a worker remembers.
REMEMBERED = 250_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others for the code points from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {byte: chr(byte) for byte in printable}
    for byte in range(256):
        if byte not in table:
            table[byte] = chr(256 + len(table) - len(printable))
    return [table[byte] for byte in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file (base64 token and rank per line), on the driver."""
    pairs = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def vocabulary(ranks: dict[bytes, int], pattern: str) -> str:
    """A rank file and its split pattern as the JSON that workers build their tokenizer from.

    A rank file knows no merges, only that the adjacent pair whose concatenation has the lowest
    rank merges first. So each way to cut a token in two tokens is a merge, in order of rank.
    """
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    characters = byte_characters()

    def written(token: bytes) -> str:
        return "".join([characters[byte] for byte in token])

    merges = [
        (written(token[:cut]), written(token[cut:]))
        for token in sorted(ranks, key=ranks.__getitem__)
        for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks
    ]
    tokenizer = Tokenizer(
        models.BPE(
            vocab={written(token): rank for token, rank in ranks.items()}, merges=merges, ignore_merges=True
        )
    )
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return json.dumps({"tokenizer": tokenizer.to_str(), "pattern": _explicit(pattern)})


@lru_cache(maxsize=None)
def _ranges(name: str) -> str:
    """The characters of a class, as ranges of a pattern; looked at in parts to save memory."""
    from tokenizers import Regex, pre_tokenizers

    left = pre_tokenizers.Split(Regex(name), behavior="removed")
    ranges: list[list[int]] = []
    for start in range(0, 0x110000, 0x1000):
        part = "".join([chr(c) for c in range(start, start + 0x1000) if not 0xD800 <= c < 0xE000])
        outside = {character for run, _ in left.pre_tokenize_str(part) for character in run}
        for code in map(ord, part):
            if chr(code) not in outside:
                if ranges and ranges[-1][1] == code - 1:
                    ranges[-1][1] = code
                else:
                    ranges.append([code, code])
    return "".join(f"\\U{first:08x}-\\U{last:08x}" for first, last in ranges)


def _explicit(pattern: str) -> str:
    """The pattern with its character classes spelled out as the tokenizers library knows them,
    so that no other library's Unicode version decides where a piece ends."""
    spelled = {name: _ranges(name) for name in (r"\p{L}", r"\p{N}", r"\s")}
    outside = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{''.join(spelled[c] for c in (r'\s', r'\p{L}', r'\p{N}'))}]")
    outside = outside.replace(r"\S", f"[^{spelled[r'\s']}]")
    for name, ranges in spelled.items():
        outside = outside.replace(name, f"[{ranges}]")
    return outside


class Codec:
    """One tokenizer of one worker."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer, pre_tokenizers

        parts = json.loads(vocabulary)
        self.written = vocabulary
        self.pieces = Tokenizer.from_str(parts["tokenizer"])
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(BETWEEN, behavior="isolated"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        self.between = self.pieces.encode(BETWEEN, add_special_tokens=False).ids
        self.split = re.compile(parts["pattern"]).findall
        self.known: dict[str, bytes] = {}
        value = {character: byte for byte, character in enumerate(byte_characters())}
        names = self.pieces.get_vocab()
        self.token_bytes = [b""] * (max(names.values()) + 1)
        for name, number in names.items():
            self.token_bytes[number] = bytes([value[character] for character in name])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers.

        The library encodes each distinct piece once; texts join the pieces' ids.
        """
        split = [self.split(text) for text in texts]
        pieces = set(chain.from_iterable(split))
        fresh = list(pieces.difference(self.known))
        if len(self.known) > REMEMBERED:  # what is frequent is in this round, too
            self.known = {piece: self.known[piece] for piece in pieces.intersection(self.known)}
        for start in range(0, len(fresh), CALL):
            some = fresh[start : start + CALL]
            self.known.update(zip(some, self._ids(some), strict=True))
        ids = self.known.__getitem__
        return [b"".join(map(ids, pieces)) for pieces in split]

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, encoded by itself.

        The pieces make one text, with a character in between that is cut off on its own; its ids
        say where they end. A piece that has that character can't be among them.
        """
        if any(BETWEEN in piece for piece in pieces):
            if len(pieces) > 1:
                return [ids for piece in pieces for ids in self._ids([piece])]
            whole = _whole(self.written, split=False)
            return [np.array(whole.encode(pieces[0], add_special_tokens=False).ids, "<u4").tobytes()]
        ids = np.array(self.pieces.encode_batch_fast([BETWEEN.join(pieces)], add_special_tokens=False)[0].ids, "<u4")
        n = len(self.between)
        found = np.ones(max(0, len(ids) - n + 1), bool)
        for at, number in enumerate(self.between):
            found &= ids[at : at + len(found)] == number
        ends = np.flatnonzero(found)
        packed = ids.tobytes()
        starts, stops = np.append(0, ends + n) * 4, np.append(ends, len(ids)) * 4
        return [packed[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]

    def spans(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids and, for each, the characters of the text it covers.

        Tokens that share a character all span the whole of it.
        """
        encoding = _whole(self.written).encode(text, add_special_tokens=False)
        return encoding.ids, encoding.offsets

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def decoded_sha256(self, packed: bytes) -> str:
        """The hash of what little-endian 32-bit ids decode to."""
        found = hashlib.sha256()
        ids = np.frombuffer(packed, "<u4")
        for start in range(0, len(ids), ROUND_IDS):
            found.update(self.decode(ids[start : start + ROUND_IDS].tolist()))
        return found.hexdigest()

    def strings(self, ids: list[int]) -> list[str]:
        """What each id adds to the text read so far. A character split over several ids comes
        with the one that completes it; bytes that never form one come as U+FFFD."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        out = [decoder.decode(self.token_bytes[number]) for number in ids]
        if out:
            out[-1] += decoder.decode(b"", final=True)
        return out


@lru_cache(maxsize=2)
def _whole(vocabulary: str, split: bool = True):
    """The tokenizer for whole texts, or for whole pieces, which are not split again."""
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_str(json.loads(vocabulary)["tokenizer"])
    if not split:
        tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return tokenizer


@lru_cache(maxsize=1)
def codec(vocabulary: str) -> Codec:
    return Codec(vocabulary)


def _kept(schema: StructType, keep: Iterable[str] | None, added: set[str]) -> list[StructField]:
    return [f for f in schema.fields if f.name not in added and (keep is None or f.name in keep)]


def _joined(batch: pa.RecordBatch, keep: list[str], columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*map(batch.column, keep), *columns.values()], [*keep, *columns])


def _lists(parts: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(part) // 4 for part in parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(parts), "<i4")))


def encode(
    df: DataFrame,
    vocabulary: str,
    *,
    text_col: str = "text",
    keep: Iterable[str] | None = None,
    spans: bool = False,
    round_trip: bool = False,
) -> DataFrame:
    """Add ``ids`` (array of int), ``n_tokens`` and ``ids_sha256`` (of the ids as little-endian
    unsigned 32-bit integers) to the rows of ``df``, or to its columns in ``keep``.

    ``spans`` adds ``starts`` and ``ends``, the characters each id covers; ``round_trip`` decodes the
    ids again, in the same task, and adds ``decoded_sha256`` of the bytes. Null texts count as
    empty and have no ids. Texts are encoded whole, whatever their length; every row is a task's
    own, so repeated rows and ties need no rule. Columns of ``df`` named like those added are
    replaced.
    """
    added = [
        StructField("ids", ArrayType(IntegerType(), False)),
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
    ]
    if spans:
        added += [StructField(name, ArrayType(IntegerType(), False)) for name in ("starts", "ends")]
    if round_trip:
        added.append(StructField("decoded_sha256", StringType()))
    fields = _kept(df.schema, keep, {f.name for f in added})
    names = [f.name for f in fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(vocabulary)
        for batch in batches:
            _, offsets = arrays.texts(batch.column(text_col))
            for start, end in arrays.steps(offsets, ROUND_BYTES):
                some = [text or "" for text in batch.column(text_col).slice(start, end - start).to_pylist()]
                more = {}
                if spans:
                    found = [coder.spans(text) for text in some]
                    parts = [np.array(ids, "<u4").tobytes() for ids, _ in found]
                    for at, name in enumerate(("starts", "ends")):
                        more[name] = _lists(
                            [np.array([span[at] for span in s], "<i4").tobytes() for _, s in found]
                        )
                else:
                    parts = coder.encode(some)
                if round_trip:
                    more["decoded_sha256"] = pa.array([coder.decoded_sha256(part) for part in parts])
                yield _joined(
                    batch.slice(start, end - start),
                    names,
                    {
                        "ids": _lists(parts),
                        "n_tokens": pa.array([len(part) // 4 for part in parts], pa.int64()),
                        "ids_sha256": pa.array([hashlib.sha256(part).hexdigest() for part in parts]),
                    }
                    | more,
                )

    wanted = df.select(*{text_col: None, **dict.fromkeys(names)})
    return wanted.mapInArrow(run, StructType([*fields, *added]))


def decode(
    df: DataFrame,
    vocabulary: str,
    *,
    ids_col: str = "ids",
    keep: Iterable[str] | None = None,
    strings: bool = False,
) -> DataFrame:
    """Add ``decoded``, the bytes that the ids of each row stand for.

    ``strings`` adds ``pieces``, what each id adds to the text; a character that several ids
    share comes with the last of them. Null ids decode to no bytes; an unknown id is an error.
    """
    added = [StructField("decoded", BinaryType())]
    if strings:
        added.append(StructField("pieces", ArrayType(StringType(), False)))
    fields = _kept(df.schema, keep, {f.name for f in added})
    names = [f.name for f in fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(vocabulary)
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column(ids_col)), 0)
            ends = np.append(0, np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64))
            for start, end in arrays.steps(ends, ROUND_IDS):
                lists = batch.column(ids_col).slice(start, end - start).to_pylist()
                more = {"decoded": pa.array([coder.decode(ids or ()) for ids in lists], pa.binary())}
                if strings:
                    more["pieces"] = pa.array([coder.strings(ids or ()) for ids in lists], pa.list_(pa.string()))
                yield _joined(batch.slice(start, end - start), names, more)

    wanted = df.select(*{ids_col: None, **dict.fromkeys(names)})
    return wanted.mapInArrow(run, StructType([*fields, *added]))
