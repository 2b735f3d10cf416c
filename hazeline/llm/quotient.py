"""Counting quotient filters over 64-bit fingerprints, which merge without loss.

A fingerprint is split into a range (its leading bits), a quotient and a remainder. The filter of
a range keeps the remainders in slots, in runs: all remainders of a quotient next to each other,
sorted, at the slot of their quotient or behind the run before. Two bits tell the runs apart:
*occupied*, whether a quotient has a run, and *run end*, whether a slot is the last of its run. A
remainder that came more than once has one slot and a count. As every bit of the fingerprint is
either the place of a run or in a slot, a filter gives back exactly the fingerprints put in.
"""

from __future__ import annotations

import struct

import numpy as np

U = np.uint64
#: Slots per fingerprint, as a power of two, are at least this many.
ROOM = 1.25
_HEADER = struct.Struct("<BBqqq")


def counted(fingerprints: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints in ascending order, and how often each came."""
    if counts is None:
        counts = np.ones(len(fingerprints), np.int64)
    order = np.argsort(fingerprints, kind="stable")
    ordered, counts = fingerprints[order], counts[order]
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    at = np.flatnonzero(first)
    return ordered[at], np.add.reduceat(counts, at) if len(at) else counts


def slots(quotients: np.ndarray) -> np.ndarray:
    """The slot of each entry, given the ascending quotients: its own, or the one behind the last."""
    steps = np.arange(len(quotients))
    return np.maximum.accumulate(quotients.astype(np.int64) - steps) + steps


def pack(fingerprints: np.ndarray, counts: np.ndarray, range_bits: int) -> bytes:
    """The filter of distinct, ascending fingerprints that share their first ``range_bits`` bits."""
    n = len(fingerprints)
    bits = min(64 - range_bits, max(1, int(np.ceil(np.log2(max(1, n) * ROOM)))))
    rest = 64 - range_bits - bits
    below = fingerprints & U((1 << (64 - range_bits)) - 1)
    quotients = below >> U(rest)
    remainders = below & U((1 << rest) - 1)
    place = slots(quotients)
    size = int(place[-1]) + 1 if n else 0
    occupied = np.zeros(1 << bits, bool)
    occupied[quotients.astype(np.int64)] = True
    used, ends, many = np.zeros(size, bool), np.zeros(size, bool), np.zeros(size, bool)
    used[place] = True
    last = np.ones(n, bool)
    last[:-1] = quotients[1:] != quotients[:-1]
    ends[place[last]] = True
    many[place[counts > 1]] = True
    width = (rest + 7) // 8
    planes = remainders.astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
    bitmaps = [np.packbits(bitmap).tobytes() for bitmap in (occupied, used, ends, many)]
    more = counts[counts > 1].astype("<i8").tobytes()
    header = _HEADER.pack(bits, width, n, size, len(more))
    return b"".join([header, *bitmaps, planes.tobytes(), more])


def unpack(packed: bytes, range_bits: int, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of the filter of range ``number``, in ascending order, and their counts."""
    bits, width, n, size, more = _HEADER.unpack_from(packed)
    at = _HEADER.size
    bitmaps = []
    for length in (1 << bits, size, size, size):
        used = (length + 7) // 8
        bitmaps.append(np.unpackbits(np.frombuffer(packed, np.uint8, used, at), count=length).astype(bool))
        at += used
    occupied, used, ends, many = bitmaps
    planes = np.zeros((n, 8), np.uint8)
    planes[:, :width] = np.frombuffer(packed, np.uint8, n * width, at).reshape(n, width)
    remainders = planes.view("<u8").ravel().astype(U)
    # The k-th run is the one of the k-th occupied quotient.
    closed = ends[used]
    run = np.cumsum(closed) - closed
    quotients = np.flatnonzero(occupied)[run].astype(U)
    rest = 64 - range_bits - bits
    high = U(number) << U(64 - range_bits) if range_bits else U(0)
    counts = np.ones(n, np.int64)
    counts[many[used]] = np.frombuffer(packed, "<i8", more // 8, at + n * width)
    return high | (quotients << U(rest)) | remainders, counts


def merge(filters: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all filters, in ascending order, with their counts added up."""
    if not filters:
        return np.zeros(0, U), np.zeros(0, np.int64)
    return counted(*(np.concatenate(part) for part in zip(*filters)))
