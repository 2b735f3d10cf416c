"""Helpers for undecoded text lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character sets in which a line break is a single byte, so that files split on it.
LINE_ENCODINGS = ("UTF-8", "ISO-8859-1", "US-ASCII")


def decode_line(line: Column, encoding: str) -> Column:
    """Decode the bytes of a line read by the text source, which passes them on unchanged."""
    if encoding not in LINE_ENCODINGS:
        raise ValueError(f"encoding must be one of {LINE_ENCODINGS}, not {encoding!r}")
    return F.decode(line.cast("binary"), encoding)


def split_fields(line: Column) -> Column:
    """Split at every pipe; empty fields, also trailing ones, stay as empty strings."""
    return F.split(line, "[|]")
