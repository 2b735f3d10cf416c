"""Coordinates as they appear in a request URL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Below this, the text has at most 18 digits, as a compact decimal holds.
MAGNITUDE = 1e14


def round_coordinate(coordinate: Column) -> Column:
    """Round a 32-bit coordinate to four decimals, exact ties to the even digit.

    The product of a 32-bit float and 10,000 is exact in a double, so ``rint`` sees the exact
    value: 0.03125 becomes 0.0312. ``bround`` gives the same at a multiple of the cost.
    """
    return F.rint(coordinate.cast("double") * 10000) / 10000


def coordinate_text(coordinate: Column) -> Column:
    """Shortest decimal text of the rounded coordinate: ``33.0``, ``0.0001``, ``-117.69``.

    The detour over a decimal keeps small values out of scientific notation. Null, NaN,
    infinities and magnitudes no coordinate can have give null.
    """
    padded = round_coordinate(coordinate).try_cast("decimal(18,4)").cast("string")
    split = F.length(padded) - 3
    first_decimal, others = F.left(padded, split), F.right(padded, F.lit(3))
    return F.concat(first_decimal, F.rtrim(others, F.lit("0")))


def is_coordinate(value: Column) -> Column:
    """Whether ``coordinate_text`` has a text for the value; null for null."""
    return F.abs(value) < MAGNITUDE
