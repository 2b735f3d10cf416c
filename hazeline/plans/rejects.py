"""Storing usable rows and rejects together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hazeline.functions import any_value
from hazeline.operators import split_rejects
from hazeline.schemas import CORRUPT
from hazeline.sinks import write_table
from hazeline.sources import scan_table
from hazeline.workspace import scratch


class AllRejected(RuntimeError):
    """There was input and none of it could be used; tables of earlier runs are untouched."""


def write_with_rejects(
    rows: DataFrame,
    target: str,
    rejects: str,
    choose: Callable[[DataFrame], DataFrame] = lambda usable: usable,
) -> int:
    """Store the usable rows that ``choose`` keeps, and all rejects; returns their number.

    The input is read and parsed once, into an intermediate table in the shared folder, which is deleted
    in the end; rows and rejects are both taken from that. If all of it was rejected, this raises ``AllRejected`` and
    replaces nothing.
    """
    declared = [name for name in rows.columns if name != CORRUPT]
    damaged = F.col(CORRUPT).isNotNull()
    seen = Observation()
    counted = rows.observe(
        seen,
        F.count(CORRUPT).alias("rejects"),
        F.count(F.when(~damaged | any_value(declared), 1)).alias("usable"),
    )
    with scratch(rows.sparkSession) as fresh:
        parsed = fresh("parsed")
        write_table(counted, parsed)
        found = seen.get
        if found["rejects"] and not found["usable"]:
            raise AllRejected(f"all {found['rejects']} rows were rejected, so {target} stays as it is")
        usable, damaged_rows = split_rejects(scan_table(rows.sparkSession, parsed))
        write_table(choose(usable), target)
        write_table(damaged_rows, rejects)
    return found["rejects"]
