"""Station file to station tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from hazeline.operators import filter_states
from hazeline.operators.stations import WEST_COAST
from hazeline.plans.rejects import write_with_rejects
from hazeline.sinks import write_table
from hazeline.sources import scan_stations, scan_table


def load_stations(
    spark: SparkSession,
    source: str,
    target: str,
    rejects: str,
    states: Sequence[str] = WEST_COAST,
    encoding: str = "UTF-8",
) -> int:
    """Scan the station file and store the stations of the given states.

    Malformed lines of any state are stored as far as they can be read, like others, and listed
    in ``rejects`` with their text; returns their number.
    """
    rows = scan_stations(spark, source, encoding, malformed=True)
    return write_with_rejects(rows, target, rejects, lambda usable: filter_states(usable, states))


def load_stations_two_step(
    spark: SparkSession,
    source: str,
    all_target: str,
    target: str,
    rejects: str,
    states: Sequence[str] = WEST_COAST,
    encoding: str = "UTF-8",
) -> int:
    """Store all stations first, then the selected ones from that table; rejects as above."""
    found = write_with_rejects(
        scan_stations(spark, source, encoding, malformed=True), all_target, rejects
    )
    write_table(filter_states(scan_table(spark, all_target), states), target)
    return found
