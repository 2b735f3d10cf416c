"""All jobs in order, and which of their results count."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from hazeline import files
from hazeline.operators.stations import WEST_COAST
from hazeline.plans.extract import Calls, extract
from hazeline.plans.stations import load_stations
from hazeline.plans.transform import transform_forecasts, transform_observations
from hazeline.sinks import write_table
from hazeline.sources import land_raw, scan_table
from hazeline.sources.web import Transport

MANIFEST = "run bigint, name string, path string, calls bigint, failed bigint, rejected bigint"


class NoRun(LookupError):
    """No run under this folder was committed."""


@dataclass(frozen=True)
class Paths:
    """Locations under one folder on any Hadoop file system: of all files and tables of a run, or of all runs."""

    root: str

    def _under(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def of_run(self, number: int) -> Paths:
        return Paths(self._under(f"runs/{number:08d}"))

    @property
    def manifest(self) -> str:
        return self._under("manifest.parquet")

    @property
    def raw_stations(self) -> str:
        return self._under("stations/raw")

    @property
    def stations(self) -> str:
        return self._under("stations/selected.parquet")

    def responses(self, kind: str) -> str:
        return self._under(f"{kind}/responses.parquet")

    def entries(self, kind: str) -> str:
        return self._under(f"{kind}/entries.json")

    def table(self, kind: str) -> str:
        return self._under(f"{kind}/table.parquet")

    def rejects(self, kind: str) -> str:
        return self._under(f"{kind}/rejects")


def run_all(
    spark: SparkSession,
    source: str,
    paths: Paths,
    transport: Transport,
    date: str | datetime.date,
    parallelism: int,
    *,
    most_failed: float,
    states: Sequence[str] = WEST_COAST,
    encoding: str = "UTF-8",
    keep: int = 2,
    **options,
) -> dict[str, Calls]:
    """Land and filter the stations, then fetch and store observations, then forecasts, and commit all.

    A run has a folder of its own, ``paths.of_run(number)``, and counts when a last step adds its tables to the
    manifest: until then ``committed`` gives those of the run before, of all kinds. An exception in any
    step ends the run; so does a kind of which all calls failed, or more than the share ``most_failed``.
    The next call then works in the same folder: it makes only the calls that have no settled reply yet, and
    replaces all other results. Folders of committed runs are deleted but for the last ``keep``.
    ``options`` are those of ``fetch``. Returns the calls and rejects of each kind.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    number = (last_run(spark, paths) or 0) + 1
    own = paths.of_run(number)
    land_raw(spark, source, own.raw_stations)
    load_stations(
        spark, own.raw_stations, own.stations, f"{own.rejects('stations')}/lines", states, encoding
    )
    transforms = {"observation": transform_observations, "forecast": transform_forecasts}
    outcome = {}
    for kind, transform in transforms.items():
        calls = extract(
            spark,
            own.stations,
            own.responses(kind),
            own.entries(kind),
            own.rejects(kind),
            transport,
            kind,
            date,
            parallelism,
            most_failed=most_failed,
            **{"resume": True} | options,
        )
        rejected = transform(
            spark, own.entries(kind), own.table(kind), f"{own.rejects(kind)}/entries"
        )
        outcome[kind] = replace(calls, entries_rejected=rejected)
    commit(spark, paths, number, outcome)
    for old in range(number - keep, 0, -1):
        folder = paths.of_run(old).root
        if not files.exists(spark, folder):
            break
        files.delete(spark, folder)
    return outcome


def commit(spark: SparkSession, paths: Paths, number: int, outcome: dict[str, Calls]) -> None:
    """Add the tables of a run to the manifest: one new file, so that all of them count or none."""
    own = paths.of_run(number)
    rows = [(number, "stations", own.stations, None, None, None)]
    rows += [(number, kind, own.table(kind), c.made, c.failed, c.entries_rejected) for kind, c in outcome.items()]
    write_table(spark.createDataFrame(rows, MANIFEST).coalesce(1), paths.manifest, mode="append")


def last_run(spark: SparkSession, paths: Paths) -> int | None:
    """The number of the last committed run, if any."""
    if not files.exists(spark, paths.manifest):
        return None
    runs = spark.read.schema(MANIFEST).parquet(paths.manifest)
    return runs.agg(F.max("run").alias("run")).first().run


def committed(spark: SparkSession, paths: Paths) -> dict[str, str]:
    """Where the tables of the last committed run are, by name: ``stations, observation, forecast``."""
    number = last_run(spark, paths)
    if number is None:
        raise NoRun(f"no run under {paths.root} was committed")
    rows = scan_table(spark, paths.manifest).filter(F.col("run") == number)
    return {row.name: row.path for row in rows.select("name", "path").collect()}
