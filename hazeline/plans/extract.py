"""Station table to API responses to entries."""

from __future__ import annotations

import datetime
import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazeline import files
from hazeline.operators import (
    build_requests,
    entries_or_reasons,
    parse_entries,
    project_locations,
    repeat_entries,
    split_locations,
    split_rejects,
)
from hazeline.sinks import write_entries, write_table
from hazeline.sources import fetch_responses, scan_table
from hazeline.sources.web import Transport
from hazeline.workspace import scratch


#: Calls whose replies are stored by one job. A run that ends early has to make no more than these again.
SHARE = 50_000


class CallsFailed(RuntimeError):
    """Too many calls failed; entries and tables of earlier runs are untouched."""


@dataclass(frozen=True)
class Calls:
    """How many distinct calls a job needed, and how many gave no array of entries; rejected entries
    count where a job types them. Calls that an earlier try had settled are among them."""

    made: int
    failed: int
    entries_rejected: int = 0


def settled() -> Column:
    """Whether another call would give the same: a reply, or an error that is the caller's."""
    status = F.col("status")
    final = (status >= 200) & (status < 300) | (status >= 400) & (status < 500)
    return F.coalesce(final & ~status.isin(408, 429), F.lit(False))


def fetch(
    spark: SparkSession,
    stations: str,
    responses: str,
    rejects: str,
    transport: Transport,
    endpoint: str,
    date: str | datetime.date,
    parallelism: int,
    distance: int = 1,
    concurrency: int = 1,
    rate: float | None = None,
    share: int = SHARE,
    resume: bool = False,
) -> DataFrame:
    """Call the API for every station and store the replies, then return them as a table.

    The replies are written before anything else uses them, so that no retry or second use
    calls the API again. They are written in shares of about ``share`` calls, one after the other. With
    ``resume``, replies that an earlier try left in ``responses`` and that are ``settled`` count, and only the
    other calls are made; without, that table is replaced by the first share. Stations without usable
    coordinates go to ``rejects/coordinates``.
    """
    options = {"distance": distance, "concurrency": concurrency, "rate": rate, "share": share, "resume": resume}
    _fetch(spark, stations, responses, rejects, transport, endpoint, date, parallelism, **options)
    return scan_table(spark, responses)


def _fetch(
    spark: SparkSession,
    stations: str,
    responses: str,
    rejects: str,
    transport: Transport,
    endpoint: str,
    date: str | datetime.date,
    parallelism: int,
    *,
    distance: int = 1,
    concurrency: int = 1,
    rate: float | None = None,
    share: int = SHARE,
    resume: bool = False,
) -> int:
    """``fetch``; returns the number of distinct calls, counted while they are written down."""
    if share < 1:
        raise ValueError("share must be at least 1")
    locations, unusable = split_locations(project_locations(scan_table(spark, stations)))
    write_table(unusable, f"{rejects}/coordinates")
    requests = build_requests(locations, endpoint, date, distance)
    with scratch(spark) as fresh:
        needed, made = _counted(requests.groupBy("url").agg(F.count(F.lit(1)).alias("n_requests")), fresh("calls"))
        left, n_left, mode = needed, made, "overwrite"
        if resume:
            files.restore(spark, responses)
        if resume and files.exists(spark, responses):
            # The stations may have changed since: keep what is still needed, with its present number.
            kept = scan_table(spark, responses).filter(settled()).drop("n_requests").dropDuplicates(["url"])
            kept = needed.join(kept, "url").select("url", "n_requests", "status", "body", "error")
            write_table(kept, responses)
            left = needed.join(scan_table(spark, responses).select("url"), "url", "left_anti")
            left, n_left = _counted(left, fresh("left"))
            mode = "append"
        # A first share is written even if there is nothing to call, for the table to be there.
        shares = max(1, math.ceil(n_left / share))
        for number in range(shares):
            part = left.filter(F.pmod(F.xxhash64("url"), F.lit(shares)) == number)
            write_table(fetch_responses(part, transport, parallelism, concurrency, rate), responses, mode=mode)
            mode = "append"
    return made


def _counted(calls: DataFrame, path: str) -> tuple[DataFrame, int]:
    """The calls, written down, and their number."""
    seen = Observation()
    write_table(calls.observe(seen, F.count(F.lit(1)).alias("calls")), path)
    return scan_table(calls.sparkSession, path), seen.get["calls"]


def _opened(
    replies: DataFrame, made: int, rejects: str, schema: StructType | None, most_failed: float, path: str
) -> tuple[DataFrame, Calls]:
    """Entries of the replies, read and parsed once into an intermediate table, and the counts.

    Replies without entries, and what is left of arrays that were cut off, go to ``rejects/responses``.
    """
    spark, seen = replies.sparkSession, Observation()
    failed = F.col("reason").isNotNull()
    rows = entries_or_reasons(replies).observe(seen, F.count(F.when(failed, 1)).alias("failed"))
    if schema is not None:
        rows = parse_entries(rows, schema, ("url", "n_requests", "status", "reason"))
    write_table(rows, path)
    calls = Calls(made, seen.get["failed"])
    opened = scan_table(spark, path)
    failures = opened.filter("reason IS NOT NULL")
    write_table(failures.select("url", "n_requests", "status", "reason"), f"{rejects}/responses")
    if calls.made and (calls.failed == calls.made or calls.failed > most_failed * calls.made):
        raise CallsFailed(f"{calls.failed} of {calls.made} calls failed; see {rejects}/responses")
    return opened.filter("reason IS NULL").drop("reason", "status"), calls


def extract(
    spark: SparkSession,
    stations: str,
    responses: str,
    entries: str,
    rejects: str,
    transport: Transport,
    endpoint: str,
    date: str | datetime.date,
    parallelism: int,
    *,
    most_failed: float,
    **options,
) -> Calls:
    """Fetch, then store the entries of all replies as JSON Lines.

    If calls were made and none of them, or fewer than ``most_failed`` allows as a share, gave an
    array of entries, this raises ``CallsFailed`` and leaves earlier entries as they are. Without
    any call the entries are empty. ``options`` are those of ``fetch``.
    """
    made = _fetch(spark, stations, responses, rejects, transport, endpoint, date, parallelism, **options)
    with scratch(spark) as fresh:
        opened, calls = _opened(scan_table(spark, responses), made, rejects, None, most_failed, fresh("entries"))
        write_entries(repeat_entries(opened), entries)
    return calls


def fetch_and_transform(
    spark: SparkSession,
    stations: str,
    responses: str,
    target: str,
    rejects: str,
    transport: Transport,
    endpoint: str,
    date: str | datetime.date,
    schema: StructType,
    parallelism: int,
    *,
    most_failed: float,
    **options,
) -> Calls:
    """Fetch, then store typed rows directly, with no JSON file in between.

    Failed calls and ``options`` as in ``extract``. An entry is parsed once, however many stations share
    it, and a rejected one is listed once, with the number of its requests.
    """
    made = _fetch(spark, stations, responses, rejects, transport, endpoint, date, parallelism, **options)
    with scratch(spark) as fresh:
        opened, calls = _opened(scan_table(spark, responses), made, rejects, schema, most_failed, fresh("entries"))
        usable, damaged = split_rejects(opened, schema.names)
        write_table(repeat_entries(usable.drop("url")), target)
        seen = Observation()
        write_table(damaged.observe(seen, F.count(F.lit(1)).alias("rejected")), f"{rejects}/entries")
    return replace(calls, entries_rejected=seen.get["rejected"])
