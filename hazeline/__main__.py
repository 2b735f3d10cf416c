"""Run one job: ``spark-submit --py-files hazeline.zip hazeline/__main__.py JOB INPUT OUTPUT``."""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import SparkSession

from hazeline import files, plans
from hazeline.operators.requests import ENDPOINTS
from hazeline.plans import Paths
from hazeline.schemas import FORECAST, OBSERVATION
from hazeline.sources import HttpTransport
from hazeline.sources.entries import LAYOUTS
from hazeline.sources.web import Transport
from hazeline.streaming import load_increment, load_latest

SCHEMAS = {"observation": OBSERVATION, "forecast": FORECAST}


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="hazeline")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, source: str, target: str | None, summary: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=summary)
        sub.add_argument("source", metavar=source)
        if target:
            sub.add_argument("target", metavar=target)
        return sub

    def calls_api(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--base-url", required=True)
        sub.add_argument("--date", required=True)
        sub.add_argument("--distance", type=int, default=1)
        sub.add_argument("--parallelism", type=int, required=True, help="number of calling tasks")
        sub.add_argument("--concurrency", type=int, default=1, help="calls under way per task")
        sub.add_argument("--rate", type=float, help="calls per second of all tasks together")
        sub.add_argument(
            "--most-failed", type=float, required=True, help="share of failed calls that is no error"
        )
        sub.add_argument("--api-key-variable", help="environment variable that holds the API key")

    def has_encoding(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--encoding", default="UTF-8")

    has_encoding(job("stations", "FILE", "TABLE", "filter a station file"))
    two_step = job("stations-two-step", "FILE", "TABLE", "the same over a table of all stations")
    two_step.add_argument("--all-stations", required=True, metavar="TABLE")
    has_encoding(two_step)
    for kind in ENDPOINTS:
        for sub in (
            job(f"extract-{kind}s", "STATIONS", "ENTRIES", f"fetch {kind}s"),
            job(f"load-{kind}s", "STATIONS", "TABLE", f"fetch {kind}s straight into a table"),
        ):
            calls_api(sub)
            sub.add_argument("--resume", action="store_true", help="keep replies of a try that ended early")
        transform = job(f"transform-{kind}s", "ENTRIES", "TABLE", f"type {kind} entries")
        transform.add_argument("--form", choices=("lines", "array"), default="lines")
        transform.add_argument("--layout", choices=LAYOUTS, default="entries", help="of arrays")
        transform.add_argument("--keep-terminator", action="store_true")
        increment = job(f"append-{kind}s", "LANDING", "TABLE", f"append newly landed {kind}s")
        increment.add_argument("--checkpoint", required=True, metavar="FOLDER")
        increment.add_argument("--max-files", type=int, help="files per batch")
        latest = job(f"latest-{kind}s", "LANDING", "TABLE", f"replace by the latest delivery of {kind}s")
        latest.add_argument("--checkpoint", required=True, metavar="FOLDER")
        latest.add_argument("--folders", default="*", help="pattern of the deliveries' names")
        if kind == "observation":
            transform.add_argument("--infer", action="store_true", help="infer all fields")
    top = job("top", "TABLE", None, "show the readings with the highest index, of a table or the last run")
    top.add_argument("--parameter", default="PM2.5")
    top.add_argument("-k", type=int, default=20)
    everything = job("run", "FILE", "FOLDER", "all jobs in order")
    calls_api(everything)
    has_encoding(everything)
    return parser.parse_args(arguments)


def _transport(options: argparse.Namespace) -> Transport:
    key = os.environ[options.api_key_variable] if options.api_key_variable else None
    return HttpTransport(options.base_url, key)


def run(
    spark: SparkSession, options: argparse.Namespace, transport: Transport | None = None
) -> None:
    """Run the chosen job; responses and rejects go next to its output."""
    source, target = options.source, getattr(options, "target", "").rstrip("/")
    rejects = f"{target}_rejects"
    verb, _, rest = options.job.partition("-")
    kind = rest.removesuffix("s")
    if options.job == "stations":
        plans.load_stations(spark, source, target, rejects, encoding=options.encoding)
    elif options.job == "stations-two-step":
        plans.load_stations_two_step(
            spark, source, options.all_stations, target, rejects, encoding=options.encoding
        )
    elif options.job == "top":
        if files.exists(spark, Paths(source).manifest):
            source = plans.committed(spark, Paths(source))["observation"]
        plans.top_table(spark, source, options.parameter, options.k).show(
            options.k, truncate=False
        )
    elif options.job == "transform-observations":
        schema = None if options.infer else OBSERVATION
        plans.transform_observations(
            spark, source, target, rejects, schema, options.form, options.keep_terminator,
            options.layout,
        )
    elif options.job == "transform-forecasts":
        plans.transform_forecasts(
            spark, source, target, rejects, options.form, options.keep_terminator, options.layout
        )
    elif verb == "append":
        load_increment(
            spark, source, target, options.checkpoint, SCHEMAS[kind], options.max_files
        )
    elif verb == "latest":
        load_latest(spark, source, target, options.checkpoint, SCHEMAS[kind], options.folders)
    else:
        transport = transport or _transport(options)
        pace = {
            name: getattr(options, name)
            for name in ("distance", "parallelism", "concurrency", "rate", "most_failed")
        }
        if verb != "run":
            pace["resume"] = options.resume
        calls = (f"{target}_responses", target, rejects, transport, kind, options.date)
        if verb == "run":
            paths = Paths(target)
            outcome = plans.run_all(
                spark, source, paths, transport, options.date, encoding=options.encoding, **pace
            )
        elif verb == "extract":
            outcome = {kind: plans.extract(spark, source, *calls, **pace)}
        else:
            outcome = {kind: plans.fetch_and_transform(spark, source, *calls, SCHEMAS[kind], **pace)}
        for name, found in outcome.items():
            print(
                f"{name}: {found.made} calls, {found.failed} failed, "
                f"{found.entries_rejected} entries rejected"
            )


def main() -> None:
    options = parse()
    spark = SparkSession.builder.appName(f"hazeline {options.job}").getOrCreate()
    try:
        run(spark, options)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
