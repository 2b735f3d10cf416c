"""Whole runs, recurring loads, the command line and the shared folder."""

import json
import sys
import uuid
from pathlib import Path

import pytest
from pyspark import cloudpickle

from hazeline import plans, workspace
from hazeline.__main__ import parse, run
from hazeline.adapters import CannedApi
from hazeline.operators import split_rejects
from hazeline.plans import Paths
from hazeline.schemas import CORRUPT, FORECAST, OBSERVATION
from hazeline.sources import Reply, infer_entry_schema, scan_table
from hazeline.streaming import load_increment, load_latest

STATIONS = """Aliso|CA|US|Yes||33.61|-117.69|-8.0|Yes|PST|PDT|AAA|No|Src
Twin|CA|US|Yes||33.61|-117.69|-8.0|Yes|PST|PDT|BBB|No|Src
Broken|OR|US|Yes||44.7|-123.2|-8.0|Yes|PST|PDT|CCC|No|Src
Nowhere|WA|US|Yes|||-123.2|-8.0|Yes|PST|PDT|DDD|No|Src
Vegas|NV|US|Yes||36.1|-115.1|-8.0|Yes|PST|PDT|EEE|No|Src
"""


@pytest.fixture
def station_file(tmp_path):
    path = tmp_path / "stations.dat"
    path.write_text(STATIONS)
    return str(path)


class Down:
    def __call__(self, url):
        return Reply(None, None, "down")


def tables(spark, paths):
    places = plans.committed(spark, paths)
    return {
        kind: sorted(scan_table(spark, places[kind]).collect(), key=str)
        for kind in ("observation", "forecast")
    }


def run_all(spark, source, paths, transport, most_failed=1.0, **options):
    return plans.run_all(spark, source, paths, transport, "2024-01-01", 4, most_failed=most_failed, **options)


def test_whole_run_can_be_repeated(spark, station_file, tmp_path):
    root = Paths(str(tmp_path / "root"))
    results = []
    for _ in range(2):
        outcome = run_all(spark, station_file, root, CannedApi())
        results.append(tables(spark, root))
    paths = root.of_run(2)
    assert outcome == dict.fromkeys(("observation", "forecast"), plans.Calls(2, 1, 0))
    assert results[0] == results[1]
    assert [len(rows) for rows in results[0].values()] == [4, 4]
    assert scan_table(spark, paths.stations).count() == 4
    assert scan_table(spark, paths.table("forecast")).columns == FORECAST.names
    ranked = plans.rank_table(spark, paths.table("observation")).collect()
    assert [round(r.AQI, 2) for r in ranked] == [117.69, 117.69]
    assert scan_table(spark, f"{paths.rejects('stations')}/lines").count() == 0
    rejects = paths.rejects("observation")
    assert scan_table(spark, f"{rejects}/responses").first().reason == "body is not a JSON array"
    assert scan_table(spark, f"{rejects}/coordinates").first()["TWC code"] == "DDD"
    assert scan_table(spark, f"{rejects}/entries").count() == 0


class Counts:
    """Answers like a canned service and leaves a file per call; forecasts fail while a marker is there."""

    def __init__(self, folder, marker):
        self.folder, self.marker = str(folder), str(marker)

    def __call__(self, url):
        Path(self.folder, uuid.uuid4().hex).write_text(url)
        if "forecast" in url and Path(self.marker).exists():
            return Reply(503, None, "HTTP 503")
        return CannedApi()(url)


def test_a_run_counts_as_a_whole(spark, station_file, tmp_path):
    """Forecasts fail, so the observations of that run do not count either, until the run is complete."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    calls, marker = tmp_path / "calls", tmp_path / "marker"
    calls.mkdir()
    paths, service = Paths(str(tmp_path / "root")), Counts(calls, marker)
    run_all(spark, station_file, paths, CannedApi())
    before, places = tables(spark, paths), plans.committed(spark, paths)
    other = tmp_path / "other.dat"
    other.write_text(STATIONS.replace("33.61", "34.61"))
    marker.touch()
    with pytest.raises(plans.CallsFailed):
        run_all(spark, str(other), paths, service)
    assert scan_table(spark, paths.of_run(2).table("observation")).first().Latitude == pytest.approx(34.61)
    assert plans.committed(spark, paths) == places and tables(spark, paths) == before
    marker.unlink()
    made = len(list(calls.iterdir()))
    run_all(spark, str(other), paths, service)
    # Both replies about observations were settled; only the forecasts were asked for again.
    again = [path.read_text() for path in calls.iterdir()]
    assert len(again) == made + 2 and sum("observation" in url for url in again) == 2
    assert [round(r.Latitude, 2) for r in tables(spark, paths)["observation"]] == [34.61] * 4
    # The run before is still there for those who read it; the one before that goes.
    assert scan_table(spark, places["observation"]).count() == 4
    run_all(spark, str(other), paths, service)
    assert not (tmp_path / "root/runs/00000001").exists() and (tmp_path / "root/runs/00000002").exists()


def test_jobs_leave_no_intermediate_tables(spark, station_file, tmp_path, monkeypatch):
    folder = tmp_path / "shared"
    monkeypatch.setattr(workspace, "shared_folder", lambda _: str(folder))
    paths = Paths(str(tmp_path / "root"))
    run_all(spark, station_file, paths, CannedApi())
    with pytest.raises(plans.CallsFailed):
        run_all(spark, station_file, paths, CannedApi(), 0.1)
    broken = tmp_path / "broken"
    broken.write_text("no entry\n")
    with pytest.raises(plans.AllRejected):
        plans.transform_forecasts(spark, str(broken), str(tmp_path / "t"), str(tmp_path / "r"))
    array = tmp_path / "array"
    array.write_text('[\n{"a": 1}\n]')
    infer_entry_schema(spark, str(array))
    assert folder.exists() and not list(folder.iterdir())


class Malformed:
    def __call__(self, url):
        return Reply(200, "<html>", None)


@pytest.mark.parametrize("transport", [Down(), Malformed()])
def test_a_run_without_any_usable_reply_leaves_the_tables(spark, station_file, tmp_path, transport):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    paths = Paths(str(tmp_path / "root"))
    run_all(spark, station_file, paths, CannedApi())
    before = tables(spark, paths)
    with pytest.raises(plans.CallsFailed, match="2 of 2"):
        run_all(spark, station_file, paths, transport)
    assert tables(spark, paths) == before
    # ... and tells why.
    assert scan_table(spark, f"{paths.of_run(2).rejects('observation')}/responses").count() == 2


def test_some_failures_can_be_too_many(spark, station_file, tmp_path):
    paths = Paths(str(tmp_path / "root"))
    with pytest.raises(plans.CallsFailed, match="1 of 2"):
        run_all(spark, station_file, paths, CannedApi(), 0.4)
    with pytest.raises(plans.NoRun):
        plans.committed(spark, paths)
    run_all(spark, station_file, paths, CannedApi(), 0.5)
    target = str(tmp_path / "fused")
    arguments = (spark, paths.of_run(1).stations, str(tmp_path / "replies"), target, str(tmp_path / "rejects"))
    calls = ("observation", "2024-01-01", OBSERVATION, 4)
    found = plans.fetch_and_transform(*arguments, CannedApi(), *calls, most_failed=0.5)
    assert found == plans.Calls(2, 1, 0)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    with pytest.raises(plans.CallsFailed):
        plans.fetch_and_transform(*arguments, Down(), *calls, most_failed=1.0)
    assert scan_table(spark, target).count() == 4


def test_a_run_without_any_call_gives_empty_tables(spark, tmp_path):
    path = tmp_path / "stations.dat"
    path.write_text("Nowhere|WA|US|Yes|||-123.2|-8.0|Yes|PST|PDT|DDD|No|Src\n")
    paths = Paths(str(tmp_path / "root"))
    outcome = run_all(spark, str(path), paths, CannedApi())
    assert outcome["forecast"] == plans.Calls(0, 0, 0)
    assert tables(spark, paths) == {"observation": [], "forecast": []}


def test_a_failing_step_ends_the_run(spark, tmp_path):
    paths = Paths(str(tmp_path / "root"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_all(spark, str(tmp_path / "missing"), paths, CannedApi())
    with pytest.raises(plans.NoRun):
        plans.committed(spark, paths)


def lines(first, count):
    return "".join(json.dumps({"AQI": i}) + "\n" for i in range(first, first + count))


def test_recurring_load_reads_each_file_once(spark, tmp_path):
    landing, table = tmp_path / "landing", str(tmp_path / "table")
    landing.mkdir()

    def load():
        load_increment(
            spark, str(landing), table, str(tmp_path / "checkpoint"), OBSERVATION, max_files=1
        )
        return sorted(r.AQI for r in split_rejects(scan_table(spark, table))[0].collect())

    (landing / "1.json").write_text(lines(0, 100))
    (landing / "2.json").write_text(lines(100, 100))
    assert load() == list(range(200))
    assert load() == list(range(200))
    (landing / "3.json").write_text(lines(200, 50) + "broken\n")
    assert load() == list(range(250))
    rejects = split_rejects(scan_table(spark, table))[1]
    assert [r[CORRUPT] for r in rejects.collect()] == ["broken"]


def test_the_latest_delivery_is_what_the_table_holds(spark, tmp_path):
    landing, table = tmp_path / "landing", tmp_path / "table"

    def deliver(name, *texts):
        for number, text in enumerate(texts):
            (landing / name).mkdir(parents=True, exist_ok=True)
            (landing / name / f"{len(list((landing / name).iterdir()))}.json").write_text(text)

    def load(checkpoint="checkpoint"):
        load_latest(spark, str(landing), str(table), str(tmp_path / checkpoint), OBSERVATION)
        return sorted(r.AQI for r in split_rejects(scan_table(spark, str(table)))[0].collect())

    deliver("2024-01-01T00", *[lines(at, 10) for at in range(0, 100, 10)])
    assert load() == list(range(100))
    assert len(list(table.glob("part-*"))) == 1
    deliver("2024-01-01T01", lines(200, 5), lines(205, 5) + "broken\n")
    assert load() == list(range(200, 210))
    assert [r[CORRUPT] for r in split_rejects(scan_table(spark, str(table)))[1].collect()] == ["broken"]
    # Nothing new: the table is not even written again.
    files = sorted(table.iterdir())
    assert load() == list(range(200, 210)) and sorted(table.iterdir()) == files
    # The same files once more, as after a failure before the batch was marked as done.
    assert load("another checkpoint") == list(range(200, 210))
    # An older delivery that arrives late changes nothing; more of the latest is added to it.
    deliver("2023-12-31T23", lines(900, 5))
    assert load() == list(range(200, 210))
    deliver("2024-01-01T01", lines(300, 1))
    assert load() == [*range(200, 210), 300]
    # Several at once.
    deliver("2024-01-01T02", lines(1, 1))
    deliver("2024-01-01T03", lines(2, 1))
    assert load() == [2]


def test_command_line_jobs(spark, station_file, tmp_path, capsys):
    def go(*arguments):
        run(spark, parse(list(map(str, arguments))), CannedApi())

    api = ("--base-url", "https://api.example", "--date", "2024-01-01", "--parallelism", "4", "--most-failed", "0.5")
    stations, other = tmp_path / "stations", tmp_path / "other"
    go("stations", station_file, stations)
    go("stations-two-step", station_file, other, "--all-stations", tmp_path / "all")
    assert scan_table(spark, f"{other}_rejects").count() == 0
    assert scan_table(spark, str(stations)).count() == scan_table(spark, str(other)).count() == 4
    for kind, schema in (("observations", OBSERVATION), ("forecasts", FORECAST)):
        entries, typed, fused = (tmp_path / f"{kind}-{n}" for n in ("entries", "typed", "fused"))
        go(f"extract-{kind}", stations, entries, *api)
        go(f"transform-{kind}", entries, typed)
        go(f"load-{kind}", stations, fused, *api)
        appended = tmp_path / f"{kind}-appended"
        for _ in range(2):
            go(f"append-{kind}", entries, appended, "--checkpoint", tmp_path / f"{kind}-stream")
        assert scan_table(spark, str(appended)).count() == 4
        latest = tmp_path / f"{kind}-latest"
        go(f"latest-{kind}", tmp_path, latest, "--checkpoint", tmp_path / f"{kind}-latest-stream", "--folders", f"{kind}-entries")
        assert scan_table(spark, str(latest)).count() == 4
        assert scan_table(spark, str(typed)).columns == schema.names
        assert scan_table(spark, str(typed)).count() == scan_table(spark, str(fused)).count() == 4
    inferred = tmp_path / "inferred"
    go("transform-observations", tmp_path / "observations-entries", inferred, "--infer")
    assert "Category" in scan_table(spark, str(inferred)).columns
    capsys.readouterr()
    go("top", tmp_path / "observations-typed", "--parameter", "O3", "-k", "1")
    assert "33.0" in capsys.readouterr().out
    go("run", station_file, tmp_path / "root", *api)
    assert len(tables(spark, Paths(str(tmp_path / "root")))["forecast"]) == 4
    assert "forecast: 2 calls, 1 failed, 0 entries rejected" in capsys.readouterr().out
    go("top", tmp_path / "root", "--parameter", "O3", "-k", "1")
    assert "33.0" in capsys.readouterr().out
    pretty = tmp_path / "pretty.json"
    pretty.write_text(json.dumps([{"AQI": 1}, {"AQI": 2}], indent=2))
    form = ("--form", "array", "--layout", "document")
    go("transform-forecasts", pretty, tmp_path / "from-pretty", *form)
    assert scan_table(spark, str(tmp_path / "from-pretty")).count() == 2


def test_command_line_reads_the_key_from_the_environment(monkeypatch):
    from hazeline.__main__ import _transport

    monkeypatch.setenv("SOME_KEY", "k")
    options = parse(
        ["run", "a", "b", "--base-url", "https://api.example", "--date", "2024-01-01",
         "--parallelism", "4", "--most-failed", "0.5", "--api-key-variable", "SOME_KEY"]
    )
    assert _transport(options)._api_key == "k"
    with pytest.raises(SystemExit):
        parse(["run", "a", "b"])


def test_shared_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = workspace.shared_folder(spark)
    assert folder == configured.rstrip("/") if configured else "hazeline-" in folder
    assert workspace.fresh_path(spark, "x") != workspace.fresh_path(spark, "x")


class Cluster:
    """A session on a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(name, default):
            return default

    class sparkContext:
        master = "yarn"


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_folder(Cluster)
