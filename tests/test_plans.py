"""Shuffles and Python in the plans of the main operators."""

import json

import pytest

from hazeline import plans
from hazeline.operators import (
    build_requests,
    explode_responses,
    filter_parameter,
    filter_states,
    parse_entries,
    project_locations,
    rank_by_aqi,
    repeat_entries,
    response_rejects,
    split_locations,
    split_rejects,
    table_shape,
)
from hazeline.schemas import FORECAST, OBSERVATION
from hazeline.sinks import write_table
from hazeline.sources import (
    Reply,
    fetch_responses,
    scan_json_array,
    scan_json_lines,
    scan_stations,
    scan_stations_raw,
    scan_table,
)


@pytest.fixture
def inputs(spark, tmp_path):
    stations = tmp_path / "stations.dat"
    stations.write_text("Aliso|CA|US|Yes||33.61|-117.69|-8.0|Yes|PST|PDT|AAA|No|Src\n")
    entries = tmp_path / "entries.json"
    entries.write_text(json.dumps({"ParameterName": "PM2.5", "AQI": 5}) + "\n")
    table, replies = str(tmp_path / "table"), str(tmp_path / "replies")
    write_table(split_rejects(scan_json_lines(spark, str(entries), OBSERVATION))[0], table)
    columns = "url string, n_requests bigint, status int, body string, error string"
    write_table(spark.createDataFrame([("u", 1, 200, "[]", None)], columns), replies)
    return {
        "stations": scan_stations(spark, str(stations)),
        "raw": scan_stations_raw(spark, str(stations)),
        "lines": scan_json_lines(spark, str(entries), OBSERVATION),
        "array": scan_json_array(spark, str(entries), OBSERVATION),
        "table": table,
        "replies": scan_table(spark, replies),
    }


def requests(inputs):
    usable = split_locations(project_locations(filter_states(inputs["stations"])))[0]
    return build_requests(usable, "forecast", "2024-01-01")


SHUFFLES = {
    "filter": (0, lambda spark, i: filter_states(i["stations"])),
    "raw": (0, lambda spark, i: i["raw"]),
    "requests": (0, lambda spark, i: requests(i)),
    "usable lines": (0, lambda spark, i: split_rejects(i["lines"])[0]),
    "rejected lines": (0, lambda spark, i: split_rejects(i["lines"])[1]),
    "array": (0, lambda spark, i: split_rejects(i["array"])[0]),
    "entries": (0, lambda spark, i: parse_entries(explode_responses(i["replies"]), FORECAST)),
    "rejects": (0, lambda spark, i: response_rejects(i["replies"])),
    "top": (0, lambda spark, i: plans.top_table(spark, i["table"])),
    "shape": (1, lambda spark, i: table_shape(i["stations"])),
    "rank": (1, lambda spark, i: rank_by_aqi(filter_parameter(scan_table(spark, i["table"])))),
    "rank table": (1, lambda spark, i: plans.rank_table(spark, i["table"])),
    # Only entries with very many copies go through this one.
    "repeat": (1, lambda spark, i: repeat_entries(explode_responses(i["replies"]))),
    # One to count the requests of a URL, one to set the number of calling tasks.
    "fetch": (2, lambda spark, i: fetch_responses(requests(i), lambda url: Reply(200, "", None), 4)),
}


@pytest.mark.parametrize("name", SHUFFLES)
def test_shuffles(spark, inputs, plan, name):
    expected, build = SHUFFLES[name]
    tree = plan(build(spark, inputs)).split("(1) Scan")[0]
    assert tree.count("Exchange") == expected
    assert "Join" not in tree and "Cartesian" not in tree and "Broadcast" not in tree
    assert ("Arrow" in tree or "Python" in tree) == (name == "fetch")
