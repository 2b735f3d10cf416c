"""Station files, state filter, shapes and landing."""

import gzip

import pytest

from hazeline import plans
from hazeline.operators import filter_states, project_locations, table_shape
from hazeline.schemas import CORRUPT, STATION
from hazeline.sources import (
    land_raw,
    list_source_files,
    scan_gz_text,
    scan_stations,
    scan_stations_raw,
    scan_table,
    stations_from_rows,
)

LINES = [
    "Aliso|CA|US|Yes||33.64|-117.69|-8.0|Yes|PST|PDT|AAA|No|Src",
    "Señor|OR|US|Yes||44.5|-123.25|-8.0|Yes|PST|PDT|BBB|No|Src",
    "Badnum|WA|US|Yes||47.5|notnum|-8.0|Yes|PST|PDT|CCC|No|Src",
    "Short|WA|US",
    "Long|CA|US|Yes||33.0|-117.0|-8.0|Yes|PST|PDT|DDD|No|Src|surplus",
    "Lower|ca|US|Yes||33.0|-117.0|-8.0|Yes|PST|PDT|EEE|No|Src",
    "Space| CA|US|Yes||33.0|-117.0|-8.0|Yes|PST|PDT|FFF|No|Src",
    "Empty||US|Yes||33.0|-117.0|-8.0|Yes|PST|PDT|GGG|No|Src",
    '"Q|uoted"|CA|US|Yes||33.0|-117.0|-8.0|Yes|PST|PDT|HHH|No|Src',
    "",
    "Forms|NV|US|Yes||1e2| 12.5|-8.0|Yes|PST|PDT|III|No|Src",
]


@pytest.fixture
def station_file(tmp_path):
    def write(encoding="UTF-8", lines=LINES, newline="\n"):
        path = tmp_path / "stations.dat"
        path.write_bytes(newline.join(lines).encode(encoding))
        return str(path)

    return write


def by_area(df):
    return {row["Reporting area"]: row for row in df.collect()}


def test_declared_scan(spark, station_file):
    df = scan_stations(spark, station_file())
    assert df.schema == STATION
    rows = by_area(df)
    assert len(rows) == 10  # the blank line is skipped
    assert rows["Aliso"]["Action Day name"] is None
    assert rows["Aliso"]["Latitude"] == pytest.approx(33.64)
    assert rows["Badnum"]["Longitude"] is None and rows["Badnum"]["Latitude"] == 47.5
    assert rows["Short"]["TWC code"] is None
    assert rows["Long"]["Forecast Source"] == "Src"
    assert rows["Q|uoted"]["State code"] == "CA"
    assert (rows["Forms"]["Latitude"], rows["Forms"]["Longitude"]) == (100.0, 12.5)


def test_encoding_is_a_parameter(spark, station_file):
    path = station_file("ISO-8859-1")
    assert "Se�or" in by_area(scan_stations(spark, path))
    assert "Señor" in by_area(scan_stations(spark, path, encoding="ISO-8859-1"))


def test_malformed_lines_keep_their_text(spark, station_file):
    df = scan_stations(spark, station_file(), malformed=True)
    marked = df.filter(f"{CORRUPT} is not null").select("Reporting area", CORRUPT).collect()
    assert {r[0]: r[1] for r in marked} == {
        "Badnum": LINES[2],
        "Short": LINES[3],
        "Long": LINES[4],
    }


def test_raw_scan_keeps_empty_fields_and_blank_lines(spark, station_file):
    rows = scan_stations_raw(spark, station_file("ISO-8859-1")).collect()
    assert [r.fields for r in rows] == [line.split("|") for line in LINES]
    assert rows[0]["Action Day name"] == ""
    assert rows[1]["Reporting area"] == "Señor"
    assert rows[3]["TWC code"] is None


@pytest.mark.parametrize("newline", ["\n", "\r\n", "\r"])
def test_raw_scan_breaks_lines_as_text_files_do(spark, station_file, newline):
    rows = scan_stations_raw(spark, station_file("ISO-8859-1", LINES[:3], newline)).collect()
    assert [r["Forecast Source"] for r in rows] == ["Src"] * 3


def test_raw_scan_rejects_multi_byte_encodings(spark, station_file):
    with pytest.raises(ValueError, match="encoding"):
        scan_stations_raw(spark, station_file(), "UTF-16")


def test_rows_from_memory(spark):
    df = stations_from_rows(spark, [LINES[0].split("|")])
    assert df.columns == STATION.names
    assert df.first()["Latitude"] == "33.64"


def test_state_filter_is_exact(spark, station_file):
    df = scan_stations(spark, station_file())
    kept = set(by_area(filter_states(df)))
    assert kept == {"Aliso", "Señor", "Badnum", "Short", "Long", "Q|uoted"}
    assert set(by_area(filter_states(df, ["OR"]))) == {"Señor"}


def test_state_filter_reaches_the_scan(spark, station_file, plan):
    text = plan(project_locations(filter_states(scan_stations(spark, station_file()))))
    assert "PushedFilters: [In(State code, [CA,OR,WA])]" in text
    assert (
        "ReadSchema: struct<State code:string,Latitude:float,Longitude:float,TWC code:string>"
        in text
    )


def test_shape(spark, station_file):
    shape = table_shape(filter_states(scan_stations(spark, station_file())))
    assert shape.first().asDict() == {"rows": 6, "columns": 14}


def test_station_jobs(spark, station_file, tmp_path):
    one, everything, two = (str(tmp_path / n) for n in ("one", "all", "two"))
    for _ in range(2):  # a second run replaces the first
        rejects = [str(tmp_path / f"rejects-{name}") for name in ("one", "two")]
        assert plans.load_stations(spark, station_file(), one, rejects[0]) == 3
        assert plans.load_stations_two_step(spark, station_file(), everything, two, rejects[1]) == 3
    listed = [sorted(scan_table(spark, path).collect(), key=str) for path in rejects]
    assert listed[0] == listed[1] and len(listed[0]) == 3
    assert sorted(scan_table(spark, one).collect()) == sorted(scan_table(spark, two).collect())
    assert scan_table(spark, one).count() == 6
    assert scan_table(spark, everything).count() == 10


def test_station_job_lists_malformed_lines(spark, station_file, tmp_path):
    plain, table, rejects = (str(tmp_path / n) for n in ("plain", "table", "rejects"))
    plans.load_stations(spark, station_file(), plain, f"{rejects}-plain")
    other_state = "Short|NV|US"
    lines = station_file(lines=LINES + [other_state])
    plans.load_stations(spark, lines, table, rejects)
    assert scan_table(spark, table).schema == scan_table(spark, plain).schema
    assert sorted(scan_table(spark, table).collect()) == sorted(scan_table(spark, plain).collect())
    listed = {r[CORRUPT] for r in scan_table(spark, rejects).collect()}
    assert listed == {LINES[2], LINES[3], LINES[4], other_state}
    plans.load_stations(spark, station_file(lines=LINES[:2]), table, rejects)
    assert scan_table(spark, table).count() == 2
    assert scan_table(spark, rejects).count() == 0


def test_landing_keeps_every_byte(spark, tmp_path):
    content = "Señor|OR\r\n\n||x\rtail".encode("ISO-8859-1") + b"\n"
    source = tmp_path / "in.dat"
    source.write_bytes(content)
    target = tmp_path / "landed"
    land_raw(spark, str(source), str(target))
    parts = sorted(target.glob("part-*"))
    assert b"".join(p.read_bytes() for p in parts) == content
    files = list_source_files(spark, str(target)).collect()
    assert sum(f["length"] for f in files) == len(content)


def test_large_file_lands_in_parallel(spark, tmp_path):
    source = tmp_path / "in.dat"
    source.write_bytes(b"".join(b"%06d|CA|\xf1\n" % i for i in range(20000)))
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        land_raw(spark, str(source), str(tmp_path / "landed"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)
    parts = sorted((tmp_path / "landed").glob("part-*"))
    assert len(parts) > 4
    assert b"".join(p.read_bytes() for p in parts) == source.read_bytes()


def test_gzip_text(spark, tmp_path):
    path = tmp_path / "stdout.gz"
    path.write_bytes(gzip.compress("first\nzweite ä\n".encode()))
    assert [r.value for r in scan_gz_text(spark, str(path)).collect()] == ["first", "zweite ä"]
    missing = scan_gz_text(spark, str(tmp_path / "none.gz"))
    assert missing.columns == ["value"] and missing.count() == 0
