"""JSON array files, JSON Lines and rejects."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, LongType, StringType

from hazeline import plans
from hazeline.functions import opened_array
from hazeline.operators import entries_or_reasons, explode_responses, parse_entries, response_rejects, split_rejects
from hazeline.schemas import CORRUPT, FORECAST, OBSERVATION
from hazeline.sinks import write_entries, write_json_array, write_json_lines, write_table
from hazeline.sources import infer_entry_schema, scan_json_array, scan_json_lines, scan_table

ENTRY = {
    "DateObserved": "2023-03-21 ",
    "HourObserved": 9,
    "LocalTimeZone": "PST",
    "ReportingArea": "Área",
    "StateCode": "CA",
    "Latitude": 33.64,
    "Longitude": -117.69,
    "ParameterName": "PM2.5",
    "AQI": 42,
    "Category": {"Number": 1, "Name": "Good"},
}


def array_text(*entries, end="{}\n]"):
    return "[\n" + "".join(json.dumps(e) + ",\n" for e in entries) + end


@pytest.fixture
def file(tmp_path):
    def write(text, name="entries.json"):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return write


@pytest.mark.parametrize("layout", ["entries", "document"])
def test_declared_scan_drops_undeclared_fields_and_the_terminator(spark, file, layout):
    path = file(array_text(ENTRY, ENTRY))
    rows = scan_json_array(spark, path, OBSERVATION, layout)
    assert rows.columns == OBSERVATION.names + [CORRUPT]
    first, second = rows.collect()
    assert first == second
    assert first["DateObserved"] == "2023-03-21 "  # not trimmed
    assert first["HourObserved"] == "9"
    assert first["AQI"] == 42.0 and dict(rows.dtypes)["AQI"] == "float"


@pytest.mark.parametrize("layout", ["entries", "document"])
@pytest.mark.parametrize("keep", [False, True])
def test_selecting_only_rejected_text(spark, file, layout, keep):
    path = file(array_text(ENTRY, {**ENTRY, "AQI": "high"}))
    rows = scan_json_array(spark, path, OBSERVATION, layout, keep_terminator=keep)
    assert rows.filter(f"{CORRUPT} is not null").count() == 1
    assert rows.select(CORRUPT).filter(f"{CORRUPT} is not null").count() == 1


@pytest.mark.parametrize("layout", ["entries", "document"])
def test_terminator_can_be_kept(spark, file, layout):
    path = file(array_text(ENTRY))
    rows = scan_json_array(spark, path, OBSERVATION, layout, keep_terminator=True).collect()
    assert len(rows) == 2
    assert sum(all(v is None for v in row) for row in rows) == 1


@pytest.mark.parametrize("layout", ["entries", "document"])
def test_only_the_terminator_is_dropped(spark, file, layout):
    path = file(array_text({}, {"Category": {"Number": 2}}, ENTRY, {}))
    assert scan_json_array(spark, path, OBSERVATION, layout).count() == 4


def test_documents(spark, tmp_path):
    texts = {
        "object": json.dumps(ENTRY, indent=1),
        "several": "\n".join([json.dumps(ENTRY)] * 2),
        "blank": " ",
        "spaced": json.dumps([ENTRY, {}]).replace("{}", "{ }"),
        "null": f"[null, {json.dumps(ENTRY)}]",
        "bad": json.dumps([ENTRY, {**ENTRY, "AQI": "high"}, ENTRY], indent=2),
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    rows, rejects = split_rejects(
        scan_json_array(spark, str(tmp_path), OBSERVATION, layout="document")
    )
    assert rows.count() == 5
    found = {r[CORRUPT] for r in rejects.collect()}
    assert texts["object"] in found and texts["several"] in found and "null" in found
    (bad,) = found - {texts["object"], texts["several"], "null"}
    assert json.loads(bad) == {**ENTRY, "AQI": "high"}  # not the whole file


def test_lines_that_hold_more_than_an_entry(spark, file):
    one = json.dumps({"AQI": 1})
    nested = json.dumps({"a": {"b": [{}, {"c": "} , {"}]}, "AQI": 1, "Category": {}})
    path = file(
        f"[\n{one}, {one},\n{one}{one},\n{one} tail,\n[{one}],\n{one} , \n{nested},\n"
        f'{one}, "x", {nested},\n{{}}\n]'
    )
    rows, rejects = split_rejects(scan_json_array(spark, path, OBSERVATION))
    assert [r.AQI for r in rows.collect()] == [1.0] * 6
    assert len(rejects.collect()) == 4


def test_inference_sees_all_entries_of_a_line(spark, file):
    path = file('[\n{"a": 1}, {"b": 2},\n{}\n]')
    for layout in ("entries", "document"):
        rows = scan_json_array(spark, path, layout=layout)
        assert rows.columns == ["a", "b", CORRUPT] and rows.count() == 2
    strings = file('[\n{"a": "}, {"},\n{}\n]')
    assert scan_json_array(spark, strings).first()["a"] == "}, {"


def test_a_pinned_schema_needs_no_pass_of_its_own(spark, file, plan):
    path = file(array_text(ENTRY))
    pinned = infer_entry_schema(spark, path)
    assert scan_json_array(spark, path, pinned).drop(CORRUPT).columns == pinned.names
    assert plan(scan_json_array(spark, path, pinned)).count("Scan text") <= 2  # tree and details


def test_inferred_scan(spark, file):
    rows, rejects = split_rejects(scan_json_array(spark, file(array_text(ENTRY))))
    assert rows.columns == sorted(ENTRY)
    types = {f.name: f.dataType for f in rows.schema}
    assert types["AQI"] == LongType() and types["HourObserved"] == LongType()
    assert types["Latitude"] == DoubleType()
    assert rows.first()["Category"]["Name"] == "Good"
    assert rejects.count() == 0


@pytest.mark.parametrize("layout", ["entries", "document"])
def test_empty_result(spark, file, layout):
    path = file(array_text())
    assert scan_json_array(spark, path, OBSERVATION, layout).count() == 0
    with pytest.raises(ValueError, match="declare"):
        scan_json_array(spark, path, None, layout)


def test_truncated_file_yields_its_complete_entries(spark, file):
    path = file(array_text(ENTRY, end='{"AQI": 7, "Para'))
    rows, rejects = split_rejects(scan_json_array(spark, path, OBSERVATION))
    assert [r.AQI for r in rows.collect()] == [42.0]
    assert [r[CORRUPT] for r in rejects.collect()] == ['{"AQI": 7, "Para']


def test_truncated_document_yields_its_complete_entries(spark, file):
    text = array_text(ENTRY, end="")
    rows, rejects = split_rejects(
        scan_json_array(spark, file(text + '{"AQI": 7, "Para'), OBSERVATION, layout="document")
    )
    assert [r.AQI for r in rows.collect()] == [42.0]
    assert [r[CORRUPT] for r in rejects.collect()] == ['{"AQI": 7, "Para']


ARRAYS = {
    "one line": json.dumps([{"AQI": 1}, {"AQI": 2, "Category": [{}]}]),
    "one line, closed": json.dumps([{"AQI": 1}, {"AQI": 2}, {}]),
    "several arrays": '[{"AQI": 1}]\n [ {"AQI": 2} ] \n',
    "opening bracket": '[{"AQI": 1},\n{"AQI": 2},\n{}\n]',
    "closing bracket": '[\n{"AQI": 1},\n{"AQI": 2}]',
    "both brackets": ' [ {"AQI": 1},\n{"AQI": 2} ] ',
    "closing object with bracket": '[{"AQI": 1},\n{"AQI": 2},\n{}]',
    "bracket and several": '[{"AQI": 1}, {"AQI": 2},\n{}]',
}


@pytest.mark.parametrize("name", ARRAYS)
def test_arrays_on_fewer_lines(spark, file, name):
    path = file(ARRAYS[name])
    for schema in (OBSERVATION, None):
        rows, rejects = split_rejects(scan_json_array(spark, path, schema))
        assert sorted(r.AQI for r in rows.collect()) == [1.0, 2.0]
        assert rejects.count() == 0
    kept = scan_json_array(spark, path, OBSERVATION, keep_terminator=True)
    assert kept.count() == 2 + ("{}" in ARRAYS[name].replace("[{}]", ""))


def test_an_array_among_the_entries_is_no_object(spark, file):
    path = file('[\n{"AQI": 1},\n[{"AQI": 2}],\n{}\n]')
    rows, rejects = split_rejects(scan_json_array(spark, path, OBSERVATION))
    assert [r.AQI for r in rows.collect()] == [1.0]
    assert rejects.count() == 1


@pytest.mark.parametrize("indent", [None, 2])
def test_other_formatting_through_the_job(spark, tmp_path, file, indent):
    """Documents are read in any formatting; where lines can't be, nothing is replaced."""
    source = file(json.dumps([ENTRY, {**ENTRY, "AQI": 7}], indent=indent))
    target, rejects = str(tmp_path / "t"), str(tmp_path / "r")
    found = plans.transform_observations(
        spark, source, target, rejects, form="array", layout="document"
    )
    assert found == 0 and scan_table(spark, target).count() == 2
    if indent:
        with pytest.raises(plans.AllRejected):
            plans.transform_observations(spark, source, target, rejects, form="array")
    else:
        assert plans.transform_observations(spark, source, target, rejects, form="array") == 0
    assert sorted(r.AQI for r in scan_table(spark, target).collect()) == [7.0, 42.0]


def test_unknown_layout(spark, file):
    with pytest.raises(ValueError, match="layout"):
        scan_json_array(spark, file("[]"), OBSERVATION, layout="rows")


def test_partly_readable_entry_is_row_and_reject(spark, file):
    path = file(array_text({**ENTRY, "AQI": "high"}, ENTRY))
    rows, rejects = split_rejects(scan_json_array(spark, path, OBSERVATION))
    assert sorted(str(r.AQI) for r in rows.collect()) == ["42.0", "None"]
    assert rejects.count() == 1
    # Leaving columns out must not change what counts as corrupt.
    assert rows.select("StateCode").count() == 2
    assert rejects.select(CORRUPT).count() == 1


PIECES = ["}", "{", ",", '"', "\\", "]", "[", ":", " ", "\n", "é", "a", '"x":', "},{", '}, "k": 1']


def random_value(rng, depth=0):
    kind = rng.randrange(4 if depth < 3 else 2)
    if kind == 0:
        return "".join(rng.choice(PIECES) for _ in range(rng.randrange(6)))
    if kind == 1:
        return rng.choice([1, -2.5, True, None])
    if kind == 2:
        return [random_value(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {f"k{i}": random_value(rng, depth + 1) for i in range(rng.randrange(3))}


@pytest.mark.parametrize("layout", ["entries", "document"])
def test_any_entries_are_read_as_json_reads_them(spark, file, layout):
    rng = random.Random(11)
    lines, expected = [], []
    for number in range(3000):
        entry = {"Before": random_value(rng), "AQI": number, "Discussion": random_value(rng)}
        entry["ReportingArea"] = "".join(rng.choice(PIECES) for _ in range(5))
        if rng.random() < 0.5:
            entry["After"] = random_value(rng)
        expected.append((float(number), entry["ReportingArea"]))
        text = json.dumps(entry, ensure_ascii=rng.random() < 0.5)
        if lines and rng.random() < 0.1:
            lines[-1] += rng.choice([",", " , "]) + text
        else:
            lines.append(text)
    path = file("[\n" + "".join(f"{line},\n" for line in lines) + "{}\n]")
    rows, rejects = split_rejects(scan_json_array(spark, path, OBSERVATION, layout))
    assert sorted((r.AQI, r.ReportingArea) for r in rows.collect()) == expected
    assert rejects.count() == 0


@pytest.mark.parametrize("layout", ["entries", "document"])
def test_entries_are_parsed_once(spark, file, plan, layout):
    path = file(array_text(ENTRY))
    rows = split_rejects(scan_json_array(spark, path, OBSERVATION, layout))[0]
    text = plan(rows.filter("ParameterName = 'PM2.5'").select("AQI"))
    assert text.count("from_json(StructField") == 1
    # ... and an array only to take it apart, or to see what is left of one that was cut off.
    assert text.count("from_json(ArrayType") <= (3 if layout == "entries" else 0)


def test_array_file_splits(spark, file):
    path = file(array_text(*[ENTRY] * 500))
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = scan_json_array(spark, path, OBSERVATION)
        tasks = rows.select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 3
        assert rows.count() == 500
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)


def test_json_lines(spark, file):
    lines = "\n".join(json.dumps(e) for e in (ENTRY, {**ENTRY, "AQI": None}, ENTRY))
    path = file(lines + "\n\nbroken\n")
    rows, rejects = split_rejects(scan_json_lines(spark, path, OBSERVATION))
    assert rows.count() == 3 and rejects.count() == 1
    inferred = infer_entry_schema(spark, path)
    assert inferred.names == sorted(ENTRY)


def test_written_array_files(spark, tmp_path):
    texts = [json.dumps({**ENTRY, "AQI": i}) for i in range(50)]
    entries = spark.createDataFrame([(t,) for t in texts], "entry string").repartition(3)
    path = str(tmp_path / "array")
    write_json_array(entries, path)
    parts = list((tmp_path / "array").glob("part-*"))
    assert len(parts) == 3
    for part in parts:
        document = json.loads(part.read_text())
        assert document[-1] == {} and all(document[:-1])
    for layout in ("entries", "document"):
        got = [r.AQI for r in scan_json_array(spark, path, OBSERVATION, layout).collect()]
        assert sorted(got) == list(range(50))


@pytest.mark.parametrize("limit", [1, 7, 50, 99, 100, 101])
def test_limited_array_files_are_complete_arrays(spark, tmp_path, limit):
    texts = [json.dumps({**ENTRY, "AQI": i}) for i in range(100)]
    entries = spark.createDataFrame([(t,) for t in texts], "entry string").coalesce(1)
    path = tmp_path / "array"
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(batch, "13")
    try:
        write_json_array(entries, str(path), entries_per_file=limit)
    finally:
        spark.conf.unset(batch)
    sizes = []
    for part in path.glob("part-*"):
        document = json.loads(part.read_text())
        assert document[-1] == {} and all(document[:-1])
        sizes.append(len(document) - 1)
    assert sum(sizes) == 100 and max(sizes) <= limit and len(sizes) == -(-100 // limit)
    for layout in ("entries", "document"):
        got = [r.AQI for r in scan_json_array(spark, str(path), OBSERVATION, layout).collect()]
        assert sorted(got) == list(range(100))


def test_written_entries_keep_all_fields(spark, tmp_path):
    text = json.dumps({**ENTRY, "Extra": "x"})
    entries = spark.createDataFrame([(text,), (None,)], "entry string")
    path = str(tmp_path / "lines")
    write_entries(entries, path)
    assert "Extra" in infer_entry_schema(spark, path).names
    rows, rejects = split_rejects(scan_json_lines(spark, path, OBSERVATION))
    assert rows.count() == 1
    assert [r[CORRUPT] for r in rejects.collect()] == ["null"]


def test_typed_rows_round_trip(spark, tmp_path):
    rows = parse_entries(
        spark.createDataFrame([(json.dumps(ENTRY),), ("{}",)], "entry string"), OBSERVATION
    ).drop(CORRUPT)
    write_json_lines(rows, str(tmp_path / "typed"))
    back = scan_json_lines(spark, str(tmp_path / "typed"), OBSERVATION).drop(CORRUPT)
    assert sorted(back.collect(), key=str) == sorted(rows.collect(), key=str)


def test_repartitioned_write(spark, tmp_path):
    df = spark.range(1000)
    write_table(df, str(tmp_path / "t"), files=4)
    assert len(list((tmp_path / "t").glob("part-*"))) == 4
    assert scan_table(spark, str(tmp_path / "t")).count() == 1000


@pytest.mark.parametrize("form", ["lines", "array"])
def test_transform_jobs(spark, tmp_path, file, form):
    good = [ENTRY, {**ENTRY, "AQI": 7}]
    if form == "array":
        text = array_text(*good, end='{"AQI": 1\n{}\n]')
    else:
        text = "\n".join(map(json.dumps, good)) + '\n{"AQI": 1\n'
    source, target, rejects = file(text), str(tmp_path / "t"), str(tmp_path / "r")
    assert plans.transform_observations(spark, source, target, rejects, form=form) == 1
    table = scan_table(spark, target)
    assert table.schema.names == OBSERVATION.names
    assert sorted(r.AQI for r in table.collect()) == [7.0, 42.0]
    assert scan_table(spark, rejects).count() == 1

    # Rejects of an earlier run do not outlive a clean one.
    clean = file(array_text(ENTRY) if form == "array" else json.dumps(ENTRY))
    assert plans.transform_forecasts(spark, clean, target, rejects, form) == 0
    assert scan_table(spark, target).columns == FORECAST.names
    assert scan_table(spark, rejects).count() == 0


def test_rejects_cost_no_second_parse(spark, tmp_path, file, monkeypatch):
    """Rows and rejects come from one intermediate table."""
    from hazeline.plans import rejects as module

    read = []
    monkeypatch.setattr(module, "scan_table", lambda s, p: read.append(p) or scan_table(s, p))
    source = file(json.dumps(ENTRY) + "\nbroken\n")
    plans.transform_observations(spark, source, str(tmp_path / "t"), str(tmp_path / "r"))
    assert len(read) == 1 and source not in read[0]
    assert scan_table(spark, str(tmp_path / "r")).count() == 1


def test_transform_modes(spark, tmp_path, file):
    source, target, rejects = file(array_text(ENTRY)), str(tmp_path / "t"), str(tmp_path / "r")
    plans.transform_observations(spark, source, target, rejects, None, "array")
    types = {f.name: f.dataType for f in scan_table(spark, target).schema}
    assert types["AQI"] == LongType() and "Category" in types
    plans.transform_observations(
        spark, source, target, rejects, form="array", keep_terminator=True
    )
    table = scan_table(spark, target)
    assert table.count() == 2
    types = {f.name: f.dataType for f in table.schema}
    assert types["AQI"] == FloatType() and types["HourObserved"] == StringType()
    with pytest.raises(ValueError, match="form"):
        plans.transform_forecasts(spark, source, target, rejects, form="xml")


def documents(rng, count):
    """Entries and array texts of them in different formatting."""
    entries = []
    for number in range(count):
        entry = {"Before": random_value(rng), "AQI": number, "Discussion": random_value(rng)}
        entry["ReportingArea"] = "".join(rng.choice(PIECES) for _ in range(rng.randrange(40)))
        entries.append(entry)
    yield entries, json.dumps(entries, indent=2)
    yield entries, json.dumps([*entries, {}], indent="\t", ensure_ascii=False)
    yield entries, "\n\n[" + ",".join(json.dumps(entry, indent=1) for entry in entries) + "\n,{ \n}]\n"
    yield entries, "[\n" + "\n , ".join(json.dumps(entry) for entry in entries) + "]"


@pytest.mark.parametrize("size", [64, 700, 5000])
def test_pretty_files_are_read_by_many_tasks(spark, file, size):
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rng = random.Random(size)
    for number, (entries, text) in enumerate(documents(rng, 60)):
        path = file(text, f"pretty-{size}-{number}.json")
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        try:
            rows, rejects = split_rejects(scan_json_array(spark, path, OBSERVATION, layout="document"))
            found = sorted((r.AQI, r.ReportingArea) for r in rows.collect())
            assert found == [(float(e["AQI"]), e["ReportingArea"]) for e in entries]
            assert rejects.count() == 0
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", previous)


def test_a_large_pretty_file(spark, tmp_path):
    path = tmp_path / "large.json"
    entries = [{**ENTRY, "AQI": number, "Category": {"Number": number, "Name": "]}, {["}} for number in range(100_000)]
    path.write_text(json.dumps(entries, indent=2))
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(path.stat().st_size // 7))
    try:
        rows = scan_json_array(spark, str(path), OBSERVATION, layout="document")
        assert sorted(r.AQI for r in rows.select("AQI").collect()) == list(range(100_000))
        tasks = rows.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert len([task for task in tasks if task["count"] > 5_000]) > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)


@pytest.mark.parametrize("size", [100, 1 << 20])
def test_cut_off_and_stray_text_in_documents(spark, tmp_path, size):
    good = json.dumps([ENTRY, {**ENTRY, "AQI": 7}], indent=2)
    (tmp_path / "cut").write_text(good[: good.index(": 7") + 1])
    (tmp_path / "tail").write_text(good + "\nmore\n")
    (tmp_path / "two").write_text(f"{good}\n{good}")
    (tmp_path / "nested").write_text('[[{"AQI": 1}], "x", 3, null, {"AQI": 2}, ,]')
    (tmp_path / "empty").write_text("[\n]")
    (tmp_path / "log").write_text("no array\n" * 40)
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        rows, rejects = split_rejects(scan_json_array(spark, str(tmp_path), OBSERVATION, layout="document"))
        assert sorted(r.AQI for r in rows.collect()) == [2.0, 7.0, 7.0, 7.0] + [42.0] * 4
        texts = [r[CORRUPT] for r in rejects.collect()]
        logs = [text for text in texts if "no array" in text]
        assert "\n".join(logs).count("no array") == 40
        assert sorted(text for text in texts if text not in logs and not text.startswith("{")) == [
            '"x"', "3", '[{"AQI": 1}]', "more", "null",
        ]
        (cut,) = [text for text in texts if text.startswith("{")]
        assert cut.endswith('"AQI":')
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)


def test_arrays_that_are_cut_off_in_one_line(spark, file):
    text = json.dumps([{"AQI": 1}, {"AQI": 2, "Discussion": "a, {b"}, {"AQI": 3, "Discussion": "c]}"}])
    path = file(text[:-4])
    rows, rejects = split_rejects(scan_json_array(spark, path, OBSERVATION))
    assert [r.AQI for r in rows.collect()] == [1.0, 2.0]
    assert [r[CORRUPT] for r in rejects.collect()] == ['{"AQI": 3, "Discussion": "c]']


CUT = [
    ('[{"a":1},{"a":2},{"a":"x,]}', ['{"a":1}', '{"a":2}'], '{"a":"x,]}'),
    (' [ {"a":1},{"a":[1,{"b":2}]} , {"a":"q\\"u]}', ['{"a":1}', '{"a":[1,{"b":2}]}'], '{"a":"q\\"u]}'),
    ("[1, 2, 3", ["1", "2"], "3"),
    ('["x,y", "z', ["x,y"], '"z'),
    ('[{"a":1},', ['{"a":1}'], ""),
    ('[{"a":1}]', ['{"a":1}'], None),
    ("[]", [], None),
    ("[", None, None),
    ("oops", None, None),
    (None, None, None),
    ('{"a":1}', None, None),
    ('[{"a" 1},{"a":2},{', None, None),
    ('[{"a":"' + "\\n" * 50_000 + '"},{"b', ['{"a":"' + "\\n" * 50_000 + '"}'], '{"b'),
]


def test_the_entries_before_a_break(spark):
    texts = spark.createDataFrame([(text,) for text, _, _ in CUT], "body string").coalesce(1)
    found = texts.select("body", opened_array("body")).collect()
    assert [(row.body, row.texts, row.rest) for row in found] == CUT


def test_cut_off_replies_are_entries_and_a_reject(spark):
    bodies = [('[{"AQI": 1}, {"AQI": 2}, {"AQI": 3', 200), ('[{"AQI": 9}, {"AQI"', 500), ('[{"AQI": 4}]', 200), ("[]", 200)]
    replies = spark.createDataFrame(
        [(str(at), 2, status, body, None) for at, (body, status) in enumerate(bodies)],
        "url string, n_requests bigint, status int, body string, error string",
    )
    assert sorted(r.entry for r in explode_responses(replies).collect()) == ['{"AQI":1}', '{"AQI":2}', '{"AQI":4}']
    assert sorted((r.url, r.reason) for r in response_rejects(replies).collect()) == [
        ("0", 'array is cut off at: {"AQI": 3'), ("1", "HTTP 500"),
    ]
    both = sorted((r.url, r.reason or "", r.entry or "") for r in entries_or_reasons(replies).collect())
    assert both == [
        ("0", "", '{"AQI":1}'), ("0", "", '{"AQI":2}'), ("0", 'array is cut off at: {"AQI": 3', ""),
        ("1", "HTTP 500", ""), ("2", "", '{"AQI":4}'),
    ]
