"""Arrays in blocks: how many files and blocks there are, and what is read of them."""

import datetime
import json
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from hazeline import queries
from hazeline.sources import documents, list_source_files

SIZE = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def block_bytes(spark):
    before = spark.conf.get(SIZE)
    yield lambda size: spark.conf.set(SIZE, str(size))
    spark.conf.set(SIZE, before)


def test_files_grow_in_number_with_the_entries(spark, tmp_path, monkeypatch):
    rows = [
        (n, datetime.datetime(2024, 1, 1), n % 7, "view", float(n), json.dumps({"k": n})) for n in range(100)
    ]
    names = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, names).write.parquet(str(tmp_path / "events.parquet"))
    sources, transform = [], queries.plans.transform_forecasts

    def seen(spark, source, *args, **options):
        sources.append((list_source_files(spark, source).count(), int(spark.conf.get(SIZE))))
        return transform(spark, source, *args, **options)

    monkeypatch.setattr(queries.plans, "transform_forecasts", seen)
    monkeypatch.setattr(queries, "ENTRIES_PER_SPLIT_DOCUMENT", 20)
    monkeypatch.setattr(queries, "MOST_BYTES_PER_BLOCK", 1000)
    found = queries.forecasts_split_documents(spark, str(tmp_path))
    assert sources == [(5, 1000)]
    assert sorted(row.ReportingArea for row in found.collect()) == sorted(f"Area {n}" for n in range(100))


def test_lines_are_not_sorted_to_count_brackets(spark, tmp_path, plan):
    path = tmp_path / "array.json"
    path.write_text(json.dumps([{"ReportingArea": str(n)} for n in range(10)], indent=1))
    assert "SortAggregate" not in plan(documents._starts(documents._lines(spark, str(path))))


def pieces(lines, starts, batch, edges):
    """What the blocks that begin at ``starts`` make of the lines, in batches."""
    bare = [re.sub(r'"(\\\\.|[^"\\\\])*"', "", line) for line in lines]
    changes = [np.array([len(re.findall(marks, line)) for line in bare]) for marks in (r"[\[{]", r"[\]}]")]
    depth = np.concatenate([[0], np.cumsum(changes[0] - changes[1])])
    found = []
    for run, (begin, end) in enumerate(zip(starts, [*starts[1:], len(lines)])):
        block = documents._Block(run, int(depth[begin]), True, False, edges)
        for a in range(begin, end, batch):
            b = min(a + batch, end)
            found += block.lines(pa.array(lines[a:b]), changes[0][a:b], changes[1][a:b])
        found += block.end()
    return found


@pytest.mark.parametrize("separator", [",\n", "\n,", " ,\n\n", ", "])
def test_blocks_and_batches_of_any_size(separator):
    rng = random.Random(1)
    for _ in range(30):
        own = [json.dumps({"a": f'[{n}] "{{', "b": {"c": [n]}}, indent=rng.choice([None, 1])) for n in range(20)]
        lines = f"[\n{separator.join(own)}\n]\nstray\n[{own[0]}]".split("\n")
        starts = sorted({0, *rng.choices(range(len(lines)), k=rng.randrange(12))})
        batch = rng.choice([1, 2, 5, 1000])
        whole = [text for kind, _, text, _ in pieces(lines, starts, batch, False) if kind == documents.ENTRY]
        crossing, text = [], None
        for kind, _, part, _ in pieces(lines, starts, batch, True):
            assert (kind == documents.TAIL) == (text is None)
            text = part if kind == documents.TAIL else f"{text}\n{part}"
            if kind == documents.HEAD:
                crossing, text = [*crossing, text], None
        # A block may end where nothing but blanks stands between two entries.
        found = [json.loads(text) for text in [*whole, *crossing] if text.strip()]
        expected = [json.loads(text) for text in [*own, own[0]]]
        assert sorted(map(str, found)) == sorted(map(str, expected))


def test_edges_need_few_lines():
    """Between a block's first end of an entry and its last, no line is taken out of its batch."""
    taken = []

    class Column:
        def __init__(self, values):
            self.values = values

        def __getitem__(self, at):
            taken.append(at)
            return pa.scalar(self.values[at])

        def slice(self, at):
            taken.extend(range(at, len(self.values)))
            return pa.array(self.values[at:])

    lines = ["{", '"a": 1', "},"] * 1000
    opened, closed = (np.array([line.count(mark) for line in lines]) for mark in "{}")
    block = documents._Block(0, 1, True, False, True)
    block.begun_before = False
    assert list(block.lines(Column(lines), opened, closed)) == []
    assert len(taken) < 10
    assert [piece[2] for piece in block.end()] == [""]


@pytest.mark.parametrize(("first", "is_array"), [("\ufeff \t[", True), ("\n\n[", True), ("\0[", False), ("x[", False), (" {", False)])
def test_the_first_character_tells(spark, tmp_path, block_bytes, first, is_array):
    path = tmp_path / "array.json"
    path.write_text(first + "\n{}\n" * 10 + "]", encoding="utf-8")
    block_bytes(40)
    found = documents._starts(documents._lines(spark, str(path))).collect()
    assert len(found) > 1 and {row.is_array for row in found} == {is_array}
