"""Tables that are replaced as a whole or not at all."""

import pytest
from pyspark.sql import functions as F

from hazeline import files
from hazeline.sinks import write_entries, write_json_array, write_json_lines, write_table
from hazeline.sources import land_raw, scan_table


def broken(spark, column="entry"):
    """Rows of which a late one can't be computed."""
    return spark.range(0, 1000, 1, 4).select(
        F.when(F.col("id") == 990, F.raise_error(F.lit("broken row"))).otherwise(F.col("id").cast("string")).alias(column)
    )


def good(spark):
    return spark.range(3).select(F.col("id").cast("string").alias("entry"))


@pytest.mark.parametrize("write", [write_table, write_entries, write_json_lines, write_json_array])
def test_a_write_that_fails_leaves_the_old_rows(spark, tmp_path, write):
    target = tmp_path / "folder" / "target"
    write(good(spark), str(target))
    before = {path.name: path.read_bytes() for path in target.iterdir()}
    with pytest.raises(Exception, match="broken row"):
        write(broken(spark), str(target))
    assert {path.name: path.read_bytes() for path in target.iterdir()} == before
    assert [path.name for path in target.parent.iterdir()] == ["target"]
    write(good(spark).limit(1), str(target))
    assert [path.name for path in target.parent.iterdir()] == ["target"]
    with pytest.raises(Exception, match="broken row"):
        write(broken(spark), str(tmp_path / "new"))
    assert not (tmp_path / "new").exists()


def test_a_table_can_be_written_over_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(10), path)
    write_table(scan_table(spark, path).filter("id > 6"), path)
    assert sorted(r.id for r in scan_table(spark, path).collect()) == [7, 8, 9]
    write_table(scan_table(spark, path).filter("id > 100"), path + "/")
    assert scan_table(spark, path).count() == 0
    write_table(spark.range(2), path, mode="append")
    write_table(spark.range(2), path, mode="append", files=1)
    assert scan_table(spark, path).count() == 4


def test_landing_a_file_that_can_not_be_read_keeps_the_old_one(spark, tmp_path):
    source, target = tmp_path / "source", str(tmp_path / "target")
    source.write_text("a\nb\n")
    land_raw(spark, str(source), target)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        land_raw(spark, str(tmp_path / "missing"), target)
    assert spark.read.text(target).count() == 2


def test_what_can_not_take_its_place_brings_the_old_back(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    with pytest.raises(Exception):
        files.replace(spark, str(tmp_path / "missing"), path)
    assert scan_table(spark, path).count() == 3


def test_a_driver_that_died_between_the_two_moves(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not files.restore(spark, str(tmp_path / "no" / "folder"))
    write_table(spark.range(3), path)
    files.move(spark, path, files.beside(path, "old"))
    write_table(spark.range(5), files.beside(path, "new"))
    assert files.restore(spark, path)
    assert scan_table(spark, path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    assert not files.restore(spark, path)


def test_moves_replace_nothing(spark, tmp_path):
    for name in "ab":
        (tmp_path / name).write_text(name)
    with pytest.raises(OSError):
        files.move(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    files.delete(spark, str(tmp_path / "missing"))
    assert files.exists(spark, str(tmp_path / "a")) and not files.exists(spark, str(tmp_path / "c"))
