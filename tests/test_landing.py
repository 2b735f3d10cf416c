"""Files that are landed byte by byte."""

import gzip
import hashlib
import random

import pytest

from hazeline.sources import land_files, scan_gz_text, scan_stations

LINE = "Área|CA|US|Yes||33.61|-117.69|-8.0|Yes|PST|PDT|AAA|No|Src"


def contents():
    rng = random.Random(6)
    noise = bytes(rng.randrange(256) for _ in range(5_000))
    return {
        "plain.dat": (LINE + "\n").encode() * 60,
        "no break at the end.dat": "\n".join([LINE] * 60).encode(),
        "mark.dat": b"\xef\xbb\xbf" + (LINE + "\n").encode() * 60,
        "mark and no break.dat": b"\xef\xbb\xbf" + "\n".join([LINE] * 60).encode("latin-1"),
        "windows.dat": (LINE + "\r\n").encode("latin-1") * 60 + b"x",
        "latin é.dat": (LINE + "\n").encode("latin-1") * 40,
        "blank lines.dat": b"\n" * 400,
        "one byte.dat": b"\xff",
        "one break.dat": b"\n",
        "only a mark.dat": b"\xef\xbb\xbf",
        "empty.dat": b"",
        "noise.bin": noise,
        "noise that ends in a break.bin": noise + b"\n",
        "packed.gz": gzip.compress((LINE + "\n").encode() * 60, mtime=0),
        "noise.gz": gzip.compress(noise, mtime=0),
        "empty.gz": b"",
        "x=1%2.dat": b"a\nb",
    }


def landed(place):
    """The bytes of a file, or of the pieces in a folder."""
    if place.is_file():
        return place.read_bytes()
    return b"".join(piece.read_bytes() for piece in sorted(place.glob("part-*")))


@pytest.mark.parametrize("size", [150, 1 << 27])
def test_every_byte_arrives(spark, tmp_path, size):
    source, target = tmp_path / "source", tmp_path / "target"
    source.mkdir()
    for name, data in contents().items():
        (source / name).write_bytes(data)
    previous = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        for _ in range(2):
            land_files(spark, str(source), str(target))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", previous)
    found = {place.name: place for place in target.iterdir() if not place.name.startswith(".")}
    assert found.keys() == contents().keys()
    for name, data in contents().items():
        assert hashlib.sha256(landed(found[name])).digest() == hashlib.sha256(data).digest(), name
    # Large files were copied in ranges, small ones are files again.
    assert (size == 150) == found["plain.dat"].is_dir()
    assert found["packed.gz"].is_file()
    assert scan_gz_text(spark, str(found["packed.gz"])).count() == 60
    assert scan_stations(spark, str(found["plain.dat"])).count() == 60
    assert [place.name for place in tmp_path.iterdir() if place.name.startswith("_")] == []


def test_files_of_one_name_are_refused(spark, tmp_path):
    for folder in "ab":
        (tmp_path / "s" / folder).mkdir(parents=True)
        (tmp_path / "s" / folder / "same").write_text(folder)
    with pytest.raises(ValueError, match="same name"):
        land_files(spark, f"{tmp_path}/s/*", str(tmp_path / "t"))


def test_a_single_file(spark, tmp_path):
    (tmp_path / "stations.dat").write_text(LINE)
    land_files(spark, str(tmp_path / "stations.dat"), str(tmp_path / "target"))
    assert (tmp_path / "target" / "stations.dat").read_text() == LINE
