"""Moving and deleting on any Hadoop file system, from the driver; only names, never contents."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path as it knows it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _open(spark, path)
    return system.exists(place)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder that Spark's scans would read; none if there is no such folder."""
    system, place = _open(spark, folder)
    if not system.exists(place):
        return []
    found = [status.getPath().getName() for status in system.listStatus(place)]
    return sorted(name for name in found if not name.startswith(("_", ".")))


def listing(spark: SparkSession, pattern: str) -> list[tuple[str, int, str]]:
    """Path, length and URI of the files that a pattern names, and of those in folders that it names."""
    system, place = _open(spark, pattern)
    found = []
    for status in system.globStatus(place) or ():
        inside = system.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [
            # Spark's file_path writes local URIs with one slash.
            (file.getPath().toString(), file.getLen(), re.sub("^file:/+", "file:/", file.getPath().toUri().toString()))
            for file in inside if not file.isDirectory()
        ]
    return sorted(file for file in found if not file[0].rpartition("/")[2].startswith(("_", ".")))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    system, place = _open(spark, path)
    return system.getContentSummary(place).getLength()


def create(spark: SparkSession, path: str, few: bytes = b"") -> None:
    """Make an empty file, or one of a few bytes."""
    system, place = _open(spark, path)
    stream = system.create(place)
    stream.write(bytearray(few))
    stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if there is none."""
    system, place = _open(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename, making the folder above the target; the target must not be there."""
    system, place = _open(spark, source)
    _, other = _open(spark, target)
    system.mkdirs(other.getParent())
    if system.exists(other) or not system.rename(place, other):
        raise OSError(f"cannot move {source} to {target}")


def beside(path: str, word: str) -> str:
    """A fresh path in the same folder that Spark's scans of this folder leave out."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_{name}.{word}-{uuid.uuid4().hex}" if folder else f"_{name}.{word}-{uuid.uuid4().hex}"


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Put ``source`` where ``target`` is, and delete what that held.

    What was there is moved aside first, and back if ``source`` can't take its place.
    """
    target = target.rstrip("/")
    old = beside(target, "old")
    there = exists(spark, target)
    if there:
        move(spark, target, old)
    try:
        move(spark, source, target)
    except BaseException:
        if there:
            move(spark, old, target)
        raise
    if there:
        delete(spark, old)


def restore(spark: SparkSession, path: str) -> bool:
    """Bring back what a driver that died within ``replace`` had moved aside; whether there was any.

    For a path with nothing at it. Leftovers next to a path that is there are deleted.
    """
    path = path.rstrip("/")
    system, place = _open(spark, path)
    folder = place.getParent()
    if not system.exists(folder):
        return False
    prefix = f"_{place.getName()}."
    left = [status.getPath() for status in system.listStatus(folder) if status.getPath().getName().startswith(prefix)]
    old = [name for name in left if name.getName().startswith(f"{prefix}old-")]
    found = bool(old) and not system.exists(place)
    if found:
        system.rename(old.pop(), place)
    for name in left:
        system.delete(name, True)
    return found
