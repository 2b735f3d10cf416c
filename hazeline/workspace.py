"""Where intermediate tables live."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

from hazeline import files


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    A local session without that setting gets a temporary folder of its own; on a cluster a
    machine-local folder would lose data, so a missing setting is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"hazeline-{application}-")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[str], str]]:
    """Gives paths for the intermediate tables of one job, and deletes them all at its end, also if it fails.

    What the job returns must not read them any more.
    """
    folder = fresh_path(spark, "job")
    try:
        yield lambda name: f"{folder}/{name}-{uuid.uuid4().hex}"
    finally:
        files.delete(spark, folder)
