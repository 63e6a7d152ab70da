"""New folders in the place that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Folders that are already marked to go when their application ends.
_MARKED: set[str] = set()
#: Setting that deletes a query's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Setting without which a join on a note and a sequence takes sides that are dealt by the note as they lie.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """What is written within shuffles no rows again that lie by a part of a join's keys, and its shuffle files are deleted when it is written."""
    was = {k: spark.conf.get(k) for k in (CLEANUP, ALL_KEYS)}
    spark.conf.set(CLEANUP, "true")
    spark.conf.set(ALL_KEYS, "false")
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def folder(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir, in a folder of this application that is deleted when its driver ends.

    Only on a local master, as in tests, may the setting be absent: then a local folder is set. Elsewhere that is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="notelake-"))
        base = context.getCheckpointDir()
    own = f"{base.rstrip('/')}/notelake-{context.applicationId}"
    if own not in _MARKED:
        path = context._jvm.org.apache.hadoop.fs.Path(own)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _MARKED.add(own)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def gone(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def state(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Names, sizes and times of the files of a table: another state of it has others."""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(at)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))
