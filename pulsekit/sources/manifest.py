"""Versioned folders behind a manifest that is published atomically.

A writer puts data into a folder of its own and then publishes a new manifest: a
numbered JSON file that maps names (a day, a panel) to folders. The file appears
under its number in one rename that fails if the number is taken, so readers see
either the old folders or the new ones, a writer that dies before it leaves the
old manifest in force, and of two writers at once the second reads the first
one's entries and tries the next number.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_FOLDER = "_manifest"


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def _fs(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly under a folder of any Hadoop file system (none if it does not exist)."""
    at = _path(spark, folder)
    fs = _fs(spark, at)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def remove(spark: SparkSession, folder: str) -> None:
    at = _path(spark, folder)
    _fs(spark, at).delete(at, True)


def _latest(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    numbers = [int(n[:-5]) for n in list_names(spark, f"{root}/{_FOLDER}") if n.endswith(".json") and n[:-5].isdigit()]
    if not numbers:
        return 0, {}
    at = _path(spark, root, _FOLDER, f"{max(numbers):012d}.json")
    stream = _fs(spark, at).open(at)
    try:
        return max(numbers), json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def read_manifest(spark: SparkSession, root: str) -> dict[str, str]:
    """The folders in force, by name; paths are relative to ``root``."""
    return _latest(spark, root)[1]


def _taken(error: Py4JJavaError) -> bool:
    return "FileAlreadyExists" in error.java_exception.getClass().getName()


def publish(spark: SparkSession, root: str, entries: dict[str, str], attempts: int = 20) -> dict[str, str]:
    """Put ``entries`` into force, leaving all other names as they are; returns the new manifest."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    for _ in range(attempts):
        number, known = _latest(spark, root)
        known |= entries
        temporary = _path(spark, root, _FOLDER, f".{uuid.uuid4().hex}.tmp")
        target = _path(spark, root, _FOLDER, f"{number + 1:012d}.json")
        out = _fs(spark, temporary).create(temporary, False)
        try:
            out.write(bytearray(json.dumps(known, sort_keys=True).encode()))
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
        plain_rename = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(_fs(spark, temporary).makeQualified(temporary), _fs(spark, target).makeQualified(target),
                           plain_rename)
            return known
        except Py4JJavaError as e:
            _fs(spark, temporary).delete(temporary, False)
            if not _taken(e):
                raise
    raise RuntimeError(f"another writer took every number of the manifest in {root}")
