"""Folders in whatever file system the session reads: look, remove, and put a written folder in the place of another.

These act on a handful of names in the driver; the data in the folders is written and read by Spark jobs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def matching(spark: SparkSession, pattern: str, folders: bool = False) -> list[str]:
    """Paths that a glob pattern matches, in order of name; only folders if asked."""
    fs, place = _at(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(place) or [] if s.isDirectory() or not folders)


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def staging(path: str, use: str = "new") -> str:
    """A hidden name beside `path`, which scans of the parent folder skip."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}.{use}.{uuid.uuid4().hex}"


def put(spark: SparkSession, written: str, path: str) -> None:
    """The folder `written` becomes `path`.  What was there steps aside first and is removed last; it comes back
    if the written folder cannot take its place."""
    fs, place = _at(spark, path)
    _, new = _at(spark, written)
    _, old = _at(spark, staging(path, "old"))
    held = fs.exists(place)
    if held and not fs.rename(place, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, place):
        if held:
            fs.rename(old, place)
        raise OSError(f"cannot move {written} to {path}")
    if held:
        fs.delete(old, True)
