"""Folders of tables on any file system that Spark reaches: versions, and what a table's partitions are made of."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

# Spark does not read what starts with an underscore, so versions beside a
# table's own files are no part of it.
VERSIONS, COMPLETE = "_versions", "_complete"


def _open(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _open(spark, path)
    return files.exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    at, files = _open(spark, path)
    return [found.getPath().getName() for found in files.listStatus(at)] if files.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; nothing happens if it is not there."""
    at, files = _open(spark, path)
    files.delete(at, True)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name) for name in names(spark, f"{path}/{VERSIONS}") if name.isdigit())


def _complete(spark: SparkSession, path: str) -> int | None:
    done = [n for n in _numbers(spark, path) if exists(spark, f"{path}/{VERSIONS}/{n}/{COMPLETE}")]
    return done[-1] if done else None


def current(spark: SparkSession, path: str) -> str:
    """The folder whose files are the table: the newest complete version, or ``path`` itself without any."""
    newest = _complete(spark, path)
    return path if newest is None else f"{path}/{VERSIONS}/{newest}"


def next_version(spark: SparkSession, path: str) -> str:
    """A folder to write a new version to; nobody reads it before :func:`publish`."""
    return f"{path}/{VERSIONS}/{max(_numbers(spark, path), default=0) + 1}"


def publish(spark: SparkSession, version: str) -> None:
    """Make a written version the table. Creating the empty mark is the one step that readers see."""
    at, files = _open(spark, f"{version}/{COMPLETE}")
    files.create(at, True).close()


def forget_others(spark: SparkSession, path: str) -> None:
    """Delete what the newest complete version replaced, and versions that were never completed."""
    newest = _complete(spark, path)
    for number in _numbers(spark, path):
        if number != newest:
            delete(spark, f"{path}/{VERSIONS}/{number}")
    if newest is not None:
        for name in names(spark, path):
            if name != VERSIONS:
                delete(spark, f"{path}/{name}")


def folder_of(file_path: str) -> str:
    """The folder of a file that Spark names as a URI."""
    return file_path.rsplit("/", 1)[0]


def delete_uri(spark: SparkSession, uri: str) -> None:
    """Delete the folder of a URI, whose special characters are escaped."""
    at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
