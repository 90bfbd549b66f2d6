"""Intermediate tables in the folder that all executors share.

A table that several later steps read, or whose generated row ids must never
be recomputed, is written once and read back. The written files survive the
loss of any executor, and Spark knows their true size when it plans joins.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
_collecting: list[list[Staging]] = []


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def at_once(steps: dict[str, Callable[[], object]]) -> dict[str, object]:
    """Run independent steps at the same time, each of which may start Spark jobs; the first error is raised."""
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        return dict(zip(steps, pool.map(lambda step: step(), steps.values()), strict=True))


@contextmanager
def collected() -> Iterator[list[Staging]]:
    """Lists the folders that are opened meanwhile, so that a caller can delete them once its result is written."""
    opened: list[Staging] = []
    _collecting.append(opened)
    try:
        yield opened
    finally:
        _collecting.remove(opened)


class Staging:
    """One run's own folder under the shared root."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.path = f"{root or shared_root(spark)}/staging-{uuid.uuid4().hex}"
        for opened in _collecting:
            opened.append(self)

    def below(self, name: str) -> Staging:
        """A folder of its own within this one, for tables that are deleted earlier."""
        return Staging(self.spark, f"{self.path}/{name}")

    def freeze(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the written table."""
        target = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def freeze_all(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Freeze independent tables at the same time, so that small jobs overlap."""
        return at_once({name: lambda name=name, df=df: self.freeze(df, name) for name, df in tables.items()})

    def folder(self, name: str) -> str:
        """A fresh path below this run's folder."""
        return f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"

    def clear(self) -> None:
        """Delete this run's folder once nothing reads its tables any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
