"""Layer runs: build, write, check and report each dataset of the layers.

Every dataset names what it reads, so the datasets are a graph over all layers:
one starts as soon as its reads are written, independent ones run at the same
time, and one whose read failed is skipped, wherever that read is. The driver
handles the few datasets; all work on rows is Spark jobs.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.quality.rules import DatasetRules, ReferenceRule
from tidemark.quality.suites import RESULT_SCHEMA, layer_checks, summarize
from tidemark.sinks import folders
from tidemark.sinks.parquet import layout_of, write_table
from tidemark.sources import Landing

REPORT_SCHEMA = "layer string, dataset string, status string, rows bigint, seconds double, message string"


@dataclass
class Lake:
    """Paths of the three layers under one base path. ``hidden`` datasets (``layer/dataset``) are as if never written."""

    spark: SparkSession
    base: str
    hidden: frozenset[str] = frozenset()

    def path(self, layer: str, dataset: str) -> str:
        """Where the table lives, with all its versions."""
        return f"{self.base.rstrip('/')}/{layer}/{dataset}"

    def folder(self, layer: str, dataset: str) -> str:
        """The folder whose files are the table now: to be read, and written to by partition."""
        return folders.current(self.spark, self.path(layer, dataset))

    def read(self, layer: str, dataset: str) -> DataFrame:
        if f"{layer}/{dataset}" in self.hidden:
            raise ValueError(f"{layer}/{dataset} failed in this run")
        return self.spark.read.parquet(self.folder(layer, dataset))

    def find(self, layer: str, dataset: str) -> DataFrame | None:
        """The table, or None if it was never written; a broken one raises."""
        there = f"{layer}/{dataset}" not in self.hidden and folders.exists(self.spark, self.path(layer, dataset))
        return self.read(layer, dataset) if there else None


@dataclass
class Whole:
    """Rows that replace a partitioned table as a whole, also the partitions that have none of them."""

    rows: DataFrame


@dataclass
class Job:
    """How to build one dataset.

    ``needs`` names the datasets that it reads and cannot do without, ``uses`` those that it reads if they are there;
    a name is one of this layer or ``layer/dataset``. ``rejects`` counts what the landing leaves out; its
    counts, or those of a ``Landing``, go into the message of the report row. ``partition_by`` replaces the layout of the layer; mode ``append``
    adds rows to the table instead of replacing it or its partitions.
    """

    dataset: str
    build: Callable[[Lake], DataFrame | Whole | Landing]
    enabled: bool = True
    needs: list[str] = field(default_factory=list)
    rejects: Callable[[Lake], DataFrame] | None = None
    uses: list[str] = field(default_factory=list)
    partition_by: list[str] | None = None
    mode: str = "overwrite"


@dataclass
class Layer:
    """The jobs of a layer and the checks of its tables."""

    name: str
    jobs: list[Job]
    rules: list[DatasetRules]
    references: list[ReferenceRule] = field(default_factory=list)


def _rejected(counts: DataFrame | None) -> str | None:
    """Sums of the counts, one row at most leaves Spark."""
    if counts is None:
        return None
    numbers = [f.name for f in counts.schema.fields if f.dataType.typeName() == "long"]
    sums = counts.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in numbers]).first()
    return ", ".join(f"{n}: {sums[n]}" for n in numbers)


@dataclass
class LayerRun:
    """Written tables, one report row per dataset, and the check results."""

    tables: dict[str, DataFrame]
    report: list[tuple]
    checks: DataFrame
    pass_rate: float | None

    @property
    def failures(self) -> list[str]:
        """Datasets that failed, or were skipped for one that did."""
        return [r[1] for r in self.report if r[2] in ("failed", "skipped")]

    @property
    def rows(self) -> int:
        return sum(r[3] or 0 for r in self.report)


def run_layer(
    lake: Lake,
    layer: str,
    jobs: list[Job],
    rules: list[DatasetRules],
    references: list[ReferenceRule] | None = None,
    checks_enabled: bool = True,
) -> LayerRun:
    """One layer alone; what its jobs read of other layers is taken as it was written before."""
    return run_layers(lake, [Layer(layer, jobs, rules, references or [])], checks_enabled)[0]


def run_layers(lake: Lake, layers: list[Layer], checks_enabled: bool = True, at_once: int = 4) -> list[LayerRun]:
    """Build all datasets, ``at_once`` of them together, then check the written tables of each layer.

    A dataset starts once all that it reads in this run is written. It is skipped if one that it needs failed, was
    skipped or is switched off. One that it only uses is hidden from it then: no table of an older run passes for
    new. Checks and later jobs read what was written, so nothing is computed twice. A failure stops nothing but what depends on it. Each
    dataset's Spark jobs are a job group named after it. Only the partitions that its rows belong to are replaced.
    """
    run = _Run(lake, layers, checks_enabled)
    waiting = [(layer.name, job) for layer in layers for job in layer.jobs]
    unchecked, checks = list(layers), {}
    pending: set[Future] = set()
    with ThreadPoolExecutor(at_once) as pool:
        while waiting or unchecked or pending:
            before = len(waiting) + len(unchecked)
            for name, job in list(waiting):
                verdict = run.verdict(name, job)
                if verdict == "start":
                    pending.add(pool.submit(run.build, name, job))
                if verdict != "wait":
                    waiting.remove((name, job))
            for layer in list(unchecked):
                if run.closed(layer):
                    checks[layer.name] = pool.submit(run.check, layer)
                    pending.add(checks[layer.name])
                    unchecked.remove(layer)
            if not pending and before == len(waiting) + len(unchecked):
                raise ValueError(f"datasets wait for each other: {[job.dataset for _, job in waiting]}")
            done, pending = wait(pending, return_when=FIRST_COMPLETED)
            for future in done:
                future.result()
    return [run.result(layer, checks[layer.name].result()) for layer in layers]


def _paths(layer: str, names: list[str]) -> list[str]:
    return [name if "/" in name else f"{layer}/{name}" for name in names]


class _Run:
    """What became of each dataset of a run so far."""

    def __init__(self, lake: Lake, layers: list[Layer], checks_enabled: bool):
        self.lake, self.checks_enabled = lake, checks_enabled
        self.known = {f"{layer.name}/{job.dataset}" for layer in layers for job in layer.jobs}
        self.status: dict[str, str] = {}
        self.tables: dict[str, DataFrame] = {}
        self.rows: dict[str, tuple] = {}

    def verdict(self, layer: str, job: Job) -> str:
        """Whether a dataset can start, has to wait, or is closed without being built."""
        if not job.enabled:
            self.close(layer, job, "disabled")
            return "closed"
        needs, uses = ([r for r in _paths(layer, names) if r in self.known] for names in (job.needs, job.uses))
        if lost := [r for r in needs if self.status.get(r) in ("failed", "skipped", "disabled")]:
            names = ", ".join(r.removeprefix(f"{layer}/") for r in lost)
            self.close(layer, job, "skipped", f"needs {names}")
            return "closed"
        return "start" if all(r in self.status for r in needs + uses) else "wait"

    def closed(self, layer: Layer) -> bool:
        return all(f"{layer.name}/{job.dataset}" in self.status for job in layer.jobs)

    def close(self, layer: str, job: Job, status: str, message: str | None = None, rows: int | None = None, seconds: float = 0.0) -> None:
        path = f"{layer}/{job.dataset}"
        self.rows[path] = (layer, job.dataset, status, rows, seconds, message)
        self.status[path] = status

    def build(self, layer: str, job: Job) -> None:
        started = time.monotonic()
        self.lake.spark.sparkContext.setJobGroup(f"{layer}/{job.dataset}", f"build {layer}/{job.dataset}")
        try:
            stale = frozenset(path for path, status in self.status.items() if status in ("failed", "skipped"))
            built = job.build(replace(self.lake, hidden=stale))
            whole = isinstance(built, Whole)
            df = built.rows if isinstance(built, Whole | Landing) else built
            rejects = built.rejects if isinstance(built, Landing) else job.rejects and job.rejects(self.lake)
            layout = layout_of(layer, df) if job.partition_by is None else job.partition_by
            rows = write_table(df, self.lake.folder(layer, job.dataset), job.mode, layout, full=whole)
            self.tables[f"{layer}/{job.dataset}"] = self.lake.read(layer, job.dataset)
            self.close(layer, job, "done", _rejected(rejects), rows, time.monotonic() - started)
        except Exception as error:  # one dataset must not stop the others
            self.close(layer, job, "failed", str(error), seconds=time.monotonic() - started)

    def check(self, layer: Layer) -> list:
        """Results of the layer's checks: one row per declared check, so they are kept as they are."""
        self.lake.spark.sparkContext.setJobGroup(layer.name, f"check {layer.name}")
        return layer_checks(self.lake.spark, self.written(layer), layer.rules, layer.references, self.checks_enabled).collect()

    def written(self, layer: Layer) -> dict[str, DataFrame]:
        paths = {job.dataset: f"{layer.name}/{job.dataset}" for job in layer.jobs}
        return {dataset: self.tables[path] for dataset, path in paths.items() if path in self.tables}

    def result(self, layer: Layer, results: list) -> LayerRun:
        checks = self.lake.spark.createDataFrame(results, RESULT_SCHEMA)
        report = [self.rows[f"{layer.name}/{job.dataset}"] for job in layer.jobs]
        return LayerRun(self.written(layer), report, checks, summarize(checks).first()["pass_rate"] if results else None)


def report_frame(spark: SparkSession, runs: list[LayerRun]) -> DataFrame:
    """Report rows of all layers."""
    return spark.createDataFrame([row for run in runs for row in run.report], REPORT_SCHEMA)


@dataclass
class FullRun:
    """All layers, and the export status if an export was asked for."""

    layers: list[LayerRun]
    export: DataFrame | None = None
    export_error: str | None = None

    def overall(self) -> dict:
        """Rows over all layers, mean pass rate of the checked ones, and whether the export went through."""
        rates = [layer.pass_rate for layer in self.layers if layer.pass_rate is not None]
        exported = None
        if self.export_error is not None:
            exported = False
        elif self.export is not None:
            exported = self.export.filter(~F.col("exported")).isEmpty()
        return {
            "total_rows": sum(layer.rows for layer in self.layers),
            "mean_pass_rate": round(sum(rates) / len(rates), 2) if rates else None,
            "exported": exported,
        }
