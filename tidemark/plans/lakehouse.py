"""The standard three layers as job lists for ``run_layer``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import audit_columns
from tidemark.plans import clean, incremental, model
from tidemark.plans.run import FullRun, Job, Lake, Layer, Whole, run_layers
from tidemark.quality.rules import BRONZE_RULES, GOLD_REFERENCES, GOLD_RULES, SILVER_RULES
from tidemark.sinks.jdbc import JdbcTarget, export_all
from tidemark.sinks.retention import expire
from tidemark.sources import Landing
from tidemark.sources.selection import pick_periods
from tidemark.staging import Staging

# Periods taken when none is chosen.
MEASURE_PERIODS = [202201, 202210, 2024]
RATE_PERIODS = list(range(2010, 2022))


def bronze_jobs(
    sources: dict[str, object],
    measure_period: int | list[int] | None = 2024,
    rate_period: int | list[int] | None = 2021,
    entities_enabled: bool = True,
    processed_at: dt.datetime | None = None,
) -> list[Job]:
    """Landing jobs. ``sources`` maps localities, measure, rate and series to functions of the lake.

    A period is one value, a list, or None for the usual list. A function may return a ``Landing``, whose counts of what
    it leaves out go into the run report; a further entry such as ``series_rejects`` does the same for plain rows.
    """

    def landed(name: str, pick=None):
        def build(lake: Lake) -> DataFrame | Landing:
            found = sources[name](lake)
            df = found.rows if isinstance(found, Landing) else found
            rows = audit_columns(pick(df) if pick else df, processed_at)
            return Landing(rows, found.rejects) if isinstance(found, Landing) else rows

        return build

    def picked(chosen, usual):
        single, several = (None, chosen) if isinstance(chosen, list) else (chosen, usual)
        return lambda df: pick_periods(df, "period", single, several)

    measures, rates = picked(measure_period, MEASURE_PERIODS), picked(rate_period, RATE_PERIODS)

    return [
        Job("localities", landed("localities"), entities_enabled, rejects=sources.get("localities_rejects")),
        Job("measure", landed("measure", measures), entities_enabled, rejects=sources.get("measure_rejects")),
        Job("rate", landed("rate", rates), entities_enabled, rejects=sources.get("rate_rejects")),
        Job("series", landed("series"), rejects=sources.get("series_rejects")),
    ]


def silver_jobs(entities_enabled: bool = True, rate_type: str = clean.RATE_TYPE, landed: list[int] | None = None) -> list[Job]:
    """Cleaning jobs over the bronze tables.

    ``landed`` names the periods of an incremental run: only their partitions are read, cleaned and replaced.
    """

    def raw(lake: Lake, name: str) -> DataFrame:
        df = lake.read("bronze", name)
        return df if landed is None else df.filter(F.col("period").isin(landed))

    return [
        Job("localities", lambda lake: clean.clean_localities(lake.read("bronze", "localities")), entities_enabled, ["bronze/localities"]),
        Job("measure", lambda lake: clean.clean_measure(raw(lake, "measure")), entities_enabled, ["bronze/measure"]),
        Job("rate", lambda lake: clean.clean_rate(raw(lake, "rate"), rate_type), entities_enabled, ["bronze/rate"]),
        Job("series", lambda lake: clean.clean_series(lake.read("bronze", "series")), True, ["bronze/series"]),
    ]


def gold_jobs(
    staging: Staging,
    series_names: list[str],
    entities_enabled: bool = True,
    enrich: bool = False,
    as_of: dt.date | None = None,
    landed: list[int] | None = None,
    by_period: bool = False,
) -> list[Job]:
    """Modelling jobs; without entity data the national fact comes from the series alone.

    With ``by_period`` the entity and the group fact are partitioned by period, and a run that landed a few periods
    builds and replaces only the partitions that these change.
    """

    def periods(lake: Lake) -> DataFrame:
        tables = [lake.find("silver", n) for n in ("measure", "rate")] if entities_enabled else []
        found = [t for t in tables if t is not None]
        return model.dim_period(lake.spark, found, lake.find("silver", "series"), as_of=as_of)

    def keys(lake: Lake) -> DataFrame:
        return model.entity_keys(lake.read("silver", "localities"), lake.find("gold", "entity_keys"), staging)

    def entities(lake: Lake) -> DataFrame:
        return model.dim_entity(lake.read("silver", "localities"), staging, lake.read("gold", "entity_keys"))

    def old(lake: Lake, name: str) -> DataFrame | None:
        """The fact as it is, if only some of its partitions need to be built again."""
        found = [lake.find("gold", n) for n in (name, "fact_basis")] if by_period and landed is not None else [None]
        if any(table is None for table in found):
            return None
        return found[0] if found[1].first() == incremental.basis(lake.read("gold", "dim_entity")).first() else None

    def entity_fact(lake: Lake) -> DataFrame | Whole:
        measure, rate = lake.read("silver", "measure"), lake.read("silver", "rate")
        dimension, spine, before = lake.read("gold", "dim_entity"), lake.read("gold", "dim_period"), old(lake, "fact_entity")
        if before is None:
            return Whole(model.fact_entity(measure, rate, dimension, spine, staging))
        after = measure.select("entity_code", "period").unionByName(rate.select("entity_code", "period"))
        dirty = incremental.touched_periods(before, after, "entity_code", landed)
        dirty = sorted({*dirty, *incremental.moved_periods(before, spine)})
        return incremental.fact_entity_of(before, measure, rate, dimension, spine, landed, dirty, staging)

    def group_fact(lake: Lake) -> DataFrame | Whole:
        fact, dimension, before = lake.read("gold", "fact_entity"), lake.read("gold", "dim_entity"), old(lake, "fact_group")
        if before is None:
            return Whole(model.fact_group(fact, dimension, staging))
        return incremental.fact_group_of(before, fact, dimension, landed, staging)

    def nation(lake: Lake) -> DataFrame:
        if not entities_enabled:
            spine, series = lake.read("gold", "dim_period"), lake.read("silver", "series")
            return model.fact_nation_from_series(spine, series, series_names)
        fact = model.fact_nation(lake.read("gold", "fact_group"))
        return model.nation_enriched(fact, lake.read("silver", "series"), series_names) if enrich else fact

    layout = ["period"] if by_period else []
    measures = ["silver/measure", "silver/rate"]
    national = ["fact_group", *(["silver/series"] if enrich else [])] if entities_enabled else ["dim_period", "silver/series"]
    jobs = [
        Job("entity_keys", keys, entities_enabled, ["silver/localities"], mode="append"),
        Job("dim_entity", entities, entities_enabled, ["silver/localities", "entity_keys"]),
        Job("dim_period", periods, needs=measures if entities_enabled else [], uses=["silver/series"]),
        Job("fact_entity", entity_fact, entities_enabled, [*measures, "dim_entity", "dim_period"], partition_by=layout),
        Job("fact_group", group_fact, entities_enabled, ["fact_entity", "dim_entity"], partition_by=layout),
        Job("fact_nation", nation, True, national),
    ]
    if by_period:
        basis = Job("fact_basis", lambda lake: incremental.basis(lake.read("gold", "dim_entity")), entities_enabled, ["fact_group"])
        jobs.append(basis)
    return jobs


def run_all(
    lake: Lake,
    sources: dict[str, object],
    series_names: list[str],
    measure_period: int | list[int] | None = 2024,
    rate_period: int | list[int] | None = 2021,
    entities_enabled: bool = True,
    enrich: bool = False,
    rate_type: str = clean.RATE_TYPE,
    processed_at: dt.datetime | None = None,
    target: JdbcTarget | None = None,
    checks_enabled: bool = True,
    landed: list[int] | None = None,
    retention_as_of: dt.date | None = None,
    gold_by_period: bool = False,
) -> FullRun:
    """Bronze, silver and gold, each followed by its checks unless these are off; then the export, if a target is given.

    The datasets of all layers are one graph: whatever a failed source reaches is skipped, and the tables of earlier
    runs never stand in for it. ``landed`` cleans only these periods, and with ``gold_by_period`` models only what they
    change; a run that did not finish is repeated with the same periods. With ``retention_as_of`` the raw and the clean
    layer lose the rows past their time at the end of the run. A failed export is recorded and does not fail the run.
    """
    staging = Staging(lake.spark)
    layers = [
        Layer("bronze", bronze_jobs(sources, measure_period, rate_period, entities_enabled, processed_at), BRONZE_RULES),
        Layer("silver", silver_jobs(entities_enabled, rate_type, landed), SILVER_RULES),
        Layer("gold", gold_jobs(staging, series_names, entities_enabled, enrich, None, landed, gold_by_period), GOLD_RULES, GOLD_REFERENCES),
    ]
    try:
        run = FullRun(run_layers(lake, layers, checks_enabled))
    finally:
        staging.clear()
    if retention_as_of is not None:
        for layer in ("bronze", "silver"):
            for dataset in ("localities", "measure", "rate", "series"):
                expire(lake.spark, lake.path(layer, dataset), layer, retention_as_of)
    if target is not None:
        try:
            run.export = export_all(lake.spark, lambda name: lake.find("gold", name), target)
        except Exception as error:  # the lake is complete without the export
            run.export_error = str(error)
    return run
