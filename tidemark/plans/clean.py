"""Cleaning of landed tables. Bounds are applied before dedupe, so a bad copy never wins."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    cast_columns,
    code_prefix,
    parse_date,
    parse_decimal,
    standard_name,
    year_month,
)
from tidemark.functions.predicates import drop_missing, within_open
from tidemark.operators.dedupe import keep_latest
from tidemark.quality.rules import MEASURE_BOUNDS, RATE_BOUNDS

LOCALITY_NAMES = ["entity_name", "group_name", "group_short", "region_name", "region_short"]


def clean_values(df: DataFrame, name: str, type_: str, bounds: tuple[float, float]) -> DataFrame:
    """Typed, bounded, deduplicated values per entity and period, with the group code."""
    typed = df.select(
        F.col("entity_code").cast("string").alias("entity_code"),
        standard_name("entity_name").alias("entity_name"),
        F.col("period").try_cast("int").alias("period"),
        F.col("value").try_cast(type_).alias(name),
        "processed_at",
        "load_date",
    )
    valid = drop_missing(typed, ["entity_code", "period"]).filter(within_open(name, *bounds))
    latest = keep_latest(valid, ["entity_code", "period"], "processed_at")
    return latest.select(
        "entity_code",
        "entity_name",
        code_prefix("entity_code").alias("group_code"),
        "period",
        name,
        "processed_at",
        "load_date",
    )


def clean_measure(df: DataFrame) -> DataFrame:
    """Measure (population) as bigint."""
    return clean_values(df, "measure", "bigint", MEASURE_BOUNDS)


# The default keeps sums exact, so that they do not depend on row order.
RATE_TYPE = "decimal(18,4)"


def clean_rate(df: DataFrame, type_: str = RATE_TYPE) -> DataFrame:
    """Rate (GDP per head)."""
    return clean_values(df, "rate", type_, RATE_BOUNDS)


def clean_localities(df: DataFrame) -> DataFrame:
    """One row per entity with text codes and standard names."""
    codes = ["entity_code", "group_code", "region_code"]
    named = df.withColumns(
        {c: F.col(c).cast("string") for c in codes} | {c: standard_name(c) for c in LOCALITY_NAMES}
    )
    return keep_latest(drop_missing(named, ["entity_code"]), ["entity_code"], "processed_at").select(
        "entity_code",
        "entity_name",
        "group_code",
        "group_short",
        "group_name",
        "region_code",
        "region_name",
        "region_short",
        "processed_at",
        "load_date",
    )


def clean_series(df: DataFrame, min_year: int | None = None) -> DataFrame:
    """All series in one table, one row per series and date."""
    parsed = df.withColumns(
        {"obs_date": parse_date("obs_date", "date_text"), "value": parse_decimal("value", "value_text")}
    )
    valid = drop_missing(year_month(parsed, "obs_date"), ["obs_date", "value"])
    if min_year is not None:
        valid = valid.filter(F.col("year") >= min_year)
    return keep_latest(valid, ["series_code", "obs_date"], "processed_at").select(
        "series_code",
        "series_name",
        "date_text",
        "obs_date",
        "year",
        "month",
        "value_text",
        "value",
        "source",
        "processed_at",
        "load_date",
    )


@dataclass(frozen=True)
class CleaningRules:
    """Declared cleaning: renames, casts, mandatory columns, trimming, standard names."""

    renames: dict[str, str] = field(default_factory=dict)
    types: dict[str, str] = field(default_factory=dict)
    not_null: list[str] = field(default_factory=list)
    trim: bool = False
    standard_names: list[str] = field(default_factory=list)


# The default declared rules.
DEFAULT_RULES = CleaningRules(
    renames={"Municípios": "municipio", "Valor": "valor", "Ano": "ano"},
    types={"codigo_municipio": "string", "valor": "double", "ano": "int"},
    not_null=["codigo_municipio", "ano"],
    trim=True,
    standard_names=["municipio"],
)


def apply_rules(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """Apply the declared rules to the columns the table has."""
    out = df.withColumnsRenamed(rules.renames)
    out = cast_columns(out, {c: t for c, t in rules.types.items() if c in out.columns})
    if rules.trim:
        texts = [f.name for f in out.schema.fields if f.dataType.simpleString() == "string"]
        out = out.withColumns({c: F.trim(c) for c in texts})
    out = out.withColumns({c: standard_name(c) for c in rules.standard_names if c in out.columns})
    present = [c for c in rules.not_null if c in out.columns]
    return drop_missing(out, present) if present else out
