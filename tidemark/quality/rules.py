"""Declared quality rules per dataset, as objects and as a table that can be kept beside the data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

CHECKS = ("schema", "nulls", "completeness", "duplicates", "range")


@dataclass(frozen=True)
class DatasetRules:
    """Checks of one dataset. ``ranges`` maps a column to its inclusive bounds.

    ``checks`` are the ones that are switched on. With ``error_rate`` the share of rows that have a critical null or
    a value outside its range is a check too, and this is the most it may be.
    """

    layer: str
    dataset: str
    required: list[str]
    critical: list[str]
    keys: list[str]
    ranges: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    null_threshold: float = 0.0
    completeness: float = 0.95
    checks: tuple[str, ...] = CHECKS
    error_rate: float | None = None


@dataclass(frozen=True)
class ReferenceRule:
    """Every key of the child must exist in the parent."""

    layer: str
    child: str
    parent: str
    child_key: str
    parent_key: str


# Columns, keys, bounds and thresholds of the standard suites.
MEASURE_BOUNDS = (0, 20_000_000)
RATE_BOUNDS = (0, 1_000_000)
ERROR_RATE = 0.05
DECLARED_RANGES = {
    "measure": MEASURE_BOUNDS,
    "total": (0, 1_000_000_000_000),
    "period": (2000, 2030),
}

# What the standard configuration declares for the entity fact.
DECLARED_RULES = DatasetRules(
    "gold", "fact_entity", ["entity_code", "period", "total"], ["entity_code", "period", "total"],
    ["entity_code", "period"], DECLARED_RANGES, error_rate=ERROR_RATE,
)

BRONZE_RULES = [
    DatasetRules(
        "bronze", name, ["entity_code", "period", "value"], ["entity_code", "period"], ["entity_code", "period"]
    )
    for name in ("measure", "rate")
] + [DatasetRules("bronze", "localities", ["entity_code", "entity_name"], ["entity_code"], ["entity_code"])]

SILVER_RULES = [
    DatasetRules(
        "silver",
        "measure",
        ["entity_code", "period", "measure"],
        ["entity_code", "period", "measure"],
        ["entity_code", "period"],
        {"measure": MEASURE_BOUNDS},
    ),
    DatasetRules(
        "silver",
        "rate",
        ["entity_code", "period", "rate"],
        ["entity_code", "period"],
        ["entity_code", "period"],
        {"rate": RATE_BOUNDS},
    ),
    DatasetRules("silver", "localities", ["entity_code", "entity_name"], ["entity_code"], ["entity_code"]),
    DatasetRules(
        "silver",
        "series",
        ["series_code", "obs_date", "value"],
        ["series_code", "obs_date", "value"],
        ["series_code", "obs_date"],
    ),
]

GOLD_RULES = [
    DatasetRules(
        "gold", "dim_entity", ["entity_key", "entity_code"], ["entity_key", "entity_code"], ["entity_key"]
    ),
    DatasetRules("gold", "dim_period", ["period_key", "period"], ["period_key", "period"], ["period_key"]),
    DatasetRules(
        "gold",
        "fact_entity",
        ["entity_key", "period_key", "total"],
        ["entity_key", "period_key"],
        ["entity_key", "period_key"],
    ),
    DatasetRules("gold", "fact_group", ["group_code", "period", "total"], ["period"], ["group_code", "period"]),
    DatasetRules("gold", "fact_nation", ["period"], ["period"], ["period"]),
]
GOLD_REFERENCES = [
    ReferenceRule("gold", "fact_entity", "dim_entity", "entity_key", "entity_key"),
    ReferenceRule("gold", "fact_entity", "dim_period", "period_key", "period_key"),
]

#: One row per rule. ``column`` is empty where a rule is about the whole dataset; ``limit`` is the most that may fail,
#: for completeness the least share of filled cells.
RULE_SCHEMA = (
    "layer string, dataset string, check string, position int, column string, low double, high double, limit double, enabled boolean"
)


def rule_table(spark: SparkSession, rules: list[DatasetRules]) -> DataFrame:
    """The rules as rows, which a user may write, change and read back with :func:`rules_from`."""
    rows = []
    for r in rules:
        declared = [("schema", c, None, None, 0.0) for c in r.required]
        declared += [("nulls", c, None, None, r.null_threshold) for c in r.critical]
        declared += [("completeness", None, None, None, r.completeness)]
        declared += [("duplicates", c, None, None, 0.0) for c in r.keys]
        declared += [("range", c, low, high, 0.0) for c, (low, high) in r.ranges.items()]
        for position, (check, column, low, high, limit) in enumerate(declared):
            bounds = [None if bound is None else float(bound) for bound in (low, high)]
            rows.append((r.layer, r.dataset, check, position, column, *bounds, float(limit), check in r.checks))
        if r.error_rate is not None:
            rows.append((r.layer, r.dataset, "error_rate", len(declared), None, None, None, r.error_rate, True))
    return spark.createDataFrame(rows, RULE_SCHEMA)


def rules_from(table: DataFrame) -> list[DatasetRules]:
    """The rules of a table as :func:`rule_table` makes it; a check is on if any of its rows is enabled.

    Rows that are switched off take their column out of the check, and a check without any row left is off. The table
    is configuration, a few rows per dataset, so the driver reads it.
    """
    rows = sorted(table.where("enabled").collect(), key=lambda r: r["position"])
    rules = []
    for layer, dataset in dict.fromkeys((r["layer"], r["dataset"]) for r in rows):
        own = [r for r in rows if (r["layer"], r["dataset"]) == (layer, dataset)]
        of = {check: [r for r in own if r["check"] == check] for check in (*CHECKS, "error_rate")}
        columns = {check: [r["column"] for r in found] for check, found in of.items()}
        limits = {check: found[0]["limit"] for check, found in of.items() if found}
        rules.append(
            DatasetRules(
                layer,
                dataset,
                columns["schema"],
                columns["nulls"],
                columns["duplicates"],
                {r["column"]: (r["low"], r["high"]) for r in of["range"]},
                limits.get("nulls", 0.0),
                limits.get("completeness", 0.95),
                tuple(check for check in CHECKS if of[check]),
                limits.get("error_rate"),
            )
        )
    return rules
