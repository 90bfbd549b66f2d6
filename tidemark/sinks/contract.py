"""Target table contracts: column types and keys of the SQL tables."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Contract:
    """SQL types in column order, mandatory columns, primary key, foreign keys to (table, column)."""

    types: dict[str, str]
    required: list[str]
    key: list[str]
    foreign: dict[str, tuple[str, str]] = field(default_factory=dict)

    def with_lengths(self, **lengths: int) -> Contract:
        """The same contract with other text lengths."""
        return self.with_types(**{name: f"varchar({n})" for name, n in lengths.items()})

    def with_types(self, **types: str) -> Contract:
        """The same contract with other column types, for a table whose columns were altered."""
        return replace(self, types=self.types | types)


class ContractBroken(ValueError):
    """Rows do not fit their target table; the message counts them per column."""


# Column types and keys of the target tables.
CONTRACTS = {
    "dim_entity": Contract(
        {
            "entity_key": "bigint",
            "entity_code": "varchar(7)",
            "entity_name": "varchar(200)",
            "group_code": "varchar(2)",
            "group_short": "varchar(2)",
            "group_name": "varchar(100)",
            "region_code": "int",
            "region_name": "varchar(100)",
            "region_short": "varchar(2)",
        },
        ["entity_key", "entity_code", "entity_name"],
        ["entity_key"],
    ),
    "dim_period": Contract(
        {"period_key": "int", "period": "int", "half": "int", "quarter": "int"},
        ["period_key", "period"],
        ["period_key"],
    ),
    "fact_entity": Contract(
        {
            "entity_key": "bigint",
            "period_key": "int",
            "entity_code": "varchar(7)",
            "period": "int",
            "measure": "bigint",
            "total": "decimal(18,2)",
            "rate": "decimal(18,4)",
            "growth_total": "decimal(10,4)",
            "growth_measure": "decimal(10,4)",
            "share_in_group": "decimal(10,4)",
            "share_in_nation": "decimal(10,4)",
            "rank_in_group": "int",
            "rank_in_nation": "int",
        },
        ["entity_key", "period_key", "entity_code", "period"],
        ["entity_key", "period_key"],
        {"entity_key": ("dim_entity", "entity_key"), "period_key": ("dim_period", "period_key")},
    ),
    "fact_group": Contract(
        {
            "group_code": "varchar(2)",
            "group_short": "varchar(2)",
            "group_name": "varchar(100)",
            "period": "int",
            "entities": "int",
            "measure": "bigint",
            "total": "decimal(18,2)",
            "mean_rate": "decimal(18,4)",
            "growth_total": "decimal(10,4)",
            "growth_measure": "decimal(10,4)",
            "share_in_nation": "decimal(10,4)",
            "rank_in_nation": "int",
        },
        ["group_code", "group_short", "group_name", "period"],
        ["group_code", "period"],
    ),
    "fact_nation": Contract(
        {
            "period": "int",
            "groups": "int",
            "measure": "bigint",
            "total": "decimal(18,2)",
            "rate": "decimal(18,4)",
            "growth_total": "decimal(10,4)",
            "growth_measure": "decimal(10,4)",
            "ipca_mensal_mean": "decimal(10,4)",
            "ipca_12m_mean": "decimal(10,4)",
            "pib_mensal_mean": "decimal(18,2)",
            "desemprego_mean": "decimal(10,4)",
            "igpm_mean": "decimal(10,4)",
            "igpdi_mean": "decimal(10,4)",
        },
        ["period"],
        ["period"],
    ),
}


def to_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Cast to the contract; a column the table lacks is written as null, columns beyond it pass through.

    For rows that fit: see ``require_contract``.
    """
    own = [_fitted(df, name, type_).alias(name) for name, type_ in contract.types.items()]
    return df.select(*own, *[c for c in df.columns if c not in contract.types])


def require_contract(df: DataFrame, contract: Contract) -> None:
    """Raise ``ContractBroken`` with the counts per column if any row does not fit; one pass over the table."""
    broken = contract_violations(df, contract).filter("violations > 0").collect()
    if broken:
        counts = ", ".join(f"{r['column_name']}: {r['violations']}" for r in broken)
        raise ContractBroken(f"rows that do not fit the target table, by column: {counts}")


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows per column that break the contract: missing mandatory values and values that do not fit."""
    flags = {}
    for name, type_ in contract.types.items():
        if name not in df.columns:
            flags[name] = F.count_if(F.lit(name in contract.required))
            continue
        lost = F.col(name).isNotNull() & _fitted(df, name, type_).isNull()
        missing = F.col(name).isNull() & F.lit(name in contract.required)
        flags[name] = F.count_if(lost | missing)
    counted = df.agg(*[f.alias(name) for name, f in flags.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("violations")) for n in flags])
    return counted.select(F.inline(pairs))


def _fitted(df: DataFrame, name: str, type_: str):
    if not type_.startswith("varchar"):
        value = F.col(name) if name in df.columns else F.lit(None)
        return value.try_cast(type_)
    text = F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")
    length = int(type_[len("varchar(") : -1])
    return F.when(F.length(text) <= length, text)
