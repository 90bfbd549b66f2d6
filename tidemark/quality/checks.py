"""Single checks. Each returns a DataFrame and reads its table in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio, round2
from tidemark.functions.predicates import within_closed


def row_count() -> Column:
    """Number of rows."""
    return F.count(F.lit(1))


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns the table lacks, in the given order; no data is read."""
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: list[str]) -> None:
    """Raise when a required column is absent."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"required columns missing: {missing}")


def schema_report(df: DataFrame, required: list[str]) -> DataFrame:
    """One row per required column, with the rows that fill it."""
    present = [c for c in required if c in df.columns]
    counted = df.agg(*[F.count(c).alias(f"n_{c}") for c in present], row_count().alias("rows"))
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c in present).alias("present"),
            (F.col(f"n_{c}") if c in present else F.lit(None).cast("bigint")).alias("filled"),
        )
        for c in required
    ]
    return counted.select(F.inline(F.array(*rows)))


def null_report(df: DataFrame, columns: list[str], threshold: float = 0.0) -> DataFrame:
    """Null count and share of each named column that exists; an empty table passes."""
    present = [c for c in columns if c in df.columns]
    counted = df.agg(row_count().alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in present])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("null_count")) for c in present]
    share = F.coalesce(ratio("null_count", "total_rows"), F.lit(0.0))
    return counted.select("total_rows", F.inline(F.array(*rows))).select(
        "column_name",
        "total_rows",
        "null_count",
        round2(share * 100).alias("null_percentage"),
        (share <= threshold).alias("passed"),
    )


def duplicate_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key; null keys count as values."""
    per_key = df.groupBy(*keys).agg(row_count().alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"), row_count().alias("unique_rows")
    ).withColumns(
        {
            "duplicate_count": F.col("total_rows") - F.col("unique_rows"),
            "passed": F.col("total_rows") == F.col("unique_rows"),
        }
    )


def range_report(df: DataFrame, column: str, low: float | None, high: float | None) -> DataFrame:
    """Minimum, maximum, mean and count of a column against inclusive bounds.

    A missing column and a column without any value fail, with the reason given.
    """
    exists = column in df.columns
    value = F.col(column) if exists else F.lit(None).cast("double")
    stats = df.agg(
        F.min(value).cast("double").alias("min"),
        F.max(value).cast("double").alias("max"),
        ratio(F.sum(value), F.count(value)).alias("avg"),
        F.count(value).alias("count"),
    )
    reason = (
        F.when(F.lit(not exists), "column missing")
        .when(F.col("count") == 0, "no values")
        .when(~within_closed("min", low, None), "minimum below bound")
        .when(~within_closed("max", None, high), "maximum above bound")
    )
    return stats.select(
        F.lit(column).alias("column_name"),
        "min",
        "max",
        "avg",
        "count",
        F.lit(low).cast("double").alias("expected_min"),
        F.lit(high).cast("double").alias("expected_max"),
        reason.alias("failure"),
        reason.isNull().alias("passed"),
    )


def completeness_report(df: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Filled cells over all cells, overall and per column; an empty table fails."""
    counted = df.agg(row_count().alias("total_rows"), *[F.count(c).alias(f"n_{c}") for c in df.columns])
    filled = sum((F.col(f"n_{c}") for c in df.columns), F.lit(0))
    cells = F.col("total_rows") * len(df.columns)
    overall = F.coalesce(ratio(filled, cells), F.lit(0.0))
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("filled")) for c in df.columns]
    share = F.coalesce(ratio("filled", "total_rows"), F.lit(0.0))
    return counted.select(
        "total_rows",
        cells.alias("total_cells"),
        filled.alias("total_filled"),
        overall.alias("_overall"),
        F.inline(F.array(*rows)),
    ).select(
        "column_name",
        "filled",
        round2(share * 100).alias("column_completeness"),
        "total_rows",
        "total_cells",
        "total_filled",
        round2(F.col("_overall") * 100).alias("overall_completeness"),
        (F.col("_overall") >= threshold).alias("passed"),
    )


def integrity_report(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, size: int = 10) -> DataFrame:
    """Distinct child keys, those absent from the parent, and the first ``size`` of these; a null child key is an orphan.

    Both sides of the result come from the same joined keys, whose exchanges Spark reuses. Every task keeps its first
    ``size`` orphans only, so the sample is bounded however many there are. ``sample`` is null without orphans.
    """
    keys = child.select(F.col(child_key).alias("_key")).distinct()
    known = parent.select(F.col(parent_key).alias("_known")).distinct()
    matched = keys.join(known, F.col("_key") == F.col("_known"), "left")
    counted = matched.agg(row_count().alias("total_child_keys"), F.count_if(F.col("_known").isNull()).alias("orphan_count"))
    first = matched.where(F.col("_known").isNull()).orderBy("_key").limit(size)
    listed = F.transform(F.sort_array(F.collect_list(F.struct("_key"))), lambda s: F.coalesce(s["_key"].cast("string"), F.lit("null")))
    sampled = first.agg(F.array_join(listed, ",").alias("sample"))
    both = counted.unionByName(sampled, allowMissingColumns=True)
    merged = both.agg(F.max("total_child_keys").alias("total_child_keys"), F.max("orphan_count").alias("orphan_count"), F.max("sample").alias("sample"))
    found = F.when(F.col("orphan_count") > 0, F.col("sample"))
    return merged.select("total_child_keys", "orphan_count", (F.col("orphan_count") == 0).alias("passed"), found.alias("sample"))


def profile(df: DataFrame) -> DataFrame:
    """Row count, column count and nulls per column."""
    counted = df.agg(row_count().alias("row_count"), *[F.count(c).alias(f"n_{c}") for c in df.columns])
    rows = [
        F.struct(F.lit(c).alias("column_name"), (F.col("row_count") - F.col(f"n_{c}")).alias("null_count"))
        for c in df.columns
    ]
    return counted.select("row_count", F.lit(len(df.columns)).alias("column_count"), F.inline(F.array(*rows)))


def error_rate(df: DataFrame, critical: list[str], ranges: dict, limit: float) -> DataFrame:
    """Rows that break any declared rule over all rows; a missing value breaks its range."""
    return df.agg(row_count().alias("rows"), F.count_if(breaks_rules(critical, ranges)).alias("failing_rows")).select(
        "rows",
        "failing_rows",
        ratio("failing_rows", "rows").alias("error_rate"),
        F.coalesce(ratio("failing_rows", "rows") <= limit, F.lit(True)).alias("passed"),
    )


def group_agreement(values: DataFrame, entities: DataFrame) -> DataFrame:
    """Entities whose code prefix names another group than the dimension does, over the known entities."""
    codes = values.select("entity_code", F.col("group_code").alias("_prefix")).distinct()
    known = codes.join(entities.select("entity_code", "group_code"), "entity_code")
    differs = ~F.col("_prefix").eqNullSafe(F.col("group_code"))
    return known.agg(row_count().alias("entities"), F.count_if(differs).alias("disagreeing")).withColumn(
        "passed", F.col("disagreeing") == 0
    )


def breaks_rules(critical: list[str], ranges: dict) -> Column:
    """True for a row with a critical null or a value outside its range."""
    broken = F.lit(False)
    for column in critical:
        broken = broken | F.col(column).isNull()
    for column, (low, high) in ranges.items():
        broken = broken | ~F.coalesce(within_closed(column, low, high), F.lit(False))
    return broken
