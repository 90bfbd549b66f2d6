"""Suites: all declared checks of a dataset or a layer as rows of one result table.

Result columns: layer, dataset, check, passed, checked, failed, metric. What
``checked`` and ``failed`` count depends on the check: columns (schema), cells
(nulls, completeness), rows (duplicates, range) or keys (integrity). ``metric``
is the largest null share, the duplicate share, the completeness, the share
outside the range, the orphan share, or the share of failing rows. ``sample``
holds the first orphans of an integrity check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio, round2
from tidemark.functions.predicates import within_closed
from tidemark.quality.checks import breaks_rules, duplicate_report, integrity_report, missing_columns, row_count
from tidemark.quality.rules import DatasetRules, ReferenceRule

RESULT_SCHEMA = (
    "layer string, dataset string, check string, passed boolean, checked bigint, failed bigint, metric double, sample string"
)


def dataset_checks(df: DataFrame, rules: DatasetRules) -> DataFrame:
    """Schema, nulls, completeness, ranges and error rate from one aggregation, duplicates from a second.

    Only checks that are switched on; there is at least one.
    """
    makers = {"schema": _schema_row, "nulls": _null_rows, "completeness": _completeness_row, "range": _range_rows}
    rows = [row for check, make in makers.items() if check in rules.checks for row in make(df, rules)]
    if rules.error_rate is not None:
        rows.append(_error_row(rules))
    parts = []
    if rows:
        counted = df.agg(row_count().alias("_rows"), *_counters(df, rules))
        parts.append(counted.select(F.inline(F.array(*rows))))
    if "duplicates" in rules.checks and not missing_columns(df, rules.keys):
        parts.append(_duplicate_rows(df, rules))
    results = reduce(DataFrame.unionByName, parts)
    return results.select(F.lit(rules.layer).alias("layer"), F.lit(rules.dataset).alias("dataset"), "*")


def layer_checks(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    rules: list[DatasetRules],
    references: list[ReferenceRule] | None = None,
    enabled: bool = True,
) -> DataFrame:
    """All checks of the tables at hand; none when switched off."""
    parts = []
    if enabled:
        parts = [dataset_checks(tables[r.dataset], r) for r in rules if r.dataset in tables and (r.checks or r.error_rate is not None)]
        for rule in references or []:
            if rule.child in tables and rule.parent in tables:
                parts.append(_integrity_rows(tables, rule))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], RESULT_SCHEMA)


def summarize(results: DataFrame) -> DataFrame:
    """Checks, passes, failures and pass rate in percent per layer."""
    return results.groupBy("layer").agg(
        row_count().alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        round2(ratio(F.count_if("passed"), row_count()) * 100).alias("pass_rate"),
    )


def _row(check: str, passed, checked, failed, metric, sample=None):
    return F.struct(
        F.lit(check).alias("check"),
        passed.alias("passed"),
        checked.cast("bigint").alias("checked"),
        failed.cast("bigint").alias("failed"),
        metric.cast("double").alias("metric"),
        (F.lit(None) if sample is None else sample).cast("string").alias("sample"),
    )


def _counters(df: DataFrame, rules: DatasetRules):
    counters = [F.count(c).alias(f"_n_{c}") for c in df.columns]
    for column, (low, high) in rules.ranges.items():
        if column in df.columns:
            outside = ~within_closed(column, low, high)
            counters.append(F.count_if(outside).alias(f"_outside_{column}"))
    if rules.error_rate is not None:
        counters.append(F.count_if(breaks_rules(rules.critical, rules.ranges)).alias("_failing"))
    return counters


def _schema_row(df, rules):
    missing = len(missing_columns(df, rules.required))
    required = len(rules.required)
    share = missing / required if required else 0.0
    return [_row("schema", F.lit(missing == 0), F.lit(required), F.lit(missing), F.lit(share))]


def _null_rows(df, rules):
    present = [c for c in rules.critical if c in df.columns]
    nulls = [F.col("_rows") - F.col(f"_n_{c}") for c in present]
    shares = [F.coalesce(ratio(n, F.col("_rows")), F.lit(0.0)) for n in nulls]
    worst = F.array_max(F.array(F.lit(0.0), *shares))
    passed = worst <= rules.null_threshold
    return [_row("nulls", passed, F.col("_rows") * len(present), sum(nulls, F.lit(0)), worst)]


def _completeness_row(df, rules):
    cells = F.col("_rows") * len(df.columns)
    filled = sum((F.col(f"_n_{c}") for c in df.columns), F.lit(0))
    share = F.coalesce(ratio(filled, cells), F.lit(0.0))
    return [_row("completeness", share >= rules.completeness, cells, cells - filled, share)]


def _range_rows(df, rules):
    return [_range_row(df, column) for column in rules.ranges]


def _range_row(df, column):
    if column not in df.columns:
        return _row(f"range_{column}", F.lit(False), F.lit(0), F.lit(0), F.lit(None))
    count, outside = F.col(f"_n_{column}"), F.col(f"_outside_{column}")
    passed = (count > 0) & (outside == 0)
    return _row(f"range_{column}", passed, count, outside, ratio(outside, count))


def _error_row(rules):
    share = F.coalesce(ratio("_failing", "_rows"), F.lit(0.0))
    return _row("error_rate", share <= rules.error_rate, F.col("_rows"), F.col("_failing"), share)


def _duplicate_rows(df, rules):
    report = duplicate_report(df, rules.keys)
    share = F.coalesce(ratio("duplicate_count", "total_rows"), F.lit(0.0))
    row = _row("duplicates", F.col("passed"), F.col("total_rows"), F.col("duplicate_count"), share)
    return report.select(F.inline(F.array(row)))


def _integrity_rows(tables, rule):
    report = integrity_report(tables[rule.child], tables[rule.parent], rule.child_key, rule.parent_key)
    share = F.coalesce(ratio("orphan_count", "total_child_keys"), F.lit(0.0))
    name = f"integrity_{rule.child_key}"
    row = _row(name, F.col("passed"), F.col("total_child_keys"), F.col("orphan_count"), share, F.col("sample"))
    return report.select(F.lit(rule.layer).alias("layer"), F.lit(rule.child).alias("dataset"), F.inline(F.array(row)))
