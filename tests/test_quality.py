import pytest
from conftest import rows

from tidemark.quality import checks
from tidemark.quality.rules import DatasetRules, ReferenceRule
from tidemark.quality.suites import layer_checks, summarize


@pytest.fixture
def sample(spark):
    data = [(21, "oak", 120), (22, "elm", 240), (23, None, 330), (24, "ash", None), (25, "fir", 150)]
    return spark.createDataFrame(data, "plot int, species string, height int")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "plot int, species string, height int")


def test_required_columns(sample):
    assert checks.missing_columns(sample, ["plot", "species"]) == []
    assert checks.missing_columns(sample, ["plot", "other"]) == ["other"]
    checks.require_columns(sample, ["plot"])
    with pytest.raises(ValueError, match="other"):
        checks.require_columns(sample, ["other"])
    assert rows(checks.schema_report(sample, ["species", "other"])) == [("other", False, None), ("species", True, 4)]


def test_nulls(sample, empty):
    got = {r.column_name: r for r in checks.null_report(sample, ["plot", "species", "absent"]).collect()}
    assert set(got) == {"plot", "species"}
    assert got["plot"].passed and not got["species"].passed
    assert (got["species"].null_count, got["species"].null_percentage) == (1, 20.0)
    assert checks.null_report(sample, ["species"], threshold=0.25).first().passed
    assert checks.null_report(empty, ["species"]).first().passed


def test_duplicates(spark, empty):
    df = spark.createDataFrame([(3, "oak"), (3, "oak"), (3, "oak"), (4, "elm"), (None, "elm"), (None, "elm")], "plot int, species string")
    got = checks.duplicate_report(df, ["plot", "species"]).first()
    assert (got.total_rows, got.unique_rows, got.duplicate_count, got.passed) == (6, 3, 3, False)
    assert checks.duplicate_report(empty, ["plot"]).first().passed


def test_range(sample, empty):
    assert checks.range_report(sample, "height", 0, 1000).first().passed
    assert checks.range_report(sample, "height", 120, 330).first().passed
    above = checks.range_report(sample, "height", 0, 150).first()
    assert (above.passed, above.failure, above.avg) == (False, "maximum above bound", 210.0)
    assert checks.range_report(sample, "height", 150, None).first().failure == "minimum below bound"
    assert checks.range_report(empty, "height", 0, 1).first().failure == "no values"
    assert checks.range_report(sample, "other", 0, 1).first().failure == "column missing"


def test_completeness(sample, empty):
    got = {r.column_name: r for r in checks.completeness_report(sample, 0.9).collect()}
    assert (got["plot"].overall_completeness, got["plot"].passed) == (86.67, False)
    assert (got["species"].column_completeness, got["plot"].total_cells, got["plot"].total_filled) == (80.0, 15, 13)
    assert not checks.completeness_report(empty).first().passed


def test_integrity(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "pk int")
    assert tuple(checks.integrity_report(child, parent, "k", "pk").first()) == (3, 2, False, "null,2")
    whole = checks.integrity_report(child.filter("k = 1"), parent, "k", "pk").first()
    assert whole.passed and whole.sample is None
    many = spark.range(1000).selectExpr("cast(id % 500 as int) AS k").repartition(7)
    found = checks.integrity_report(many, parent, "k", "pk", size=4).first()
    assert (found.total_child_keys, found.orphan_count, found.sample) == (500, 499, "0,2,3,4")


def test_profile_and_error_rate(sample, empty):
    got = {r.column_name: r for r in checks.profile(sample).collect()}
    assert (got["height"].row_count, got["height"].column_count, got["height"].null_count) == (5, 3, 1)
    rate = checks.error_rate(sample, ["species"], {"height": (0, 150)}, 0.05).first()
    assert (rate.failing_rows, rate.error_rate, rate.passed) == (3, 0.6, False)
    assert checks.error_rate(empty, ["species"], {}, 0.05).first().passed


RULES = DatasetRules("test", "sample", ["plot", "other"], ["plot", "species"], ["plot"], {"height": (0, 150)}, completeness=0.8)


def test_suite_rows(spark, sample):
    got = {r.check: r for r in layer_checks(spark, {"sample": sample}, [RULES]).collect()}
    assert {k: (r.passed, r.checked, r.failed) for k, r in got.items()} == {
        "schema": (False, 2, 1),
        "nulls": (False, 10, 1),
        "completeness": (True, 15, 2),
        "range_height": (False, 4, 2),
        "duplicates": (True, 5, 0),
    }
    assert got["nulls"].metric == 0.2


def test_suite_counts_integrity_and_can_be_switched_off(spark, sample):
    tables = {"sample": sample, "parent": sample.filter("plot < 23")}
    reference = ReferenceRule("test", "sample", "parent", "plot", "plot")
    summary = summarize(layer_checks(spark, tables, [RULES], [reference])).first()
    assert (summary.total_checks, summary.passed_checks, summary.failed_checks, summary.pass_rate) == (6, 2, 4, 33.33)
    assert layer_checks(spark, tables, [RULES], enabled=False).count() == 0


def test_suite_on_an_empty_table(spark, empty):
    got = {r.check: r.passed for r in layer_checks(spark, {"sample": empty}, [RULES]).collect()}
    assert got == {"schema": False, "nulls": True, "completeness": False, "range_height": False, "duplicates": True}


def test_rules_survive_the_way_through_a_table(spark):
    from dataclasses import replace

    from tidemark.quality.rules import BRONZE_RULES, DECLARED_RULES, GOLD_RULES, SILVER_RULES, rule_table, rules_from

    rules = [*BRONZE_RULES, *SILVER_RULES, *GOLD_RULES[:2], replace(RULES, ranges={"height": (None, 150.0)}), DECLARED_RULES]
    expected = [replace(r, checks=tuple(c for c in r.checks if c != "range" or r.ranges)) for r in rules]
    assert rules_from(rule_table(spark, rules)) == expected


def test_a_switched_off_check_takes_its_rows_alone(spark, sample):
    from tidemark.quality.rules import rule_table, rules_from

    table = rule_table(spark, [RULES])
    whole = {r.check: r for r in layer_checks(spark, {"sample": sample}, rules_from(table)).collect()}
    for check in ("schema", "nulls", "completeness", "duplicates", "range"):
        left = layer_checks(spark, {"sample": sample}, rules_from(table.where(f"check <> '{check}'"))).collect()
        assert {r.check: r for r in left} == {name: r for name, r in whole.items() if not name.startswith(check)}
    assert layer_checks(spark, {"sample": sample}, rules_from(table.where("false"))).count() == 0


def test_error_rate_as_a_check(spark, sample):
    from dataclasses import replace

    found = layer_checks(spark, {"sample": sample}, [replace(RULES, checks=(), error_rate=0.6)]).collect()
    assert [(r.check, r.passed, r.checked, r.failed, r.metric) for r in found] == [("error_rate", True, 5, 3, 0.6)]
