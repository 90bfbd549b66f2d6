import random
from decimal import Decimal

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tidemark.operators.combine import attach, full_outer, orphan_sample, orphans, stack_measures
from tidemark.operators.dedupe import keep_latest, keep_one
from tidemark.operators.growth import with_growth
from tidemark.operators.keys import dense_index, spine_index
from tidemark.operators.rollup import distinct_count, rollup_level
from tidemark.operators.series import fold_series, series_wide
from tidemark.operators.spine import union_periods
from tidemark.operators.standings import standings


def test_keep_latest_breaks_ties_the_same_way_in_any_row_order(spark):
    data = [(1, 5, "b"), (1, 5, "a"), (1, 3, "z"), (2, None, "q"), (2, 1, "r"), (None, 1, "n"), (None, 2, "m")]
    expected = [(1, 5, "a"), (2, 1, "r"), (None, 2, "m")]
    for shuffled in (data, data[::-1]):
        df = spark.createDataFrame(shuffled, "k int, t int, v string")
        assert rows(keep_latest(df, ["k"], "t")) == expected


def test_keep_latest_with_a_hot_key_matches_brute_force(uncoalesced):
    rng = random.Random(1)
    data = [(1 if i % 3 == 0 else rng.randrange(50), rng.randrange(20), i) for i in range(3000)]
    best = {}
    for row in data:
        kept = best.get(row[0])
        if kept is None or (row[1], -row[2]) > (kept[1], -kept[2]):
            best[row[0]] = row
    df = uncoalesced.createDataFrame(data, "k int, t int, v int").repartition(8)
    latest = keep_latest(df, ["k"], "t")
    assert rows(latest) == sorted(best.values(), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert plan(latest).count("WindowGroupLimit") == 2  # before and after the shuffle


def test_keep_one_of_identical_rows(spark):
    df = spark.createDataFrame([(1, "A"), (1, "A"), (2, "B")], "id int, name string")
    assert rows(keep_one(df, ["id", "name"])) == [(1, "A"), (2, "B")]


def test_dense_index_is_gap_free_over_many_sort_tasks(uncoalesced, staging):
    rng = random.Random(2)
    codes = [f"{rng.randrange(10**6):07d}-{i}" for i in range(2000)]
    df = uncoalesced.createDataFrame([(c,) for c in codes], "code string").repartition(6)
    got = dense_index(df, ["code"], staging, "key").collect()
    assert [r["code"] for r in sorted(got, key=lambda r: r["key"])] == sorted(codes)
    assert sorted(r["key"] for r in got) == list(range(2000))


def test_dense_index_of_an_empty_table(spark, staging):
    df = spark.createDataFrame([], "code string")
    assert dense_index(df, ["code"], staging, "key").collect() == []


def brute_standings(data):
    """(group, period, value, id) -> ranks and shares by plain sorting."""
    out = {}
    by_period, by_group = {}, {}
    for row in data:
        by_period.setdefault(row[1], []).append(row)
        by_group.setdefault((row[0], row[1]), []).append(row)
    def order(r):
        return (r[2] is None, -(r[2] or 0), r[3])
    for part, name in ((by_period, "p"), (by_group, "g")):
        for members in part.values():
            filled = [m[2] for m in members if m[2] is not None]
            total = sum(filled) if filled else None
            for n, member in enumerate(sorted(members, key=order), 1):
                share = None
                if member[2] is not None and total:
                    share = float(member[2]) / float(total) * 100
                out.setdefault(member[3], {})[name] = (n, share)
    return out


def check_standings(session, staging, data):
    df = session.createDataFrame(data, "g string, period int, v decimal(18,2), id string").repartition(5)
    expected = brute_standings(data)
    got = standings(df, "g", "period", "v", "id", staging).collect()
    assert len(got) == len(data)
    for r in got:
        want = expected[r["id"]]
        assert r["rank_in_nation"] == want["p"][0]
        assert r["rank_in_group"] == want["g"][0]
        assert r["share_in_nation"] == want["p"][1]
        assert r["share_in_group"] == want["g"][1]


def test_standings_with_hot_group_hot_value_and_nulls(uncoalesced, staging):
    rng = random.Random(3)
    data = []
    for i in range(3000):
        group = "hot" if i % 3 == 0 else rng.choice(["a", "b", "", None])
        period = 2000 if rng.random() < 0.5 else rng.choice([1999, 2001, 2002, None])
        value = rng.choice([None, Decimal("5.00"), Decimal("5.00"), Decimal(rng.randrange(40))])
        data.append((group, period, value, f"{i:05d}"))
    check_standings(uncoalesced, staging, data)


def test_standings_where_nearly_all_rows_tie(uncoalesced, staging):
    data = [("g", 2000, Decimal("1.00"), f"{i:05d}") for i in range(900)]
    data += [("h", 2001, None, f"n{i:05d}") for i in range(300)]
    data += [("z", 2002, Decimal("0.00"), "zero")]
    check_standings(uncoalesced, staging, data)


def test_sorting_computes_its_input_once(spark, staging):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(v):
        seen.add(1)
        return v

    data = [("g", 2000 + i % 3, float(i), f"{i:05d}") for i in range(500)]
    df = spark.createDataFrame(data, "g string, period int, v double, id string").withColumn("v", counted("v"))
    assert len(standings(df, "g", "period", "v", "id", staging).collect()) == 500
    assert seen.value == 500


def test_sort_ranges_split_a_tied_value(uncoalesced, staging):
    from tidemark.operators.keys import place_in_order

    df = uncoalesced.createDataFrame([(1, f"{i:05d}") for i in range(4000)], "v int, id string").repartition(8)
    placed = place_in_order(df, ["v", "id"], staging, "tied")
    largest = placed.groupBy("_part").count().agg(F.max("count")).first()[0]
    assert largest < 2000


def test_stacked_measures_equal_the_outer_join_and_need_one_shuffle(spark):
    left = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, None)], "e string, p int, m int")
    right = spark.createDataFrame([("a", 2, 0.5), ("c", 1, 1.5)], "e string, p int, r double")
    stacked = stack_measures(left, right, ["e", "p"], ["e"])
    assert rows(stacked) == rows(full_outer(left, right, ["e", "p"]).select("e", "p", "m", "r"))
    grown = with_growth(stacked, {"m": "g"}, "p", ["e"])
    for repeated in (left.unionByName(left), left.unionByName(left.filter("p = 1"))):
        with pytest.raises(Exception, match="not unique"):
            stack_measures(repeated, right, ["e", "p"], ["e"]).collect()
    lost = spark.createDataFrame([(None, 1, 10), (None, 1, 20)], "e string, p int, m int")
    more = spark.createDataFrame([(None, 1, 0.5)], "e string, p int, r double")
    assert rows(stack_measures(lost, more, ["e", "p"], ["e"])) == rows(full_outer(lost, more, ["e", "p"]).select("e", "p", "m", "r"))
    assert plan(grown).count("Exchange hashpartitioning") == 1


def test_growth_uses_the_previous_row_and_strict_the_previous_period(spark):
    data = [("a", 2000, 100), ("a", 2002, 150), ("a", 2003, 75), ("b", 2000, 0), ("b", 2001, 5), ("c", 2000, None), ("c", 2001, 3)]
    df = spark.createDataFrame(data, "e string, p int, v int")
    loose = {(r["e"], r["p"]): r["g"] for r in with_growth(df, {"v": "g"}, "p", ["e"]).collect()}
    assert loose == {
        ("a", 2000): None,
        ("a", 2002): 50.0,
        ("a", 2003): -50.0,
        ("b", 2000): None,
        ("b", 2001): None,
        ("c", 2000): None,
        ("c", 2001): None,
    }
    strict = {(r["e"], r["p"]): r["g"] for r in with_growth(df, {"v": "g"}, "p", ["e"], strict=True).collect()}
    assert strict[("a", 2002)] is None and strict[("a", 2003)] == -50.0


def test_attach_keeps_rows_without_a_match(spark):
    fact = spark.createDataFrame([("a", 1), ("x", 2)], "e string, v int")
    dim = spark.createDataFrame([("a", "G", "unused")], "e string, g string, other string")
    assert rows(attach(fact, dim, "e", ["g"])) == [("a", 1, "G"), ("x", 2, None)]


def test_orphans_count_a_null_key(spark):
    child = spark.createDataFrame([(i,) for i in [1, 1, 2, None, *range(10, 25)]], "k int")
    parent = spark.createDataFrame([(1,), (1,), (3,), (None,)], "pk int")
    found = {r[0] for r in orphans(child, parent, "k", "pk").collect()}
    assert found == {2, None, *range(10, 25)}
    sample = [r[0] for r in orphan_sample(child, parent, "k", "pk").collect()]
    assert sample == [None, 2, *range(10, 18)]


def test_rollups(spark):
    df = spark.createDataFrame([("a", Decimal("1.00")), ("a", None), ("b", Decimal("3.00")), (None, Decimal("2.00"))], "k string, v decimal(18,2)")
    got = rows(rollup_level(df, ["k"], ["v"], ["sum", "avg", "count"]))
    assert got == [("a", Decimal("1.00"), 1.0, 1), ("b", Decimal("3.00"), 3.0, 1), (None, Decimal("2.00"), 2.0, 1)]
    assert distinct_count(df, ["k"]).first()[0] == 3


def test_series_columns_do_not_depend_on_the_data(spark):
    data = [("x", 2020, Decimal("1.0")), ("x", 2020, Decimal("2.0")), ("unlisted", 2020, Decimal("9.0"))]
    df = spark.createDataFrame(data, "series_name string, period int, value decimal(18,4)")
    wide = series_wide(df, "period", ["x", "absent"])
    assert wide.columns == ["period", "x_mean", "x_max", "x_min", "absent_mean", "absent_max", "absent_min"]
    spine = spark.createDataFrame([(2020,), (2021,), (2021,)], "period int")
    got = rows(fold_series(spine, wide, "period"))
    assert got == [
        (2020, 1.5, Decimal("2.0000"), Decimal("1.0000"), None, None, None),
        (2021, None, None, None, None, None, None),
    ]


def test_period_lists(spark):
    a = spark.createDataFrame([(2001,), (2000,), (2000,)], "period int")
    b = spark.createDataFrame([(2003,), (2001,)], "period int")
    spine = union_periods([a, b], "period")
    assert rows(spine_index(spine, "period", "key")) == [(1, 2000), (2, 2001), (3, 2003)]
