import datetime as dt
import json

import pytest
from conftest import plan, rows

from tidemark.sources.aggregates import broken_aggregate_pieces, parse_aggregates, read_aggregate_pieces, read_aggregates, rejected_values
from tidemark.sources.lake import read_table
from tidemark.functions.columns import decode_value
from tidemark.sources.localities import read_localities, read_locality_lines, rejected_localities
from tidemark.sources.pieces import read_pieces
from tidemark.sources.selection import pick_periods, trailing_window
from tidemark.sources.series import DEFAULT_SERIES, broken_series, broken_series_pieces, land_series, read_series, read_series_pieces, series_catalogue

RESPONSE = [
    {
        "periodo": {"id": "2024"},
        "id": "9324",
        "resultados": [
            {
                "classificacoes": [{"id": "1"}],
                "series": [
                    {
                        "localidade": {"id": "7012345", "nome": "Vila Nova do Cabo", "nivel": {"id": "N6"}},
                        "serie": {"2024": "48210", "2023": {"valor": "5.5"}, "2022": "...", "2021": None},
                    },
                    {"localidade": {"id": "1", "nome": "x"}, "serie": {"media": "2", "202201": "bad"}},
                ],
            }
        ],
    },
    {"id": "37", "resultados": []},
]
EXPECTED = [
    ("1", "x", 202201, None, "9324", "population", None),
    ("1", "x", None, 2.0, "9324", "population", None),
    ("7012345", "Vila Nova do Cabo", 2021, None, "9324", "population", "N6"),
    ("7012345", "Vila Nova do Cabo", 2022, None, "9324", "population", "N6"),
    ("7012345", "Vila Nova do Cabo", 2023, 5.5, "9324", "population", "N6"),
    ("7012345", "Vila Nova do Cabo", 2024, 48210.0, "9324", "population", "N6"),
]


def test_aggregates_from_files(spark, tmp_path):
    (tmp_path / "response.json").write_text(json.dumps(RESPONSE, indent=1), encoding="utf-8")
    assert rows(read_aggregates(spark, str(tmp_path), "population")) == EXPECTED


def test_aggregates_from_text_and_rejects(spark):
    df = spark.createDataFrame([(json.dumps(RESPONSE),), ("[]",), ('[{"id": "9', ), ("no json",)], "payload string")
    assert rows(parse_aggregates(df, "payload", "population")) == EXPECTED
    assert tuple(rejected_values(df, "payload").first()) == (6, 1, 4, 2)


def test_only_plain_numbers_are_values(spark):
    values = ["1d", "NaN", "Infinity", "1e3", " 2.5 ", "-.5", "1,5", "0x1", "..."]
    df = spark.createDataFrame([(v,) for v in values], "raw string")
    assert [r.v for r in df.select(decode_value("raw").alias("v")).collect()] == [None, None, None, 1000.0, 2.5, -0.5, None, None, None]


def test_lines_of_localities_and_rejects(spark, tmp_path):
    (tmp_path / "a.txt").write_text('{"id": 5, "nome": "x"}\n{"id": 6, "no\n{}\n', encoding="utf-8")
    assert [r.entity_code for r in read_locality_lines(spark, str(tmp_path)).collect()] == ["5"]
    assert tuple(rejected_localities(spark.read.text(str(tmp_path)), "value").first()) == (3, 2)


def test_localities_with_missing_levels(spark, tmp_path):
    region = {"id": 3, "sigla": "SE", "nome": "Sudeste"}
    full = {"UF": {"id": 35, "sigla": "SP", "nome": "São Paulo", "regiao": region}}
    data = [
        {"id": 3550308, "nome": "São Paulo", "microrregiao": {"mesorregiao": full}},
        {"id": 1, "nome": "x", "microrregiao": {"mesorregiao": {"UF": {"id": 2}}}},
        {"id": 2, "nome": "y"},
    ]
    (tmp_path / "l.json").write_text(json.dumps(data), encoding="utf-8")
    assert rows(read_localities(spark, str(tmp_path))) == [
        ("1", "x", "2", None, None, None, None, None),
        ("2", "y", None, None, None, None, None, None),
        ("3550308", "São Paulo", "35", "SP", "São Paulo", "3", "Sudeste", "SE"),
    ]


def test_series_files_are_read_in_one_job(spark, tmp_path):
    for code, points in {433: [("01/02/2020", "0.25"), ("x", "1")], 12: [("05/03/2021", "bad")], 77: [("01/01/2020", "1")]}.items():
        folder = tmp_path / f"series_code={code}"
        folder.mkdir()
        (folder / "p.json").write_text(json.dumps([{"data": d, "valor": v} for d, v in points]))
    catalogue = series_catalogue(spark, {"ipca_mensal": 433, "cdi": 12, "nameless": None})
    got = read_series(spark, str(tmp_path), catalogue, "central_bank")
    assert [tuple(map(str, r)) for r in rows(got.select("series_code", "series_name", "source", "obs_date", "value", "year", "month"))] == [
        ("12", "cdi", "central_bank", "2021-03-05", "None", "2021", "3"),
        ("433", "ipca_mensal", "central_bank", "2020-02-01", "0.2500", "2020", "2"),
        ("433", "ipca_mensal", "central_bank", "None", "1.0000", "None", "None"),
    ]


@pytest.fixture
def small_splits(spark):
    """Files are cut every few hundred bytes."""
    conf = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    for name, value in conf.items():
        spark.conf.set(name, value)
    yield spark
    for name in conf:
        spark.conf.unset(name)


@pytest.mark.parametrize("indent", [None, 2])
def test_one_array_of_points_is_read_by_many_tasks(small_splits, tmp_path, indent):
    spark = small_splits
    points = [{"data": f"{1 + k % 28:02d}/01/20{k % 20:02d}", "valor": f"{k}.25"} for k in range(200)]
    for code in (1, 2):
        (tmp_path / f"series_code={code}").mkdir()
        (tmp_path / f"series_code={code}" / "p.json").write_text(json.dumps(points[: 200 // code], indent=indent))
    catalogue = series_catalogue(spark, {"a": 1, "b": 2})
    found = read_series_pieces(spark, str(tmp_path), catalogue, "api")
    assert read_pieces(spark, str(tmp_path), "data", "series_code int").rdd.getNumPartitions() > 10
    assert rows(found) == rows(read_series(spark, str(tmp_path), catalogue, "api")) and found.count() == 300
    assert broken_series_pieces(spark, str(tmp_path)).count() == 0
    text = (tmp_path / "series_code=2" / "p.json").read_text()
    (tmp_path / "series_code=2" / "p.json").write_text(text[: text.rindex("valor") + 2])
    assert read_series_pieces(spark, str(tmp_path), catalogue, "api").count() == 299
    assert rows(broken_series_pieces(spark, str(tmp_path))) == [(2, 1)]


@pytest.mark.parametrize("indent", [None, 1])
def test_one_response_is_read_by_many_tasks(small_splits, tmp_path, indent):
    spark = small_splits

    def place(k):
        return {"localidade": {"id": str(k), "nivel": {"id": "N6"}, "nome": f"place {k}"}, "serie": {"2020": str(k), "2021": {"valor": "1.5"}}}

    response = [
        {"id": str(v), "variavel": "x", "resultados": [{"classificacoes": [{"id": "9"}], "series": [place(k) for k in range(v, v + 60)]}, {"series": [place(900 + v)]}]}
        for v in (37, 9324)
    ]
    response.insert(1, {"id": "5", "resultados": []})
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.json").write_text(json.dumps(response, indent=indent))
    (tmp_path / "a" / "two.json").write_text(json.dumps(RESPONSE, indent=indent))
    found = read_aggregate_pieces(spark, str(tmp_path / "a"), "population")
    assert rows(found) == rows(read_aggregates(spark, str(tmp_path / "a"), "population"))
    assert found.count() == 2 * 2 * 61 + len(EXPECTED)
    assert read_pieces(spark, str(tmp_path / "a"), "localidade").rdd.getNumPartitions() > 10
    (tmp_path / "a" / "two.json").write_text(json.dumps(RESPONSE)[:-60])
    assert tuple(broken_aggregate_pieces(spark, str(tmp_path / "a")).first()) == (124, 1)


def test_a_file_of_many_responses_carries_each_variable_on(small_splits, tmp_path):
    spark = small_splits
    texts = [
        json.dumps([{"id": str(v), "resultados": [{"series": [{"localidade": {"id": f"{v}-{k}", "nivel": {"id": "N6"}, "nome": "x"}, "serie": {"2020": "1"}} for k in range(v % 4)]}]}])
        for v in range(400)
    ]
    (tmp_path / "many.json").write_text("\n".join(texts))
    (tmp_path / "none.json").write_text('[{"resultados": [{"series": [{"localidade": {"id": "9", "nome": "y"}, "serie": {"2020": "1"}}]}]}]')
    found = read_aggregate_pieces(spark, str(tmp_path), "population")
    # a list of all variables of a file, searched for each series, takes time in proportion to the square of the file
    assert "collect_list" not in plan(found)
    assert rows(found.select("entity_code", "variable")) == sorted([*((f"{v}-{k}", str(v)) for v in range(400) for k in range(v % 4)), ("9", None)])


def test_a_broken_series_file_does_not_stop_the_other_series(spark, tmp_path):
    for code, text in {1: '[{"data": "01/01/2020", "valor": "1"}]', 2: '[{"data": "01/01/2020", "val'}.items():
        (tmp_path / f"series_code={code}").mkdir()
        (tmp_path / f"series_code={code}" / "p.json").write_text(text)
    got = read_series(spark, str(tmp_path), series_catalogue(spark, {"a": 1, "b": 2}), "api")
    assert rows(got.select("series_code", "date_text")) == [(1, "01/01/2020")]
    assert rows(broken_series(spark, str(tmp_path))) == [(2, 1)]


def test_a_broken_file_fails_its_source(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps(RESPONSE), encoding="utf-8")
    (tmp_path / "cut.json").write_text(json.dumps(RESPONSE)[:200], encoding="utf-8")
    with pytest.raises(Exception, match="FAILFAST"):
        read_aggregates(spark, str(tmp_path), "population").collect()


def test_default_catalogue(spark):
    assert series_catalogue(spark).count() == len(DEFAULT_SERIES) == 16


def test_period_choice(spark):
    df = spark.createDataFrame([(2020,), (2021,), (2024,)], "period int")
    assert rows(pick_periods(df, "period", 2021, [2020])) == [(2021,)]
    assert rows(pick_periods(df, "period", None, [2020, 2024])) == [(2020,), (2024,)]


def test_trailing_window_bounds_are_inclusive(spark):
    days = ["2018-12-31", "2019-01-01", "2020-06-01", "2020-12-31", "2021-01-01"]
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "d date")
    got = [str(r[0]) for r in trailing_window(df, "d", as_of=dt.date(2020, 12, 31), years=2).collect()]
    assert got == ["2019-01-01", "2020-06-01", "2020-12-31"]
    between = trailing_window(df, "d", first=dt.date(2020, 6, 1), last=dt.date(2020, 12, 31))
    assert between.count() == 2
    assert trailing_window(df, "d", first=dt.date(2020, 6, 1)).count() == 5


def test_forced_schema(spark, tmp_path):
    spark.range(3).selectExpr("id", "id * 2 as other").write.parquet(str(tmp_path / "t"))
    assert read_table(spark, str(tmp_path / "t"), "id bigint, absent string").columns == ["id", "absent"]
    assert read_table(spark, str(tmp_path / "t")).columns == ["id", "other"]


def test_a_landing_brings_its_own_rejects(spark, tmp_path):
    from tidemark.plans.lakehouse import bronze_jobs
    from tidemark.plans.run import Lake, run_layer
    from tidemark.sources.series import series_landing

    (tmp_path / "in" / "series_code=1").mkdir(parents=True)
    (tmp_path / "in" / "series_code=1" / "p.json").write_text('[{"data": "01/01/2020", "valor": "1"}, {"data": "02/01/2020", "val')
    catalogue = series_catalogue(spark, {"a": 1})
    jobs = bronze_jobs({"series": lambda lake: series_landing(spark, str(tmp_path / "in"), catalogue, "api")}, entities_enabled=False)
    report = run_layer(Lake(spark, str(tmp_path / "lake")), "bronze", jobs, []).report[-1]
    assert (report[1], report[2], report[3], report[5]) == ("series", "done", 1, "points: 1")


def test_series_meet_their_catalogue_without_a_task_for_each(spark):
    raw = spark.createDataFrame([(433, "01/01/2020", "1.5")], "series_code int, data string, valor string")
    landed = land_series(raw, series_catalogue(spark), "api")
    assert "BroadcastHashJoin" in plan(landed) and "SortMergeJoin" not in plan(landed)
    assert [(r.series_name, str(r.value)) for r in landed.collect()] == [("ipca_mensal", "1.5000")]
