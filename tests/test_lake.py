import datetime as dt
from dataclasses import replace

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from tidemark.functions.names import with_surveyed_names
from tidemark.plans.run import FullRun, Job, Lake, report_frame, run_layer
from tidemark.quality.rules import DatasetRules
from tidemark.sinks.contract import CONTRACTS, Contract, ContractBroken, contract_violations, require_contract, to_contract
from tidemark.sinks.jdbc import JdbcTarget, create_all, create_if_absent, export_all, export_table, export_whole
from tidemark.sinks import folders, retention
from tidemark.sinks.parquet import layout_of, retained, write_table
from tidemark.sinks.retention import expire
from tidemark.staging import shared_root
from workload import lake, star  # noqa: F401  register their queries
from workload.registry import QUERIES


def periods(spark, data):
    return spark.createDataFrame(data, "v int, period int, source string")


def test_overwrite_replaces_only_its_partitions_unless_full(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_table(periods(spark, [(1, 2020, "a"), (2, 2021, "a")]), path, partition_by=["period", "source"]) == 2
    assert write_table(periods(spark, [(9, 2021, "a")]), path, partition_by=["period", "source"]) == 1
    assert rows(spark.read.parquet(path)) == [(1, 2020, "a"), (9, 2021, "a")]
    write_table(periods(spark, [(5, 2022, "a")]), path, partition_by=["period", "source"], full=True)
    assert rows(spark.read.parquet(path)) == [(5, 2022, "a")]


def test_a_large_partition_of_one_task_is_written_by_several(spark, tmp_path):
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    for name, size in sizes.items():
        spark.conf.set(name, size)
    try:
        df = spark.range(0, 40_000, 1, 1).selectExpr("sha2(string(id), 256) AS v", "2020 AS period", "map('a', id) AS m")
        assert write_table(df, str(tmp_path / "t"), partition_by=["period"]) == 40_000
    finally:
        for name in sizes:
            spark.conf.unset(name)
    written = spark.read.parquet(str(tmp_path / "t"))
    assert written.count() == 40_000 and written.columns == ["v", "m", "period"] and len(written.inputFiles()) > 4


def test_write_modes_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(periods(spark, [(1, 2020, "a")]), path)
    write_table(periods(spark, [(2, 2020, "a")]), path, mode="append", compression="zstd")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(Exception, match="exist"):
        write_table(periods(spark, [(3, 2020, "a")]), path, mode="error")
    assert write_table(periods(spark, [(9, 2020, "a")]), path, mode="ignore") is None
    assert spark.read.parquet(path).count() == 2
    assert write_table(periods(spark, []), str(tmp_path / "empty")) == 0
    assert spark.read.parquet(str(tmp_path / "empty")).columns == ["v", "period", "source"]


def test_layouts(spark):
    df = periods(spark, [])
    assert layout_of("bronze", df) == ["period", "source"]
    assert layout_of("silver", df) == ["period"]
    assert layout_of("gold", df) == []
    assert layout_of("bronze", df.select("v")) == []


def test_retention_counts_rows_without_sorting_them(spark, tmp_path):
    path, today = str(tmp_path / "t"), dt.date(2024, 6, 1)
    data = [(1, 2023, dt.date(2024, 1, 1)), (2, 2024, dt.date(2024, 5, 1)), (3, 2024, dt.date(2020, 1, 1))]
    write_table(spark.createDataFrame(data, "v int, period int, load_date date"), path, partition_by=["period"])
    found = retention.survey(spark.read.parquet(path), "bronze", today)
    assert plan(found).split("FileScan")[0].rsplit("Aggregate(", 1)[0].endswith("Hash")
    assert rows(found.drop("file")) == [(2023, 1, 0), (2024, 2, 1)]
    nothing = spark.read.parquet(path).where("v > 9").drop("period")
    assert [(r["rows"], r["kept"]) for r in retention.survey(nothing, "bronze", today).collect()] == [(0, 0)]


def test_retention(spark, tmp_path):
    data = [(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 5, 1)), (3, dt.date(2020, 1, 1))]
    df = spark.createDataFrame(data, "v int, load_date date")
    today = dt.date(2024, 6, 1)
    assert [r.v for r in retained(df, "bronze", today).collect()] == [2]
    assert sorted(r.v for r in retained(df, "silver", today).collect()) == [1, 2]
    assert retained(df, "gold", today).count() == 3
    write_table(df, str(tmp_path / "a"))
    assert expire(spark, str(tmp_path / "a"), "silver", today) == 2
    assert spark.read.parquet(folders.current(spark, str(tmp_path / "a"))).count() == 2


def test_expired_rows_leave_a_table(spark, tmp_path):
    lake, today = Lake(spark, str(tmp_path)), dt.date(2024, 6, 1)
    df = spark.createDataFrame([(1, 2020, dt.date(2024, 1, 1)), (2, 2021, dt.date(2024, 5, 1))], "v int, period int, load_date date")
    write_table(df, lake.path("bronze", "measure"), partition_by=["period"])
    path = lake.path("bronze", "measure")
    assert expire(spark, path, "bronze", today) == 1 and expire(spark, path, "bronze", today) is None
    assert [r.v for r in lake.read("bronze", "measure").collect()] == [2]
    assert expire(spark, lake.path("bronze", "absent"), "bronze", today) is None
    assert expire(spark, path, "bronze", dt.date(2030, 1, 1)) == 0 and lake.find("bronze", "measure") is None


def mixed_table(spark, path):
    """One partition within its time, one past it, one with rows of both, one without any date."""
    days = {1: (2024, dt.date(2024, 5, 1)), 2: (2020, dt.date(2023, 1, 1)), 3: (2021, dt.date(2023, 1, 1)), 4: (2021, dt.date(2024, 5, 2)), 5: (2019, None)}
    df = spark.createDataFrame([(v, period, day, "a b/%") for v, (period, day) in days.items()], "v int, period int, load_date date, source string")
    write_table(df, path, partition_by=["period", "source"])


def test_only_partitions_that_lose_some_rows_make_a_new_version(spark, tmp_path, monkeypatch):
    path, today = str(tmp_path / "t"), dt.date(2024, 6, 1)
    mixed_table(spark, path)
    read = []
    written = retention.write_table
    monkeypatch.setattr(retention, "write_table", lambda df, *a, **k: (read.extend(df.inputFiles()), written(df, *a, **k))[1])
    assert expire(spark, path, "bronze", today) == 2
    assert rows(spark.read.parquet(folders.current(spark, path)).select("v", "period", "source")) == [(1, 2024, "a b/%"), (4, 2021, "a b/%")]
    assert folders.names(spark, path) == ["_versions"] and folders.names(spark, f"{path}/_versions") == ["1"]
    # the next landing and the next retention work on the version
    write_table(spark.createDataFrame([(6, 2024, dt.date(2023, 1, 1), "a b/%")], "v int, period int, load_date date, source string"), folders.current(spark, path), partition_by=["period", "source"])
    assert expire(spark, path, "bronze", today) == 1
    assert [r.v for r in spark.read.parquet(folders.current(spark, path)).collect()] == [4]


@pytest.mark.parametrize("died_in", ["write_table", "publish", "forget_others", "delete"])
def test_a_run_that_dies_leaves_a_whole_table(spark, tmp_path, monkeypatch, died_in):
    path, today = str(tmp_path / "t"), dt.date(2024, 6, 1)
    mixed_table(spark, path)
    place = retention if died_in == "write_table" else folders
    whole, calls = getattr(place, died_in), []

    def dies(*args, **kwargs):
        calls.append(args)
        # the first call of these two is the clean-up before any work
        if died_in in ("forget_others", "delete") and len(calls) == 1:
            return whole(*args, **kwargs)
        if died_in == "write_table":
            whole(*args, **kwargs)
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(place, died_in, dies)
        with pytest.raises(RuntimeError, match="killed"):
            expire(spark, path, "bronze", today)
    seen = sorted(r.v for r in spark.read.parquet(folders.current(spark, path)).collect())
    assert seen == ([1, 4] if died_in in ("forget_others", "delete") else [1, 2, 3, 4, 5])
    expire(spark, path, "bronze", today)
    assert sorted(r.v for r in spark.read.parquet(folders.current(spark, path)).collect()) == [1, 4]
    assert folders.names(spark, path) == ["_versions"] and len(folders.names(spark, f"{path}/_versions")) == 1


SMALL = Contract({"k": "bigint", "name": "varchar(3)", "v": "decimal(5,2)", "absent": "int"}, ["k", "name"], ["k"])


def test_contract(spark):
    df = spark.createDataFrame([(1, "abc", 1.234), (2, "abcd", 99999.0), (None, None, None)], "k int, name string, v double")
    assert to_contract(df, SMALL).dtypes == [("k", "bigint"), ("name", "string"), ("v", "decimal(5,2)"), ("absent", "int")]
    assert [(r.k, r.name, str(r.v)) for r in to_contract(df, SMALL).orderBy("k").collect()] == [
        (None, None, "None"),
        (1, "abc", "1.23"),
        (2, None, "None"),
    ]
    assert rows(contract_violations(df, SMALL)) == [("absent", 0), ("k", 1), ("name", 2), ("v", 1)]
    with pytest.raises(ContractBroken, match="k: 1, name: 2, v: 1"):
        require_contract(df, SMALL)
    require_contract(df.filter("k = 1"), SMALL)
    beyond = df.selectExpr("*", "7 AS more")
    assert to_contract(beyond, SMALL).columns == ["k", "name", "v", "absent", "more"]
    assert SMALL.with_lengths(name=4).types["name"] == "varchar(4)" and SMALL.types["name"] == "varchar(3)"


def test_fact_contract_holds_growth_of_any_size(spark, tmp_path):
    """An order of next to nothing makes the next year's total grow by more than decimal(10,4) holds."""
    source = "/root/testdata/sf0.001"
    for name in ("region", "nation", "customer", "lineitem"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{source}/{name}.parquet")
    orders = spark.read.parquet(f"{source}/orders.parquet").where("o_orderstatus <> 'P'")
    yearly = orders.groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("first"), F.countDistinct(F.year("o_orderdate")).alias("years"))
    chosen = yearly.where("years > 3").orderBy("o_custkey").first()
    tiny = (F.col("o_custkey") == chosen["o_custkey"]) & (F.year("o_orderdate") == chosen["first"])
    orders.withColumn("o_totalprice", F.when(tiny, F.lit(0.01)).otherwise(F.col("o_totalprice"))).write.parquet(str(tmp_path / "orders.parquet"))
    fact = QUERIES["contract_fact_entity"](spark, str(tmp_path))
    plain = QUERIES["fact_entity"](spark, str(tmp_path)).agg(F.count("*"), F.round(F.max("growth_total"), 4)).first()
    assert tuple(fact.agg(F.count("*"), F.max("growth_total")).first()) == tuple(plain)
    assert plain[1] > 1_000_000


def test_export_of_rows_that_do_not_fit_writes_nothing(spark, monkeypatch):
    saved = Saved().install(monkeypatch)
    df = spark.createDataFrame([(1, "abcd", 1.0)], "k int, name string, v double")
    with pytest.raises(ContractBroken, match="name: 1"):
        export_table(df, "t", TARGET, contract=SMALL)
    assert saved == []


def test_export_under_the_surveyed_names(spark, monkeypatch):
    saved = Saved().install(monkeypatch)
    row = (1, "0100001", "a", "01", "AA", "g", "1", "r", "R")
    entities = spark.createDataFrame([row], "entity_key long, " + ", ".join(f"{c} string" for c in list(CONTRACTS["dim_entity"].types)[1:]))
    export_table(entities, "dim_entity", replace(TARGET, surveyed=True), contract=CONTRACTS["dim_entity"])
    (_, options, columns, _), = saved
    assert options["dbtable"] == "s.dim_municipio" and columns[:2] == [("sk_municipio", "bigint"), ("codigo_municipio", "string")]
    assert "nome_uf varchar(100)" in options["createTableColumnTypes"]


class Saved(list):
    """Stands in for the save of a JDBC write: no database may be started here."""

    def install(self, monkeypatch):
        seen = self

        def options(writer, **values):
            writer._seen = dict(values)
            return writer

        def option(writer, key, value):
            writer.__dict__.setdefault("_seen", {})[key] = value
            return writer

        def mode(writer, value):
            writer._mode = value
            return writer

        def save(writer, *args):
            if writer._seen["dbtable"].endswith("broken"):
                raise RuntimeError("connection refused")
            seen.append((writer._mode, writer._seen, writer._df.dtypes, writer._df.count()))

        for name, function in {"options": options, "option": option, "mode": mode, "save": save}.items():
            monkeypatch.setattr(DataFrameWriter, name, function)
        return self


TARGET = JdbcTarget("jdbc:x://h/db", "x.Driver", "u", "p", schema="s", connections=4)


def test_jdbc_options_per_mode(spark, monkeypatch):
    saved = Saved().install(monkeypatch)
    df = spark.createDataFrame([(1, "abc", 1.0)], "k int, name string, v double")
    for mode in ("overwrite", "append", "ignore", "error"):
        export_table(df, "t", TARGET, mode)
    create_if_absent(df, "t", TARGET, SMALL)
    modes = [(m, o.get("truncate"), o["dbtable"], o["numPartitions"], n) for m, o, _, n in saved]
    assert modes == [
        ("overwrite", "true", "s.t", "4", 1),
        ("append", None, "s.t", "4", 1),
        ("ignore", None, "s.t", "4", 1),
        ("error", None, "s.t", "4", 1),
        ("ignore", None, "s.t", "4", 0),
    ]
    assert saved[-1][1]["createTableColumnTypes"] == "name varchar(3)"
    assert saved[-1][2][2] == ("v", "decimal(5,2)")
    with pytest.raises(ValueError, match="mode"):
        export_table(df, "t", TARGET, "upsert")


def test_export_all_reports_missing_and_failed_tables(spark, monkeypatch):
    Saved().install(monkeypatch)
    period = spark.createDataFrame([(1, 2020, 1, 1)], "period_key int, period int, half int, quarter int")
    tables = {"dim_period": period, "broken": period}
    monkeypatch.setitem(CONTRACTS, "broken", CONTRACTS["dim_period"])
    status = export_all(spark, tables.get, TARGET, tables=["dim_period", "fact_nation", "dim_entity", "broken"])
    assert [tuple(r) for r in status.collect()] == [
        ("dim_period", True, None),
        ("fact_nation", False, "required table missing"),
        ("dim_entity", False, "optional table missing"),
        ("broken", False, "connection refused"),
    ]


class Recorded:
    """A connection that records its statements, and fails at one that is told."""

    def __init__(self, counts, fails_at=None):
        self.seen, self.counts, self.fails_at = [], counts, fails_at

    def __call__(self, spark, target):
        return self

    def execute(self, statement):
        self.seen.append(statement)
        if self.fails_at and statement.startswith(self.fails_at):
            raise RuntimeError("deadlock")

    def number(self, statement):
        return self.counts[statement.rsplit(".", 1)[1]]

    def __getattr__(self, name):
        return lambda: self.seen.append(name)


def test_whole_export_is_one_transaction(spark, monkeypatch):
    saved = Saved().install(monkeypatch)
    period = spark.createDataFrame([(1, 2020, 1, 1), (2, 2021, 2, 2)], "period_key int, period int, half int, quarter int")
    nation = spark.createDataFrame([(2020, 1, 5, 2.0)], "period int, groups int, measure bigint, total double")
    monkeypatch.setitem(CONTRACTS, "fact_nation", Contract({"period": "int", "groups": "int"}, ["period"], ["period"]))
    tables = {"dim_period": period, "fact_nation": nation}
    columns = "period_key, period, half, quarter"
    drops = ["DROP TABLE s.dim_period_next", "DROP TABLE s.fact_nation_next", "commit", "close"]
    swap = [
        "DELETE FROM s.fact_nation",
        "DELETE FROM s.dim_period",
        f"INSERT INTO s.dim_period ({columns}) SELECT {columns} FROM s.dim_period_next",
        "INSERT INTO s.fact_nation (period, groups, measure, total) SELECT period, groups, measure, total FROM s.fact_nation_next",
    ]
    counts = {"dim_period_next": 2, "fact_nation_next": 1}
    good = Recorded(counts)
    status = export_whole(spark, tables.get, TARGET, connect=good)
    assert good.seen == [*swap, "commit", *drops]
    assert {r.table: (r.exported, r.message) for r in status.collect()} == {
        **{name: (True, None) for name in tables}, **{name: (False, "optional table missing") for name in ("dim_entity", "fact_entity", "fact_group")}
    }
    assert [(mode, options["dbtable"]) for mode, options, *_ in saved] == [
        ("ignore", "s.dim_period"), ("overwrite", "s.dim_period_next"), ("ignore", "s.fact_nation"), ("overwrite", "s.fact_nation_next")
    ]

    broken = Recorded(counts, "INSERT INTO s.fact_nation")
    status = export_whole(spark, tables.get, TARGET, connect=broken)
    assert broken.seen == [*swap, "rollback", *drops] and {r.message for r in status.collect()} == {"deadlock"}
    short = Recorded({**counts, "fact_nation_next": 0})
    status = export_whole(spark, tables.get, TARGET, connect=short)
    assert short.seen == ["rollback", *drops] and {r.message for r in status.collect()} == {"s.fact_nation_next has 0 of 1 rows"}
    unused = Recorded(counts)
    status = export_whole(spark, {"dim_period": period}.get, TARGET, connect=unused)
    assert not unused.seen and {(r.exported, r.message) for r in status.collect()} == {(False, "required table missing: fact_nation")}


def test_create_all_makes_empty_tables_of_what_the_lake_holds(spark, monkeypatch):
    saved = Saved().install(monkeypatch)
    period = spark.createDataFrame([(1, 2020, 1, 1)], "period_key int, period int, half int, quarter int")
    assert create_all({"dim_period": period}.get, TARGET) == ["dim_period"]
    assert [(mode, options["dbtable"], n) for mode, options, _, n in saved] == [("ignore", "s.dim_period", 0)]


def test_surveyed_names(spark):
    gold = spark.createDataFrame([], "period int, measure bigint, total double, x_mean double, x_max double")
    assert with_surveyed_names(gold, "gold").columns == ["ano", "populacao_total", "pib_total", "x_medio", "x_max"]
    silver = spark.createDataFrame([], "entity_code string, measure bigint")
    assert with_surveyed_names(silver, "silver").columns == ["codigo_municipio", "populacao"]
    series = spark.createDataFrame([], "series_code int, date_text string, value_text string, value double")
    assert with_surveyed_names(series, "silver").columns == ["serie_codigo", "data", "valor", "valor_decimal"]


def test_layer_run_goes_on_after_a_failure(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))

    def broken(lake):
        raise RuntimeError("source down")

    jobs = [
        Job("good", lambda lake: periods(spark, [(1, 2020, "a"), (1, 2020, "a")])),
        Job("bad", broken),
        Job("after", lambda lake: periods(spark, []), needs=["bad"]),
        Job("off", broken, enabled=False),
    ]
    rules = [DatasetRules("silver", "good", ["v"], ["v"], ["v"])]
    run = run_layer(lake, "silver", jobs, rules)
    report = {r.dataset: (r.status, r.rows, r.message) for r in report_frame(spark, [run]).collect()}
    assert report == {
        "good": ("done", 2, None),
        "bad": ("failed", None, "source down"),
        "after": ("skipped", None, "needs bad"),
        "off": ("disabled", None, None),
    }
    assert run.pass_rate == 75.0 and run.rows == 2
    counted = Job("counted", lambda lake: periods(spark, [(1, 2020, "a")]), rejects=lambda lake: spark.createDataFrame([(2,), (3,)], "files long"))
    assert run_layer(lake, "silver", [counted], []).report[0][-1] == "files: 5"
    unchecked = run_layer(lake, "silver", jobs[:1], rules, checks_enabled=False)
    assert unchecked.pass_rate is None
    failed = spark.createDataFrame([("t", False, "x")], "table string, exported boolean, message string")
    assert FullRun([run, unchecked], failed).overall() == {"total_rows": 4, "mean_pass_rate": 75.0, "exported": False}
    assert FullRun([run], export_error="down").overall()["exported"] is False
    assert FullRun([unchecked]).overall() == {"total_rows": 2, "mean_pass_rate": None, "exported": None}


def test_shared_root_is_the_configured_folder(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_shared_root_is_required_off_local_mode():
    class Context:
        master = "spark://cluster"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Session())


def test_series_only_lakehouse(spark, tmp_path):
    """Without entity data the period dimension and the national fact come from the series."""
    from tidemark.plans.lakehouse import run_all
    from tidemark.sources.series import land_series, series_catalogue

    def series(lake):
        raw = spark.createDataFrame(
            [("01/02/2020", "1.0", 5), ("01/03/2020", "3.0", 5), ("01/03/2021", "4.0", 5)],
            "data string, valor string, series_code int",
        )
        return land_series(raw, series_catalogue(spark, {"x": 5}), "api")

    def down(lake):
        raise RuntimeError("must not be called")

    sources = {"localities": down, "measure": down, "rate": down, "series": series}
    lake = Lake(spark, str(tmp_path))
    run = run_all(lake, sources, ["x", "y"], entities_enabled=False)
    status = {(r.layer, r.dataset): r.status for r in report_frame(spark, run.layers).collect()}
    assert status["gold", "fact_nation"] == "done" and status["gold", "fact_entity"] == "disabled"
    nation = rows(lake.read("gold", "fact_nation").select("period", "x_mean", "x_max", "y_mean"))
    assert [(p, m, str(x), y) for p, m, x, y in nation] == [(2020, 2.0, "3.0000", None), (2021, 4.0, "4.0000", None)]


def test_default_periods_and_enriched_nation(spark, tmp_path):
    """Several default periods at once; the national fact carries the series; the target cannot be reached."""
    from tidemark.plans.lakehouse import run_all
    from tidemark.sources.series import land_series, series_catalogue

    places = "entity_code string, entity_name string, group_code string, group_short string, group_name string, "
    places += "region_code string, region_name string, region_short string"
    values = "entity_code string, entity_name string, period int, value double, source string"

    def series(lake):
        raw = spark.createDataFrame([("01/02/2021", "1.0", 5)], "data string, valor string, series_code int")
        return land_series(raw, series_catalogue(spark, {"x": 5}), "api")

    sources = {
        "localities": lambda lake: spark.createDataFrame([("0100001", "a", "01", "AA", "g", "1", "r", "R")], places),
        "measure": lambda lake: spark.createDataFrame(
            [("0100001", "a", 2024, 1000.0, "m"), ("0100001", "a", 1990, 1.0, "m")], values
        ),
        "rate": lambda lake: spark.createDataFrame([("0100001", "a", 2021, 2.0, "r")], values),
        "series": series,
    }
    lake = Lake(spark, str(tmp_path))
    run = run_all(lake, sources, ["x"], None, None, enrich=True, target=TARGET)
    got = rows(lake.read("gold", "fact_nation").select("period", "groups", "measure", "total", "x_mean"))
    assert got == [(2021, 1, None, None, 1.0), (2024, 1, 1000, None, None)]
    status = {r.table: r.exported for r in run.export.collect()}
    assert set(status) == {"dim_period", "fact_nation", "dim_entity", "fact_entity", "fact_group"}
    assert not any(status.values()) and run.overall()["exported"] is False


PLACES = "entity_code string, entity_name string, group_code string, group_short string, group_name string, region_code string, region_name string, region_short string"
VALUES = "entity_code string, entity_name string, period int, value double, source string"


def small_sources(spark, measures, rates=((1, 2020, 2.0), (1, 2021, 3.0), (1, 2023, 4.0), (2, 2020, 1.0)), groups=("01", "01")):
    """Two entities; rows of values are (entity, period, value)."""
    from tidemark.sources.series import land_series, series_catalogue

    code = "010000{}".format
    places = [(code(k), "n", group, group, f"g{group}", "1", "r", "R") for k, group in enumerate(groups, 1)]
    values = lambda data, source: spark.createDataFrame([(code(k), "n", p, float(v), source) for k, p, v in data], VALUES)
    points = spark.createDataFrame([("01/02/2021", "1.0", 5)], "data string, valor string, series_code int")
    return {
        "localities": lambda lake: spark.createDataFrame(places, PLACES),
        "measure": lambda lake: values(measures, "m"),
        "rate": lambda lake: values(rates, "r"),
        "series": lambda lake: land_series(points, series_catalogue(spark, {"x": 5}), "api"),
    }


def statuses(spark, run):
    return {f"{r.layer}/{r.dataset}": r.status for r in report_frame(spark, run.layers).collect()}


def test_tables_of_an_earlier_run_never_stand_in(spark, tmp_path):
    from tidemark.plans.lakehouse import run_all

    years, lake = list(range(2019, 2025)), Lake(spark, str(tmp_path))
    sources = small_sources(spark, [(1, 2020, 10), (2, 2020, 20), (1, 2021, 30)])
    first = run_all(lake, sources, ["x"], years, years, enrich=True)
    assert set(statuses(spark, first).values()) == {"done"}

    def down(lake):
        raise RuntimeError("down")

    without = statuses(spark, run_all(lake, {**sources, "series": down}, ["x"], years, years, enrich=True))
    assert [k for k, s in without.items() if s != "done"] == ["bronze/series", "silver/series", "gold/fact_nation"]
    without = statuses(spark, run_all(lake, {**sources, "localities": down}, ["x"], years, years))
    assert [k for k, s in without.items() if s == "skipped"] == [
        "silver/localities", "gold/entity_keys", "gold/dim_entity", "gold/fact_entity", "gold/fact_group", "gold/fact_nation"
    ]
    with pytest.raises(ValueError, match="failed in this run"):
        replace(lake, hidden=frozenset({"gold/dim_entity"})).read("gold", "dim_entity")
    assert replace(lake, hidden=frozenset({"gold/dim_entity"})).find("gold", "dim_entity") is None


def test_datasets_that_wait_for_each_other_are_an_error(spark, tmp_path):
    jobs = [Job("a", lambda lake: None, needs=["b"]), Job("b", lambda lake: None, needs=["a"])]
    with pytest.raises(ValueError, match="wait for each other"):
        run_layer(Lake(spark, str(tmp_path)), "silver", jobs, [])


def test_independent_datasets_run_at_the_same_time(spark, tmp_path):
    import threading

    both = threading.Barrier(2, timeout=60)

    def build(lake):
        both.wait()
        return periods(spark, [(1, 2020, "a")])

    run = run_layer(Lake(spark, str(tmp_path)), "silver", [Job("a", build), Job("b", build)], [])
    assert [row[2] for row in run.report] == ["done", "done"]


def test_only_changed_partitions_of_the_facts_are_written(spark, tmp_path):
    from tidemark.plans.lakehouse import run_all

    years, lake, whole = list(range(2019, 2026)), Lake(spark, str(tmp_path / "a")), Lake(spark, str(tmp_path / "b"))
    old = [(1, 2020, 10), (1, 2021, 30), (1, 2022, 5), (1, 2023, 40), (2, 2020, 20), (2, 2024, 50)]
    options = {"checks_enabled": False, "gold_by_period": True}

    def files(name):
        return {p: sorted(folders.names(spark, f"{lake.folder('gold', name)}/{p}")) for p in folders.names(spark, lake.folder("gold", name)) if "=" in p}

    def changed(name, before):
        return {p for p, held in files(name).items() if held != before.get(p)}

    def same_as_whole(sources):
        run_all(whole, sources, ["x"], years, years, checks_enabled=False)
        for name in ("fact_entity", "fact_group", "fact_nation"):
            columns = whole.read("gold", name).columns
            assert rows(lake.read("gold", name).select(*columns)) == rows(whole.read("gold", name))

    run_all(lake, small_sources(spark, old), ["x"], years, years, **options)
    same_as_whole(small_sources(spark, old))
    # entity 1 goes on in 2022 and the group too; entity 2 has no row in 2021
    before = {name: files(name) for name in ("fact_entity", "fact_group")}
    new = [(k, p, 99 if p == 2021 else v) for k, p, v in old]
    run_all(lake, small_sources(spark, new), ["x"], 2021, 2021, landed=[2021], **options)
    assert changed("fact_entity", before["fact_entity"]) == {"period=2021", "period=2022"}
    assert changed("fact_group", before["fact_group"]) == {"period=2021", "period=2022"}
    same_as_whole(small_sources(spark, new))
    # a new last year touches nothing before it, a new year in between moves the later keys
    before = files("fact_entity")
    new += [(2, 2025, 7)]
    run_all(lake, small_sources(spark, new), ["x"], 2025, 2025, landed=[2025], **options)
    assert changed("fact_entity", before) == {"period=2025"}
    same_as_whole(small_sources(spark, new))
    before = files("fact_entity")
    new += [(2, 2019, 3)]
    run_all(lake, small_sources(spark, new), ["x"], 2019, 2019, landed=[2019], **options)
    assert changed("fact_entity", before) == {f"period={p}" for p in range(2019, 2026)}
    same_as_whole(small_sources(spark, new))
    # another group of an entity is another basis: everything is built again
    before = files("fact_entity")
    run_all(lake, small_sources(spark, new, groups=("01", "02")), ["x"], 2025, 2025, landed=[2025], **options)
    assert len(changed("fact_entity", before)) == 7
    same_as_whole(small_sources(spark, new, groups=("01", "02")))


def test_keys_stay_and_new_ones_follow(spark, staging):
    from tidemark.operators.keys import new_keys

    codes = lambda *held: spark.createDataFrame([(c,) for c in held], "code string")
    first = staging.freeze(new_keys(codes("m", "c", "c", None, "x"), None, "code", "key", staging), "first")
    assert rows(first) == [(0, "c"), (1, "m"), (2, "x")]
    second = new_keys(codes("a", "m", "z"), first, "code", "key", staging)
    assert rows(second) == [(3, "a"), (4, "z")]
    assert rows(new_keys(codes("c"), first, "code", "key", staging)) == []
    assert rows(new_keys(codes("q"), first.limit(0), "code", "key", staging)) == [(0, "q")]
