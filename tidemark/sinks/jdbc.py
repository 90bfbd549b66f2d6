"""SQL tables over JDBC. URL, driver and credentials come from the caller."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.names import TABLE_NAMES, surveyed_names, with_surveyed_names
from tidemark.sinks.contract import CONTRACTS, Contract, require_contract, to_contract

WRITE_MODES = ("overwrite", "append", "ignore", "error")

# Tables in the order of their foreign keys, and those that must exist in the lake.
TABLES = ["dim_entity", "dim_period", "fact_entity", "fact_group", "fact_nation"]
REQUIRED_TABLES = ["dim_period", "fact_nation"]


@dataclass(frozen=True)
class JdbcTarget:
    """Where to write; ``connections`` bounds the parallel connections, and so the write tasks.

    ``surveyed`` takes the table and column names of the surveyed schema; ``suffix`` is put behind every table name.
    """

    url: str
    driver: str
    user: str | None = None
    password: str | None = None
    schema: str | None = None
    connections: int = 8
    surveyed: bool = False
    suffix: str = ""
    extra: dict[str, str] = field(default_factory=dict)

    def table(self, name: str) -> str:
        name = (TABLE_NAMES.get(name, name) if self.surveyed else name) + self.suffix
        return f"{self.schema}.{name}" if self.schema else name

    def options(self, name: str) -> dict[str, str]:
        values = {"url": self.url, "dbtable": self.table(name), "driver": self.driver}
        values |= {"numPartitions": str(self.connections), "batchsize": "10000"}
        if self.user is not None:
            values |= {"user": self.user, "password": self.password or ""}
        return values | self.extra


def export_table(
    df: DataFrame, name: str, target: JdbcTarget, mode: str = "overwrite", contract: Contract | None = None
) -> None:
    """Write one table, cast to its contract if one is given.

    A row that does not fit the contract fails the table with the counts per column; nothing is written then.
    An overwrite truncates an existing table, so declared keys and types stay. Where the database refuses to
    truncate a table that foreign keys refer to, switch these off before, or delete the rows in reverse order of
    ``TABLES`` and append.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}, not {mode}")
    out = df
    if contract is not None:
        require_contract(df, contract)
        out = to_contract(df, contract)
    names = surveyed_names(out.columns, "gold") if target.surveyed else {}
    out = with_surveyed_names(out, "gold") if target.surveyed else out
    writer = out.write.format("jdbc").options(**target.options(name)).mode(mode)
    if mode == "overwrite":
        writer = writer.option("truncate", "true")
    if contract is not None and (texts := _text_types(contract, names)):
        writer = writer.option("createTableColumnTypes", texts)
    writer.save()


def create_if_absent(df: DataFrame, name: str, target: JdbcTarget, contract: Contract | None = None) -> None:
    """Create an empty table with the columns of ``df``, or of the contract, unless it exists."""
    export_table(df.limit(0), name, target, "ignore", contract)


def create_all(load: Callable[[str], DataFrame | None], target: JdbcTarget, tables: list[str] | None = None) -> list[str]:
    """Create the empty tables the target lacks; return the names the lake holds."""
    held = []
    for name in tables or TABLES:
        df = load(name)
        if df is not None:
            create_if_absent(df, name, target, CONTRACTS.get(name))
            held.append(name)
    return held


def _text_types(contract: Contract, names: dict[str, str]) -> str:
    return ", ".join(f"{names.get(name, name)} {t}" for name, t in contract.types.items() if t.startswith("varchar"))


def export_all(
    spark: SparkSession,
    load: Callable[[str], DataFrame | None],
    target: JdbcTarget,
    mode: str = "overwrite",
    tables: list[str] | None = None,
) -> DataFrame:
    """Export the modelled tables and return one status row each.

    ``load`` returns a table, or None when the lake does not hold it. Failures
    are recorded and the remaining tables still exported.
    """
    status = []
    for name in tables or TABLES:
        try:
            df = load(name)
            if df is None:
                missing = "required table missing" if name in REQUIRED_TABLES else "optional table missing"
                status.append((name, False, missing))
                continue
            export_table(df, name, target, mode, CONTRACTS.get(name))
            status.append((name, True, None))
        except Exception as error:  # one table must not stop the others
            status.append((name, False, str(error)))
    return spark.createDataFrame(status, "table string, exported boolean, message string")


class Connection:
    """One transaction on the target, from the driver: a few statements, no rows."""

    def __init__(self, spark: SparkSession, target: JdbcTarget):
        spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(target.driver)
        properties = spark._jvm.java.util.Properties()
        for key, value in {"user": target.user, "password": target.password}.items():
            if value is not None:
                properties.setProperty(key, value)
        self._held: JavaObject = spark._jvm.java.sql.DriverManager.getConnection(target.url, properties)
        self._held.setAutoCommit(False)

    def execute(self, statement: str) -> None:
        self._held.createStatement().execute(statement)

    def number(self, statement: str) -> int:
        found = self._held.createStatement().executeQuery(statement)
        found.next()
        return found.getLong(1)

    def commit(self) -> None:
        self._held.commit()

    def rollback(self) -> None:
        self._held.rollback()

    def close(self) -> None:
        self._held.close()


def export_whole(
    spark: SparkSession,
    load: Callable[[str], DataFrame | None],
    target: JdbcTarget,
    tables: list[str] | None = None,
    connect: Callable[[SparkSession, JdbcTarget], Connection] = Connection,
) -> DataFrame:
    """Export the modelled tables so that readers see all of them new or all of them old; one status row each.

    Spark writes each table beside its own first (suffix ``_next``). When all rows are there, one transaction empties the
    tables in reverse order of their foreign keys and fills them in order, by statements within the database; so
    declared keys and types stay. Whatever fails, the transaction is undone and the side tables are dropped; the
    message of the failure is in every row then. A missing required table is such a failure, a missing optional one is not.
    """
    names, beside = tables or TABLES, replace(target, suffix="_next")
    held = {name: load(name) for name in names}
    found = [name for name in names if held[name] is not None]
    error = next((f"required table missing: {name}" for name in names if held[name] is None and name in REQUIRED_TABLES), None)
    if error is None:
        try:
            for name in found:
                create_if_absent(held[name], name, target, CONTRACTS.get(name))
                export_table(held[name], name, beside, "overwrite", CONTRACTS.get(name))
            _take_over(connect(spark, target), held, found, target, beside)
        except Exception as failure:  # reported, as by export_all
            error = str(failure)
    optional = "optional table missing"
    status = [(name, error is None and name in found, error or (None if name in found else optional)) for name in names]
    return spark.createDataFrame(status, "table string, exported boolean, message string")


def _take_over(connection: Connection, held: dict, found: list[str], target: JdbcTarget, beside: JdbcTarget) -> None:
    try:
        for name in found:
            written, expected = connection.number(f"SELECT count(*) FROM {beside.table(name)}"), held[name].count()
            if written != expected:
                raise ValueError(f"{beside.table(name)} has {written} of {expected} rows")
        for name in reversed(found):
            connection.execute(f"DELETE FROM {target.table(name)}")
        for name in found:
            columns = ", ".join(_columns(held[name], name, target))
            connection.execute(f"INSERT INTO {target.table(name)} ({columns}) SELECT {columns} FROM {beside.table(name)}")
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        for name in found:
            connection.execute(f"DROP TABLE {beside.table(name)}")
        connection.commit()
        connection.close()


def _columns(df: DataFrame, name: str, target: JdbcTarget) -> list[str]:
    out = to_contract(df, CONTRACTS[name]) if name in CONTRACTS else df
    return (with_surveyed_names(out, "gold") if target.surveyed else out).columns
