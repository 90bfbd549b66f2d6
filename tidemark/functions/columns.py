"""Scalar column rules, all built from JVM-side functions."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Fixed values of the source format: the marker for "not available".
MISSING_MARKER = "..."


def standard_name(name: str | Column) -> Column:
    """Upper case, surrounding spaces removed."""
    return F.trim(F.upper(name))


def code_prefix(code: str | Column, length: int = 2) -> Column:
    """Leading characters of a hierarchical code (group code of an entity)."""
    return F.substring(code, 1, length)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; a value that does not fit becomes null."""
    return df.withColumns({name: F.col(name).try_cast(t) for name, t in types.items()})


def tag_literals(df: DataFrame, tags: dict[str, object]) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in tags.items()})


def audit_columns(df: DataFrame, processed_at: dt.datetime | None = None) -> DataFrame:
    """Add processing time and load date; pass the time to make reruns repeatable."""
    if processed_at is None:
        stamp, day = F.current_timestamp(), F.current_date()
    else:
        # As text the time is read in the session's zone, whatever the zone of this process.
        stamp, day = F.lit(str(processed_at)).cast("timestamp"), F.lit(processed_at.date())
    return df.withColumns({"processed_at": stamp, "load_date": day})


def parse_date(parsed: str | Column, raw: str | Column, fmt: str = "dd/MM/yyyy") -> Column:
    """Keep an already parsed date, else parse the text; a bad text gives null."""
    return F.coalesce(_col(parsed), F.try_to_date(_col(raw), fmt))


def parse_decimal(parsed: str | Column, raw: str | Column, type_: str = "decimal(18,4)") -> Column:
    """Keep an already parsed number, else parse the text; a bad text gives null."""
    return F.coalesce(_col(parsed), _col(raw).try_cast(type_))


NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def value_text(raw: str | Column) -> Column:
    """Text of a value in an aggregates response: the value itself, or ``valor`` of an object."""
    raw = _col(raw)
    return F.when(F.startswith(raw, F.lit("{")), F.get_json_object(raw, "$.valor")).otherwise(raw)


def decode_value(raw: str | Column) -> Column:
    """Number in an aggregates response; the missing marker, empty text and other non-numbers give null.

    Only plain decimal notation counts: a cast alone would also take a type suffix, NaN and infinity.
    """
    # The frequent non-numbers are told apart first: a failing cast is many times slower.
    text = value_text(raw)
    return F.when(~text.isin(MISSING_MARKER, "") & text.rlike(NUMBER), text.try_cast("double"))


def decode_period(text: str | Column) -> Column:
    """Period of all-digit text, null for any other."""
    return F.when(_col(text).rlike("^[0-9]+$"), _col(text).try_cast("int"))


def with_total(df: DataFrame, rate: str, measure: str, name: str) -> DataFrame:
    """Add rate times measure in thousands; null where either side is null.

    A decimal rate gives an exact decimal, whose sums do not depend on row
    order; any other rate gives a double.
    """
    rate_type = df.schema[rate].dataType
    product = F.col(rate) * F.col(measure)
    if isinstance(rate_type, DecimalType):
        exact = product.cast(DecimalType(28, rate_type.scale))
        return df.withColumn(name, exact * F.lit(Decimal("0.001")))
    return df.withColumn(name, product.cast("double") / 1000)


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Quotient as double; null for a zero or null denominator."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def percent(part: str | Column, whole: str | Column) -> Column:
    """Part of whole in percent; null for a zero or null whole."""
    return ratio(part, whole) * 100


def round2(value: str | Column) -> Column:
    """Two decimals, halves up, for reported percentages."""
    return F.floor(_col(value) * 100 + 0.5) / 100


def period_half(period: str | Column) -> Column:
    """Pseudo half-year of the period dimension: 1 for even years, 2 for odd ones."""
    return F.when(_col(period) % 2 == 0, 1).otherwise(2)


def period_quarter(period: str | Column) -> Column:
    """Pseudo quarter of the period dimension: year modulo four, plus one."""
    return (_col(period) % 4 + 1).cast("int")


def year_month(df: DataFrame, date: str, year: str = "year", month: str = "month") -> DataFrame:
    """Add year and month of a date column."""
    return df.withColumns({year: F.year(date), month: F.month(date)})


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
