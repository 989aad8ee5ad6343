"""Small Column expressions shared by the operators."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_missing(column: str) -> Column:
    """NULL or the empty string. Never NULL itself."""
    value = F.col(column)
    return value.isNull() | (value == "")


def blank_to_null(column: str) -> Column:
    """Strip spaces (only spaces) and turn what is then empty into NULL."""
    return F.nullif(F.trim(F.col(column)), F.lit("")).alias(column)


def day_of(column: str) -> Column:
    return F.col(column).cast("date")


def day_of_week(day: Column) -> Column:
    """Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(day) - F.lit(1)


def moment(at: datetime) -> Column:
    """Literal without a time zone, whatever the zone of the driver or the session."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def cutoff(as_of: date, days: int) -> date:
    """First day of a window of ``days`` days before ``as_of``; the day itself is inside."""
    return as_of - timedelta(days=days)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL, not an error, for a zero or NULL denominator."""
    return numerator / F.nullif(denominator, F.lit(0).cast("double"))


def to_scale(value: Column, kind: T.DecimalType) -> Column:
    """Round half away from zero to the type's scale; too large a value is an error."""
    return F.round(value, kind.scale).cast(kind)
