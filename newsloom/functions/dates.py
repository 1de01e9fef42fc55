"""Column expressions over dates. All days are UTC days, whatever the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, TimestampType

_CLOCK_WITH_OFFSET = r":\d\d(\.\d+)?\s*[+-]\d\d(:?\d\d)?$"


def utc_date(value: Column, dtype: DataType) -> Column:
    """Text, timestamp or date to date; text that is no date gives null.

    Text without an offset, or ending in Z, is already UTC.
    """
    if isinstance(dtype, StringType):
        plain = value.try_cast("timestamp_ntz").cast("date")
        return F.when(value.rlike(_CLOCK_WITH_OFFSET), _instant_date(F.try_to_timestamp(value))).otherwise(plain)
    if isinstance(dtype, TimestampType):
        return _instant_date(value)
    return value.cast("date")


def _instant_date(value: Column) -> Column:
    return F.to_utc_timestamp(value, F.current_timezone()).cast("date")


def leading_date(text: Column) -> Column:
    """The day written in the first ten characters, as yyyy-MM-dd; what follows is ignored."""
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def month_start(value: Column, dtype: DataType | None = None) -> Column:
    """The first instant of the month; of an instant, its month in UTC."""
    return F.date_trunc("month", _in_utc(value, dtype))


def month_key(value: Column, dtype: DataType | None = None) -> Column:
    """yyyy-MM, the partition key of the fact table; of an instant, its month in UTC."""
    return F.date_format(_in_utc(value, dtype), "yyyy-MM")


def _in_utc(value: Column, dtype: DataType | None) -> Column:
    """The wall clock of UTC. Days and clocks without a zone stay as they are."""
    if isinstance(dtype, TimestampType):
        return F.convert_timezone(None, F.lit("UTC"), value.cast("timestamp_ntz"))
    return value
