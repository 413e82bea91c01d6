"""Event-time expressions. All of them assume the session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.contract import MONEY

# The epoch-microsecond range of a valid event, both ends included.
EPOCH_US_MIN = 1_000_000_000_000_000
EPOCH_US_MAX = 9_999_999_999_999_999


def in_epoch_range(epoch_us: Column) -> Column:
    return epoch_us.between(F.lit(EPOCH_US_MIN), F.lit(EPOCH_US_MAX))


def event_time_of(epoch_us: Column) -> Column:
    """Event time cut to whole milliseconds; NULL outside the valid range."""
    millis = F.call_function("div", epoch_us, F.lit(1000))
    return F.when(in_epoch_range(epoch_us), F.timestamp_millis(millis))


def hour_parts(ts: Column) -> list[Column]:
    """The four partition columns of a timestamp."""
    return [
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"),
    ]


def utc_now() -> Column:
    """The current time without a zone: one value per query or micro-batch."""
    return F.current_timestamp().cast("timestamp_ntz")


def epoch_micros(ts: Column) -> Column:
    """Epoch microseconds of a timestamp with or without a zone."""
    return F.unix_micros(ts.cast("timestamp"))


def money(amount: Column) -> Column:
    """Two decimal places, rounded half up on the decimal digits of the value."""
    return F.round(amount, 2).cast(MONEY)
