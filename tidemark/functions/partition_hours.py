"""Packed hour keys (``YYYYMMDDHH``) and the partition filters built from them.

The filters touch partition columns only, so they prune folders before any file is opened.
"""

from __future__ import annotations

import operator
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.contract import HOUR_COLUMNS

_COMPARE = {
    ">": operator.gt,
    "<": operator.lt,
    "=": operator.eq,
    "<>": operator.ne,
    "!=": operator.ne,
}


def _hour_columns(alias: str | None) -> list[Column]:
    return [F.col(f"{alias}.{name}" if alias else name) for name in HOUR_COLUMNS]


def partition_hour_key(alias: str | None = None) -> Column:
    """The packed key of a row's partition."""
    year, month, day, hour = _hour_columns(alias)
    return year * 1_000_000 + month * 10_000 + day * 100 + hour


def split_hour_key(key: int | Column) -> list:
    """Year, month, day and hour of a packed key, given as a number or as a column."""
    if isinstance(key, Column):
        def part(unit: int) -> Column:
            return F.call_function("div", key, F.lit(unit))
    else:
        def part(unit: int) -> int:
            return key // unit
    return [part(1_000_000), part(10_000) % 100, part(100) % 100, key % 100]


def hour_of_folders(values: tuple[int, ...]) -> tuple[int, int]:
    """Keys of the first and the last hour that may lie below folders of a year, month, day and hour, as far as given."""
    first, last = (0, 1, 1, 0), (9999, 12, 31, 23)
    keys = []
    for rest in (first, last):
        year, month, day, hour = (*values, *rest[len(values) :])
        keys.append(year * 1_000_000 + month * 10_000 + day * 100 + hour)
    return keys[0], keys[1]


def partition_hour_filter(op: str, key: int | Column, alias: str | None = None) -> Column:
    """Compare a row's partition with a packed key.

    ``>=`` and ``<=`` become plain per-column comparisons, which metastores and file indexes both
    prune on; the other operators compare the packed number.
    """
    if op not in (">=", "<="):
        if op not in _COMPARE:
            raise ValueError(f"unsupported comparison: {op!r}")
        return _COMPARE[op](partition_hour_key(alias), key)
    beyond = operator.gt if op == ">=" else operator.lt
    *larger, (hour, last) = zip(_hour_columns(alias), split_hour_key(key))
    condition = (hour == last) | beyond(hour, last)
    for column, bound in reversed(larger):
        condition = beyond(column, bound) | ((column == bound) & condition)
    return condition


def hour_key_before(ts: Column, hours: int) -> Column:
    """The packed key of the hour ``hours`` before a timestamp."""
    earlier = ts - F.make_interval(hours=F.lit(int(hours)))
    return F.date_format(earlier, "yyyyMMddHH").cast("int")


def cutoff_hour_key(as_of: datetime | None, hours: int) -> int:
    """Same as :func:`hour_key_before` for a known instant (default: now), as a literal that prunes statically."""
    moment = as_of or datetime.now(timezone.utc)
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc)
    return int((moment - timedelta(hours=int(hours))).strftime("%Y%m%d%H"))
