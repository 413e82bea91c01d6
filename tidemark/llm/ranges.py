"""Ordering a table by id without one task seeing all of it, also when one id has a large share of the rows."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOWEST = -(2**63)
_DIGITS = 16


def place_of(doc_id: Column, content: Column) -> Column:
    """Text that sorts as (id, content hash), both long and not null."""

    def digits(value: Column) -> Column:
        return F.lpad(F.hex(value.bitwiseXOR(F.lit(_LOWEST))), _DIGITS, "0")

    return F.concat(digits(doc_id), digits(content))


def place(doc_id: int, content: int = _LOWEST) -> str:
    """The same for two numbers; by default before all contents of an id."""
    return f"{doc_id - _LOWEST:016X}{content - _LOWEST:016X}"


def place_bounds(rows: DataFrame, id_column: str, content_column: str) -> list[str]:
    """Places that cut the table into about as many ranges as a range has rows: the square root of both.

    Each is the place of a row, or lies before all rows of an id that has a range at most. The ranges come
    from the id column alone. Only ids that fill several ranges have their contents' hashes read, whose
    space is cut into equal parts. The list may be empty.
    """
    count = rows.count()
    parts = math.isqrt(count)
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    cut = rows.agg(F.percentile_approx(id_column, shares, max(10_000, 20 * parts)).alias("cut")).first()["cut"]
    filled = Counter(cut)
    hot = {doc_id: n for doc_id, n in filled.items() if n > 1}
    bounds = {place(doc_id) for doc_id in filled if doc_id not in hot}
    if hot:
        # Fewer ids than ranges, and a row per range comes back.
        ids = sorted(hot)
        listed = F.lit(ids) if len(ids) > 1 else F.array(F.lit(ids[0]))
        ranges = [hot[i] for i in ids]
        own = F.array_position(listed, F.col(id_column))
        n = F.element_at(F.lit(ranges) if len(ranges) > 1 else F.array(F.lit(ranges[0])), own.cast("int"))
        part = F.floor((F.shiftright(F.col(content_column), 32) + 2**31) * n / 2**32)
        firsts = (
            rows.filter(own > 0)
            .groupBy(F.col(id_column).alias("doc_id"), part.alias("part"))
            .agg(F.min(content_column).alias("content"))
        )
        bounds |= {place(r["doc_id"], r["content"]) for r in firsts.collect()}
    return sorted(bounds)


def begins(column: Column, bound: Column) -> Column:
    """Whether a place is that of a bound, or of any row of the id that the bound lies before."""
    whole_id = F.endswith(bound, F.lit("0" * _DIGITS)) & column.startswith(F.substring(bound, 1, _DIGITS))
    return (column == bound) | whole_id


def range_of(column: Column, bounds: list[str]) -> Column:
    """Number of bounds up to a place, so that places of equal ranges follow each other; null counts as before all.

    Two steps, so that the work per row grows with the square root of the number of bounds.
    """
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    listed = F.array(*map(F.lit, bounds)) if len(bounds) < 2 else F.lit(bounds)
    coarse = F.lit(bounds[::step]) if len(bounds) > 1 else listed
    full = F.size(F.filter(coarse, lambda b: b <= column))
    begin = F.greatest(full - 1, F.lit(0)) * step
    fine = F.size(F.filter(F.slice(listed, begin + 1, step), lambda b: b <= column))
    return F.coalesce(F.when(full > 0, begin + fine), F.lit(0)).cast("int")
