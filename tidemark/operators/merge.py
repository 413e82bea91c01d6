"""Keyed upsert as a DataFrame operation, for tables without a transactional format."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import append_new_columns


def _with_columns_of(df: DataFrame, other: DataFrame) -> DataFrame:
    schema = append_new_columns(df.schema, other.schema)
    missing = [f for f in schema if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def _same_key(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> Column:
    return reduce(Column.__and__, [left[k] == right[f"_new_{k}"] for k in keys])


def _refuse_double_matches(target: DataFrame, updates: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """No rows, in the columns of ``target``; fails the job when two update rows claim one target row.

    Repeated update keys are normally absent, in which case adaptive execution drops the join with
    the target. The error hangs on an aggregate, below which the optimizer cannot move it.
    """
    repeated = updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys)
    named = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    claimed = target.select(*keys).join(repeated, list(keys), "left_semi").agg(F.max(named).alias("claimed"))
    message = F.concat(F.lit(f"several update rows match one target row, {', '.join(keys)} = "), F.col("claimed"))
    failing = F.when(F.col("claimed").isNotNull(), F.raise_error(message).cast("string"))
    return claimed.where(failing.isNotNull()).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema]
    )


def merge_incremental(
    target: DataFrame, updates: DataFrame, key: str | tuple[str, ...], dest_filter: Column | None = None
) -> DataFrame:
    """``target`` after an upsert of ``updates``.

    Only target rows inside ``dest_filter`` can match. Every matched row takes the values of its
    update, so as many rows stay as there were; an unmatched update is inserted and nothing is
    deleted. Columns that only ``updates`` has are appended and stay NULL in older rows. The target
    is the left side of an outer join, which adaptive execution may split when a key is hot.
    """
    keys = (key,) if isinstance(key, str) else tuple(key)
    columns = _column_order(target, updates)
    inside = target if dest_filter is None else target.where(dest_filter)
    updated = _with_columns_of(updates, inside).select(columns)
    kept = _with_columns_of(inside, updates).select(columns)
    new = updated.select(*[F.col(c).alias(f"_new_{c}") for c in columns]).withColumn("_matched", F.lit(True))
    replaced = kept.join(new, _same_key(kept, new, keys), "left").select(
        *[F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    )
    present = kept.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    inserted = updated.join(present, _same_key(updated, present, keys), "left_anti")
    merged = replaced.unionByName(inserted).unionByName(_refuse_double_matches(kept, updates, keys))
    if dest_filter is not None:
        outside = target.where(~F.coalesce(dest_filter, F.lit(False)))
        merged = merged.unionByName(_with_columns_of(outside, updates))
    return merged.select(columns)


def _column_order(target: DataFrame, updates: DataFrame) -> list[str]:
    return append_new_columns(target.schema, updates.schema).fieldNames()
