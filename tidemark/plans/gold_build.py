"""Incremental builds of the Gold tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import ALERTS, LIQUIDITY, TableSpec, append_new_columns
from tidemark.functions.partition_hours import cutoff_hour_key
from tidemark.operators.gold import fraud_alerts, hourly_liquidity, in_hours
from tidemark.operators.merge import merge_incremental
from tidemark.session import use_utc
from tidemark.sources.journal import BUILT, begin, read_marker, recover, write_marker
from tidemark.sources.tables import read_hours, read_table, table_root, write_table

LOOKBACK_HOURS = 48
#: Silver rows, or a function that reads those within hour bounds (``start_key``, ``end_key``, both may be None).
Silver = DataFrame | Callable[..., DataFrame]


@dataclass(frozen=True)
class GoldModel:
    """A Gold table and the rows it is built from, in full or for the hours of an incremental build."""

    spec: TableSpec
    rows: Callable[..., DataFrame]


MODELS = {
    "gold_fraud_alerts": GoldModel(ALERTS, fraud_alerts),
    "gold_hourly_liquidity": GoldModel(LIQUIDITY, hourly_liquidity),
}


def build_gold(
    spark: SparkSession,
    model: str | GoldModel,
    silver: Silver,
    warehouse: str,
    as_of: datetime | None = None,
    lookback_hours: int = LOOKBACK_HOURS,
    start_key: int | None = None,
    end_key: int | None = None,
    full_refresh: bool = False,
) -> str:
    """Build or update a Gold table from Silver and return its root.

    The first build (or ``full_refresh``) writes everything within ``start_key``/``end_key`` and, when
    it is done, leaves a marker with the table's schema. Without that marker a table counts as
    not built, so an interrupted first build is done again in full. Later builds recompute the hours
    from ``as_of - lookback_hours`` on and merge them by key with the same hours of the table; older
    partitions are neither read nor written. Columns that the table has and the model lacks stay.
    Silver without any row is refused: Gold would be marked as built from nothing. A merge that died
    while it replaced hours is finished first.
    """
    use_utc(spark)
    model = MODELS[model] if isinstance(model, str) else model
    root = table_root(warehouse, model.spec)
    recover(spark, root)
    bounds = {"start_key": start_key, "end_key": end_key}
    built = None if full_refresh else read_marker(spark, root)
    if built is None:
        if _within(silver).isEmpty():
            raise ValueError("Silver has no rows yet; Gold is built once there are some")
        rows = model.rows(_within(silver, **bounds), **bounds)
        spec = model.spec.with_columns(rows.schema)
        write_table(rows, root, spec)
        write_marker(spark, root, spec.schema)
    else:
        cutoff = cutoff_hour_key(as_of, lookback_hours)
        first = cutoff if start_key is None else max(cutoff, start_key)
        updates = model.rows(_within(silver, first, end_key), cutoff_key=cutoff, **bounds)
        spec = model.spec.with_columns(append_new_columns(built, updates.schema))
        merge_into(spark, root, spec, updates, cutoff)
    return root


def _within(silver: Silver, start_key: int | None = None, end_key: int | None = None) -> DataFrame:
    return silver if isinstance(silver, DataFrame) else silver(start_key=start_key, end_key=end_key)


def merge_into(spark: SparkSession, root: str, spec: TableSpec, updates: DataFrame, cutoff: int) -> None:
    """Upsert ``updates`` into the partitions of a table from hour ``cutoff`` on.

    The updates are written beside the table first, so they are computed once although the merge
    reads them several times. The merged hours are staged and noted in the table's journal before
    they take their places, so a job that dies on the way leaves the table as it was or as it is
    going to be. The key fixes a row's hour, so no hour is emptied by a merge.
    """
    lacking = {f.name: F.lit(None).cast(f.dataType) for f in spec.schema if f.name not in updates.columns}
    change = begin(spark, root, "merge", note={BUILT: spec.schema.jsonValue()})
    update_root = change.beside("updates")
    # Partitions would only cost files here: the merge reads all of these rows.
    write_table(in_hours(updates, cutoff_key=cutoff).withColumns(lacking), update_root, replace(spec, partition_by=()))
    staged = read_table(spark, update_root, spec)
    table = read_hours(spark, root, spec, start_key=cutoff)
    write_table(merge_incremental(table, staged, spec.key), change.staging, spec)
    change.stage()
    change.finish()
