"""Streamed tables read as two layers: closed hours from their compacted copy, the rest from the live loads.

The compacted copy bears a mark: up to which hour it goes, and which loads of the live table it has taken
in. A live load counts if its hour is later, or if the copy has not taken it in, so rows that reach
a closed hour late are read from the live table until the next compaction.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import TABLES, TableSpec
from tidemark.functions.partition_hours import partition_hour_filter
from tidemark.sources.folders import Folders, in_parallel
from tidemark.sources.journal import LAYER, recover
from tidemark.sources.tables import LOAD, count_rows, read_hours, read_table, split_load, table_root


#: A key after all hours.
END_OF_TIME = 9999_12_31_23


def compacted_root(warehouse: str, spec: TableSpec | None = None) -> str:
    root = f"{warehouse.rstrip('/')}/compacted"
    return table_root(root, spec) if spec else root


@dataclass(frozen=True)
class Layer:
    """The hours up to ``through_key`` of all loads up to a number, by stream query."""

    through_key: int
    loads: dict[str, int]

    def has(self) -> Column:
        """Whether a row of the live table is in the compacted copy; in partition columns alone, so folders are pruned."""
        query, number = split_load(F.col(LOAD))
        taken = [(query == q) & (number <= n) for q, n in sorted(self.loads.items())]
        return F.coalesce(partition_hour_filter("<=", self.through_key) & reduce(Column.__or__, taken, F.lit(False)), F.lit(False))

    def as_dict(self) -> dict:
        return {"through_key": self.through_key, "loads": self.loads}


def read_layer(spark: SparkSession, compacted: str) -> Layer | None:
    found = Folders(spark, compacted).read_json(LAYER)
    return None if found is None else Layer(found["through_key"], found["loads"])


def read_layered(
    spark: SparkSession,
    warehouse: str,
    spec: TableSpec,
    start_key: int | None = None,
    end_key: int | None = None,
) -> DataFrame:
    """The rows of a streamed table within hour bounds, each once, wherever they are kept.

    Folders outside the bounds are not even listed. A compaction that died while it replaced hours is
    finished first.
    """
    live, compacted = table_root(warehouse, spec), compacted_root(warehouse, spec)
    recover(spark, compacted)
    layer = read_layer(spark, compacted)
    if layer is None:
        return read_hours(spark, live, spec, start_key, end_key)
    last = layer.through_key if end_key is None else min(end_key, layer.through_key)
    closed = read_hours(spark, compacted, spec, start_key, last)
    rest = read_hours(spark, live, spec, start_key, end_key, with_load=True).where(~layer.has())
    return closed.unionByName(rest.select(spec.columns))


def expire_compacted(spark: SparkSession, warehouse: str, spec: TableSpec) -> int:
    """Delete the live loads of closed hours that the compacted copy has taken in; returns how many."""
    live, compacted = Folders(spark, table_root(warehouse, spec)), compacted_root(warehouse, spec)
    recover(spark, compacted)
    layer = read_layer(spark, compacted)
    if layer is None:
        return 0
    merged = []
    for hour in live.hours(end_key=layer.through_key, whole=True):
        for name in live.names(hour):
            query, _, number = name.removeprefix(f"{LOAD}=").rpartition("-")
            if name.startswith(f"{LOAD}=") and number.isdigit() and int(number) <= layer.loads.get(query, -1):
                merged.append(f"{hour}/{name}")
    in_parallel(live.delete, merged)
    return len(merged)


def table_counts(spark: SparkSession, warehouse: str, names: list[str] | None = None) -> DataFrame:
    """``(table_name, row_count)`` of the given tables, or of all."""

    def rows(spec: TableSpec) -> DataFrame:
        if spec.streamed and spec.partition_by:
            return read_layered(spark, warehouse, spec)
        return read_table(spark, table_root(warehouse, spec), spec)

    return count_rows({name: rows(TABLES[name]) for name in names or TABLES})

