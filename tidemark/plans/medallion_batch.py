"""The medallion flow as one batch run: raw events to all tables of a warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.contract import BRONZE, REJECTED, SILVER
from tidemark.operators.medallion import invalid, to_bronze, to_rejected, to_silver, valid, with_event_time
from tidemark.sources.tables import table_root, write_table


def build_silver(raw: DataFrame, warehouse: str, salt: str, minutes: int = 1) -> str:
    root = table_root(warehouse, SILVER)
    write_table(to_silver(valid(with_event_time(raw)), salt, minutes), root, SILVER)
    return root


def build_bronze(raw: DataFrame, warehouse: str) -> tuple[str, str]:
    timed = with_event_time(raw)
    bronze, rejected = table_root(warehouse, BRONZE), table_root(warehouse, REJECTED)
    write_table(to_bronze(valid(timed)), bronze, BRONZE)
    write_table(to_rejected(invalid(timed)), rejected, REJECTED)
    return bronze, rejected
