"""Data checks. The ``check_*`` functions return failing rows (no rows: passed), ``run_checks`` one row per check."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import ALERTS, HOUR_COLUMNS, LIQUIDITY, MONEY_SUM, SILVER
from tidemark.functions.risk import ALERT_REASONS, fraud_rule

# Currencies a table may hold.
CURRENCIES = ("USD", "THB", "EUR", "SGD", "JPY")


@dataclass(frozen=True)
class TableChecks:
    """What must hold for one table."""

    not_null: tuple[str, ...] = ()
    unique: str | None = None
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)
    rows: dict[str, Column] = field(default_factory=dict)  # name -> condition of a failing row


def liquidity_out_of_bounds() -> Column:
    zero = F.lit(0).cast(MONEY_SUM)
    return (
        (F.col("transaction_count") <= 0)
        | (F.col("suspicious_transaction_count") < 0)
        | (F.col("total_amount") < zero)
        | (F.col("net_amount") < zero)
    )


def table_checks() -> dict[str, TableChecks]:
    """The checks of each table (built on demand: columns need a running session)."""
    return {
        SILVER.name: TableChecks(
            not_null=(
                "transaction_id",
                "event_time",
                "event_time_epoch_us",
                "amount",
                "currency",
                "account_id",
                "device_id",
                *HOUR_COLUMNS,
            ),
            accepted={"currency": CURRENCIES},
        ),
        LIQUIDITY.name: TableChecks(
            not_null=(
                "hourly_liquidity_key",
                "hour_bucket",
                "currency",
                "transaction_count",
                "suspicious_transaction_count",
                "total_amount",
                "net_amount",
                *HOUR_COLUMNS,
            ),
            unique="hourly_liquidity_key",
            accepted={"currency": CURRENCIES},
            rows={"liquidity_bounds": liquidity_out_of_bounds()},
        ),
        ALERTS.name: TableChecks(
            not_null=(
                "fraud_alert_key",
                "transaction_id",
                "account_id",
                "device_id",
                "alert_reason",
                "amount",
                "event_time",
                "event_time_epoch_us",
                *HOUR_COLUMNS,
            ),
            unique="fraud_alert_key",
            accepted={"alert_reason": ALERT_REASONS},
            rows={"alert_rule": ~fraud_rule()},
        ),
    }


def check_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column_name, failures)`` for the columns that hold NULLs, from a single pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _as_rows(counts, [(F.lit(c).alias("column_name"), c) for c in columns]).where("failures > 0")


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """``(key, n_records)`` of repeated keys. NULL keys do not count."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def check_accepted(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """``(column, n_records)`` of values outside the list. NULL passes."""
    return (
        df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    )


def check_liquidity_bounds(df: DataFrame) -> DataFrame:
    return df.where(liquidity_out_of_bounds())


def check_alert_rule(df: DataFrame) -> DataFrame:
    """Alerts that do not satisfy the fraud rule."""
    return df.where(~fraud_rule())


def _as_rows(aggregate: DataFrame, entries: list[tuple[Column, str]]) -> DataFrame:
    """Turn a one-row aggregate into one row per (label, count column)."""
    rows = F.array(*[F.struct(label, F.col(c).alias("failures")) for label, c in entries])
    return aggregate.select(F.inline(rows))


def _summarise(table: str, df: DataFrame, checks: TableChecks) -> DataFrame:
    measures: list[tuple[str, str, Column]] = []
    for column in checks.not_null:
        measures.append(("not_null", column, F.count_if(F.col(column).isNull())))
    for column, values in checks.accepted.items():
        # The failing rows of this check are the distinct values outside the list.
        outside = F.when(~F.col(column).isin(*values), F.col(column))
        measures.append(("accepted_values", column, F.count_distinct(outside)))
    for name, failing in checks.rows.items():
        measures.append((name, "", F.count_if(failing)))
    aggregate = df.agg(*[m.alias(f"m{i}") for i, (_, _, m) in enumerate(measures)])
    entries = [
        (F.struct(F.lit(check).alias("check_name"), F.lit(column).alias("column_name")).alias("label"), f"m{i}")
        for i, (check, column, _) in enumerate(measures)
    ]
    summary = _as_rows(aggregate, entries).select("label.*", "failures")
    if checks.unique is not None:
        repeated = check_unique(df, checks.unique).agg(F.count(F.lit(1)).alias("failures"))
        summary = summary.unionByName(
            repeated.select(
                F.lit("unique").alias("check_name"), F.lit(checks.unique).alias("column_name"), "failures"
            )
        )
    return summary.select("check_name", F.lit(table).alias("table_name"), "column_name", "failures")


def run_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """``(check_name, table_name, column_name, failures)`` for every check of the given tables.

    Each table is scanned once for all its row and value checks, and once more, key column only, for
    uniqueness.
    """
    checks = table_checks()
    return reduce(DataFrame.unionByName, [_summarise(name, df, checks[name]) for name, df in tables.items()])
