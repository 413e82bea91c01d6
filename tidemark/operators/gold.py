"""Gold models over Silver rows: fraud alerts and hourly liquidity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contract import ALERTS, HOUR_COLUMNS, LIQUIDITY, MONEY, MONEY_SUM
from tidemark.functions.event_time import utc_now
from tidemark.functions.partition_hours import partition_hour_filter
from tidemark.functions.risk import alert_reason, fraud_rule


def in_hours(
    df: DataFrame, start_key: int | None = None, end_key: int | None = None, cutoff_key: int | None = None
) -> DataFrame:
    """Rows within the given hours: a backfill range (both ends included) and an incremental cutoff."""
    for op, key in ((">=", start_key), ("<=", end_key), (">=", cutoff_key)):
        if key is not None:
            df = df.where(partition_hour_filter(op, key))
    return df


def _present(df: DataFrame, *columns: str) -> DataFrame:
    # Separate tests rather than dropna(): each one reaches the scan as a pushed or partition filter.
    for name in (*columns, *HOUR_COLUMNS):
        df = df.where(F.col(name).isNotNull())
    return df


def alert_candidates(silver: DataFrame) -> DataFrame:
    """Silver rows that satisfy the fraud rule, still with their Silver columns."""
    rows = _present(silver, "transaction_id", "event_time", "event_time_epoch_us", "amount")
    return rows.where(fraud_rule())


def to_alerts(candidates: DataFrame) -> DataFrame:
    return candidates.withColumns(
        {
            "fraud_alert_key": F.col("transaction_id"),
            "alert_reason": alert_reason(),
            "model_updated_at": utc_now(),
        }
    ).select(ALERTS.columns)


def fraud_alerts(silver: DataFrame, **hours: int | None) -> DataFrame:
    """One alert per Silver row that satisfies the rule. A filter and a projection: nothing is shuffled."""
    return to_alerts(alert_candidates(in_hours(silver, **hours)))


def hourly_liquidity(silver: DataFrame, **hours: int | None) -> DataFrame:
    """Transaction count, flagged count and sums per event hour and currency.

    Groups are few, so partial sums per map task leave almost nothing to shuffle, however the rows
    are spread over hours and currencies.
    """
    rows = _present(in_hours(silver, **hours), "event_time", "currency", "amount")
    unflagged = F.when(~F.col("is_flagged_suspicious"), F.col("amount")).otherwise(F.lit(0).cast(MONEY))
    hour_bucket = F.date_trunc("hour", F.col("event_time")).cast("timestamp_ntz")
    totals = rows.groupBy(hour_bucket.alias("hour_bucket"), "currency", *HOUR_COLUMNS).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.count_if("is_flagged_suspicious").alias("suspicious_transaction_count"),
        F.sum("amount").cast(MONEY_SUM).alias("total_amount"),
        F.sum(unflagged).cast(MONEY_SUM).alias("net_amount"),
    )
    bucket_seconds = F.unix_seconds(F.col("hour_bucket").cast("timestamp"))
    return totals.withColumns(
        {
            "hourly_liquidity_key": F.concat(bucket_seconds.cast("string"), F.lit("|"), F.col("currency")),
            "model_updated_at": utc_now(),
        }
    ).select(LIQUIDITY.columns)
