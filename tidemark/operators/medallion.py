"""Raw events to Bronze, rejected and Silver rows. Every step runs on batch and streaming input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import BRONZE, REJECTED, SILVER
from tidemark.functions.event_time import event_time_of, hour_parts, in_epoch_range, utc_now
from tidemark.functions.masking import ACCOUNT_PREFIX, DEVICE_PREFIX, mask_pii

EPOCH = "event_time_epoch_us"

# Reasons for a rejected event, in the order they are tested.
MISSING_TRANSACTION_ID = "MISSING_TRANSACTION_ID"
MISSING_EPOCH = "MISSING_EVENT_TIME_EPOCH_US"
INVALID_EVENT_TIME = "INVALID_EVENT_TIME"
UNKNOWN_VIOLATION = "UNKNOWN_CONTRACT_VIOLATION"


def with_event_time(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", event_time_of(F.col(EPOCH)))


def is_valid() -> Column:
    """Whether an event has an identifier and an event time."""
    # The epoch is present and the event time derived from it is not NULL exactly when the epoch is
    # in range. The test of the stored column reaches the Parquet scan as a pushed filter.
    return F.col("transaction_id").isNotNull() & in_epoch_range(F.col(EPOCH))


def valid(df: DataFrame) -> DataFrame:
    return df.where(is_valid())


def invalid(df: DataFrame) -> DataFrame:
    """Exactly the rows :func:`valid` leaves out."""
    return df.where(~F.coalesce(is_valid(), F.lit(False)))


def with_reject_reason(df: DataFrame) -> DataFrame:
    reason = (
        F.when(F.col("transaction_id").isNull(), MISSING_TRANSACTION_ID)
        .when(F.col(EPOCH).isNull(), MISSING_EPOCH)
        .when(F.col("event_time").isNull(), INVALID_EVENT_TIME)
        .otherwise(UNKNOWN_VIOLATION)
    )
    return df.withColumn("reject_reason", reason)


def _at_rest(df: DataFrame, spec) -> DataFrame:
    """Drop the zone from times and put the columns in table order."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema])


def to_bronze(df: DataFrame) -> DataFrame:
    """Valid rows (not deduplicated) in the Bronze layout."""
    stamped = df.select("*", *hour_parts(F.coalesce("event_time", F.current_timestamp())))
    return _at_rest(stamped.withColumn("ingest_time", utc_now()), BRONZE)


def to_rejected(df: DataFrame) -> DataFrame:
    """Invalid rows with their reason, in the layout of the rejected table."""
    return _at_rest(with_reject_reason(df).withColumn("rejected_at", utc_now()), REJECTED)


def dedup_window(df: DataFrame, minutes: int = 1) -> DataFrame:
    """One row per transaction id and tumbling event-time window, column-wise minimum.

    A plain aggregate: duplicates collapse inside each map task before the shuffle, so a hot id
    costs one row per task, and a stream emits append-only results. The id leads the grouping keys
    because the string minima make Spark aggregate by sorting, and an id compares by its first bytes
    where a window compares field by field. Cutting to milliseconds keeps order, so the earliest
    event time follows from the earliest epoch and need not be shuffled as well.
    """
    window = F.window("event_time", f"{minutes} minutes").alias("dedup_window")
    payload = ("account_id", "device_id", "amount", "currency", EPOCH, "location")
    deduplicated = df.groupBy("transaction_id", window).agg(
        *[F.min(name).alias(name) for name in payload],
        F.coalesce(F.bool_or("is_flagged_suspicious"), F.lit(False)).alias("is_flagged_suspicious"),
    )
    return deduplicated.select(
        "transaction_id",
        *payload,
        "is_flagged_suspicious",
        event_time_of(F.col(EPOCH)).alias("event_time"),
        F.col("dedup_window.start").alias("dedup_window_start"),
        F.col("dedup_window.end").alias("dedup_window_end"),
    )


def to_silver(df: DataFrame, salt: str, minutes: int = 1, lateness_seconds: int | None = None) -> DataFrame:
    """Valid rows, deduplicated per window and masked, in the Silver layout.

    ``lateness_seconds`` sets the watermark of a stream; batch input needs none.
    """
    if lateness_seconds is not None:
        df = df.withWatermark("event_time", f"{lateness_seconds} seconds")
    # Masks come after the minimum, which is taken over the clear identifiers.
    masked = dedup_window(df, minutes).withColumns(
        {
            "account_id": mask_pii(F.col("account_id"), salt, ACCOUNT_PREFIX),
            "device_id": mask_pii(F.col("device_id"), salt, DEVICE_PREFIX),
            "ingest_time": utc_now(),
        }
    )
    return _at_rest(masked.select("*", *hour_parts(F.col("event_time"))), SILVER)


def silver_sample(silver: DataFrame, n: int = 5) -> DataFrame:
    """The first masked identifiers by transaction id and window: a look at the table, not a random draw."""
    return (
        silver.select("transaction_id", "dedup_window_start", "account_id", "device_id")
        .orderBy("transaction_id", "dedup_window_start")
        .limit(n)
    )
