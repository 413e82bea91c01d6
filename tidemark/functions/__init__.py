from tidemark.functions.event_time import epoch_micros, event_time_of, hour_parts, money, utc_now
from tidemark.functions.masking import mask_pii
from tidemark.functions.partition_hours import (
    cutoff_hour_key,
    hour_key_before,
    partition_hour_filter,
    partition_hour_key,
    split_hour_key,
)
from tidemark.functions.risk import alert_reason, fraud_rule, is_risky_location

__all__ = [
    "alert_reason",
    "cutoff_hour_key",
    "epoch_micros",
    "event_time_of",
    "fraud_rule",
    "hour_key_before",
    "hour_parts",
    "is_risky_location",
    "mask_pii",
    "money",
    "partition_hour_filter",
    "partition_hour_key",
    "split_hour_key",
    "utc_now",
]
