"""The fraud rule and the reason given for each alert."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.contract import MONEY

# Amount thresholds, places of high risk, alert reasons.
HIGH_AMOUNT = Decimal("10000.00")
ELEVATED_AMOUNT = Decimal("5000.00")
RISKY_PLACES = ("lagos", "sao paulo", "new york", "bangkok")
ALERT_REASONS = (
    "SIMULATOR_FLAG",
    "HIGH_AMOUNT_HIGH_RISK_LOCATION",
    "HIGH_AMOUNT",
    "ELEVATED_AMOUNT_HIGH_RISK_LOCATION",
    "RISK_RULE_MATCH",
)


def is_risky_location(location: Column) -> Column:
    """True when the text names a risky place anywhere, in any case; never NULL.

    Substring tests work on the UTF-8 bytes directly, so no regular expression runs per row.
    """
    text = F.lower(F.coalesce(location, F.lit("")))
    return reduce(or_, [text.contains(place) for place in RISKY_PLACES])


def _above(threshold: Decimal) -> Column:
    return F.col("amount") > F.lit(threshold).cast(MONEY)


def fraud_rule() -> Column:
    """Flagged, or a high amount, or an elevated amount at a risky place."""
    return (
        F.col("is_flagged_suspicious")
        | _above(HIGH_AMOUNT)
        | (_above(ELEVATED_AMOUNT) & is_risky_location(F.col("location")))
    )


def alert_reason() -> Column:
    """The first reason that applies, in the order of :data:`ALERT_REASONS`."""
    risky = is_risky_location(F.col("location"))
    conditions = [
        F.col("is_flagged_suspicious"),
        _above(HIGH_AMOUNT) & risky,
        _above(HIGH_AMOUNT),
        _above(ELEVATED_AMOUNT) & risky,
        F.lit(True),
    ]
    return F.coalesce(*[F.when(c, F.lit(reason)) for c, reason in zip(conditions, ALERT_REASONS)])
