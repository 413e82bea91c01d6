"""Small builders shared by the tests."""

from datetime import datetime, timedelta, timezone
from decimal import Decimal

from tidemark.contract import CONTRACT

NOON = datetime(2026, 5, 30, 12, 34, tzinfo=timezone.utc)


def us(moment: datetime) -> int:
    return (moment - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def at(seconds: float, start: datetime = NOON) -> int:
    """Epoch microseconds some seconds after a minute boundary."""
    return us(start) + round(seconds * 1_000_000)


def event(txn="t1", epoch=None, **changes):
    row = {
        "transaction_id": txn,
        "account_id": "acct_1",
        "amount": Decimal("12.50"),
        "currency": "USD",
        "event_time_epoch_us": at(1) if epoch is None else epoch,
        "device_id": "dev_1",
        "location": "Springfield, US",
        "is_flagged_suspicious": False,
    }
    row.update(changes)
    return tuple(row[f.name] for f in CONTRACT)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), CONTRACT)


def multiset(df, columns=None):
    return sorted(repr(tuple(r)) for r in df.select(columns or sorted(df.columns)).collect())
