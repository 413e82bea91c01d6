"""The transaction contract as a view over the driver's ``events`` table (rules in FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import CONTRACT
from tidemark.functions.event_time import epoch_micros

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# Fixed values of the view.
CURRENCIES = ("USD", "THB", "EUR", "SGD", "JPY")
PLACES = ("Bangkok, TH", "New York, US", "Lagos, NG", "Sao Paulo, BR")
ELSEWHERE = "Springfield, US"
TWO_MINUTES_US = 120_000_000


def _pick(index: Column, values: tuple[str, ...], otherwise: str | None = None) -> Column:
    chosen = F.lit(otherwise)
    for position, value in reversed(list(enumerate(values))):
        chosen = F.when(index == position, value).otherwise(chosen)
    return chosen


def transactions_from_events(events: DataFrame) -> DataFrame:
    """One pass over ``events``: a generator yields each row and its copy, with their epochs and values.

    Because the generator yields finished epochs, later steps refer to a column where they would
    otherwise repeat the rule in every filter and window bound.
    """
    e, u = F.col("event_id"), F.col("user_id")
    us, value = F.col("us"), F.col("value")
    epoch = (
        F.when(e % 50 == 1, F.call_function("div", us, F.lit(1000)))
        .when(e % 50 == 2, us * 10)
        .when(e % 50 != 0, us)
    )

    def one(epoch: Column, value: Column) -> Column:
        return F.struct(epoch.alias("epoch"), value.alias("value"))

    plain = one(epoch, value)
    # The conditions exclude each other, so a row has one copy at most.
    copies = (
        F.when(e % 10 == 4, F.array(plain, plain))
        .when(e % 100 == 5, F.array(plain, one(epoch, value + F.lit(0.01))))
        .when(e % 100 == 6, F.array(plain, one(us + TWO_MINUTES_US, value)))
        .otherwise(F.array(plain))
    )
    timed = events.select("event_id", "user_id", "event_type", "value", epoch_micros(F.col("ts")).alias("us"))
    copied = timed.select("event_id", "user_id", "event_type", F.inline(copies))

    def unless(remainder: int, column: Column) -> Column:
        return F.when(e % 50 != remainder, column)

    columns = {
        "transaction_id": unless(3, F.concat(F.lit("txn_"), e.cast("string"))),
        "account_id": unless(17, F.concat(F.lit("acct_"), u.cast("string"))),
        "amount": unless(19, F.round(F.col("value") * 100).cast("decimal(18,2)")),
        "currency": unless(21, _pick(u % 5, CURRENCIES)),
        "event_time_epoch_us": F.col("epoch"),
        "device_id": unless(18, F.concat(F.lit("dev_"), (u % 97).cast("string"))),
        "location": unless(20, _pick(u % 8, PLACES, ELSEWHERE)),
        "is_flagged_suspicious": unless(22, (F.col("event_type") == "error") & (e % 4 == 0)),
    }
    return copied.select([columns[f.name].cast(f.dataType).alias(f.name) for f in CONTRACT])


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A pattern, because a streaming source takes a plain path for a folder, and this may be one file.
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/{{events.parquet}}")
