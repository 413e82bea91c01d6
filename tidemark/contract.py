"""Table contracts: schemas, partitioning and in-file order, declared once and used by every writer."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(38, 2)
HOUR_COLUMNS = ("year", "month", "day", "hour")


class ContractError(ValueError):
    """Data does not fit the declared contract."""


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


def _hours() -> list[tuple[str, T.DataType]]:
    return [(name, T.IntegerType()) for name in HOUR_COLUMNS]


_EVENT = [
    ("transaction_id", T.StringType()),
    ("account_id", T.StringType()),
    ("amount", MONEY),
    ("currency", T.StringType()),
    ("event_time_epoch_us", T.LongType()),
    ("device_id", T.StringType()),
    ("location", T.StringType()),
    ("is_flagged_suspicious", T.BooleanType()),
]
_AT_REST = [*_EVENT, ("event_time", T.TimestampNTZType())]

# The event contract as it arrives. Columns are nullable: the pipeline itself routes bad rows.
CONTRACT = _schema(*_EVENT)
# Values of contract columns that an older producer may leave out entirely; all others become NULL.
CONTRACT_DEFAULTS = {"is_flagged_suspicious": False}


@dataclass(frozen=True)
class TableSpec:
    """Where a table lies below the warehouse root and how its files are laid out."""

    name: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    # Streamed tables hold one ``load=`` folder per micro-batch, below their own partition folders.
    streamed: bool = False
    key: tuple[str, ...] = field(default=())

    @property
    def path(self) -> str:
        return self.name.replace(".", "/")

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def with_columns(self, newer: T.StructType) -> TableSpec:
        """The same table after the new columns of ``newer`` were appended."""
        return replace(self, schema=append_new_columns(self.schema, newer))


TABLES = {
    spec.name: spec
    for spec in (
        TableSpec(
            "bronze.transactions",
            _schema(*_AT_REST, ("ingest_time", T.TimestampNTZType()), *_hours()),
            partition_by=HOUR_COLUMNS,
            sort_by=("event_time", "transaction_id"),
            streamed=True,
        ),
        TableSpec(
            "bronze.transactions_rejected",
            _schema(*_AT_REST, ("reject_reason", T.StringType()), ("rejected_at", T.TimestampNTZType())),
            sort_by=("rejected_at", "reject_reason"),
            streamed=True,
        ),
        TableSpec(
            "silver.transactions",
            _schema(
                *_AT_REST,
                ("dedup_window_start", T.TimestampNTZType()),
                ("dedup_window_end", T.TimestampNTZType()),
                ("ingest_time", T.TimestampNTZType()),
                *_hours(),
            ),
            partition_by=HOUR_COLUMNS,
            sort_by=("event_time", "transaction_id"),
            streamed=True,
        ),
        TableSpec(
            "gold.gold_fraud_alerts",
            _schema(
                ("fraud_alert_key", T.StringType()),
                ("transaction_id", T.StringType()),
                ("account_id", T.StringType()),
                ("device_id", T.StringType()),
                ("amount", MONEY),
                ("currency", T.StringType()),
                ("location", T.StringType()),
                ("is_flagged_suspicious", T.BooleanType()),
                ("alert_reason", T.StringType()),
                ("event_time", T.TimestampNTZType()),
                ("event_time_epoch_us", T.LongType()),
                *_hours(),
                ("model_updated_at", T.TimestampNTZType()),
            ),
            partition_by=HOUR_COLUMNS,
            sort_by=("event_time", "transaction_id"),
            key=("transaction_id", "event_time_epoch_us"),
        ),
        TableSpec(
            "gold.gold_hourly_liquidity",
            _schema(
                ("hourly_liquidity_key", T.StringType()),
                ("hour_bucket", T.TimestampNTZType()),
                ("currency", T.StringType()),
                ("transaction_count", T.LongType()),
                ("suspicious_transaction_count", T.LongType()),
                ("total_amount", MONEY_SUM),
                ("net_amount", MONEY_SUM),
                *_hours(),
                ("model_updated_at", T.TimestampNTZType()),
            ),
            partition_by=HOUR_COLUMNS,
            sort_by=("hour_bucket", "currency"),
            key=("hourly_liquidity_key",),
        ),
    )
}

BRONZE = TABLES["bronze.transactions"]
REJECTED = TABLES["bronze.transactions_rejected"]
SILVER = TABLES["silver.transactions"]
ALERTS = TABLES["gold.gold_fraud_alerts"]
LIQUIDITY = TABLES["gold.gold_hourly_liquidity"]


def _widens(found: T.DataType, wanted: T.DataType) -> bool:
    """True when every value of ``found`` fits ``wanted`` unchanged."""
    if found == wanted or isinstance(found, T.NullType):
        return True
    integers = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    if found in integers and wanted in integers:
        return integers.index(found) <= integers.index(wanted)
    if isinstance(found, T.DecimalType) and isinstance(wanted, T.DecimalType):
        return found.scale <= wanted.scale and found.precision - found.scale <= wanted.precision - wanted.scale
    return False


def append_new_columns(current: T.StructType, newer: T.StructType) -> T.StructType:
    """``current`` with the unknown columns of ``newer`` appended; a changed type is an error."""
    known = {f.name: f.dataType for f in current}
    added = []
    for f in newer:
        if f.name not in known:
            added.append(T.StructField(f.name, f.dataType, True))
        elif not _widens(f.dataType, known[f.name]):
            raise ContractError(
                f"column {f.name!r} changed from {known[f.name].simpleString()} to {f.dataType.simpleString()}"
            )
    return T.StructType([*current.fields, *added])


def conform_to_contract(df: DataFrame, contract: T.StructType = CONTRACT) -> DataFrame:
    """Bring loaded data into contract order, under the append-only evolution rule.

    Missing columns are filled with their default, extra columns are kept last, and a column whose
    type is not the contract's (or a narrower one) is refused.
    """
    append_new_columns(contract, df.schema)
    present = set(df.columns)
    columns = []
    for f in contract:
        value = F.col(f.name) if f.name in present else F.lit(CONTRACT_DEFAULTS.get(f.name))
        columns.append(value.cast(f.dataType).alias(f.name))
    extras = [F.col(name) for name in df.columns if name not in contract.fieldNames()]
    return df.select(*columns, *extras)
