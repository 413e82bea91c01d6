"""One runnable query per operator, over the driver's ``events`` table.

Each takes ``(spark, sf_dir)`` and returns a DataFrame. Wall-clock columns are left out and "now" is
a fixed instant, so that results repeat. The counterpart of each in plain SQL is in
``driver_sql.py``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import PipelineConfig
from tidemark.contract import (
    ALERTS,
    BRONZE,
    CONTRACT,
    HOUR_COLUMNS,
    LIQUIDITY,
    REJECTED,
    SILVER,
    conform_to_contract,
)
from tidemark.functions import (
    epoch_micros,
    hour_key_before,
    money,
    partition_hour_filter,
    partition_hour_key,
    split_hour_key,
)
from tidemark.functions.partition_hours import cutoff_hour_key
from tidemark.operators import medallion as m
from tidemark.operators.compact import compact_layer, compact_partitions, file_sizes
from tidemark.operators.gold import fraud_alerts, hourly_liquidity
from tidemark.operators.merge import merge_incremental
from tidemark.operators.layout import order_violations, read_places
from tidemark.operators.quality import (
    check_accepted,
    check_alert_rule,
    check_liquidity_bounds,
    check_not_null,
    check_unique,
    run_checks,
    table_checks,
)
from tidemark.plans.gold_build import GoldModel, build_gold
from tidemark.plans.medallion_batch import build_silver
from tidemark.session import shared_folder, use_utc
from tidemark.sources.events_view import read_events, stream_events, transactions_from_events
from tidemark.sources.layers import compacted_root, read_layered
from tidemark.sources.tables import (
    add_partitions,
    count_rows,
    create_tables,
    drop_tables,
    read_hours,
    read_silver,
    read_table,
    table_root,
    write_rejected,
    write_silver,
    write_table,
)
from tidemark.sources.transactions import read_transactions_stream
from tidemark.streaming.medallion import (
    await_all,
    forget_last_commit,
    open_windows,
    start_bronze,
    start_medallion,
    start_silver,
)

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared with the SQL counterparts.
SALT = "0123456789abcdef0123456789abcdef"
AS_OF = datetime(2024, 1, 31)
LOOKBACK_HOURS = 48
BACKFILL = {"start_key": 2024011006, "end_key": 2024011917}
FIRST_BUILD_END = 2024012912
COMPARED_KEY = 2024011512
LATENESS_SECONDS = 5
WALL_CLOCK = ("ingest_time", "rejected_at", "model_updated_at")

QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_utc(spark)
        return fn(spark, sf_dir).drop(*WALL_CLOCK)

    QUERIES[fn.__name__] = run
    return fn


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(read_events(spark, sf_dir))


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.with_event_time(raw(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str, minutes: int = 1) -> DataFrame:
    return m.to_silver(m.valid(timed(spark, sf_dir)), SALT, minutes)


_stored: dict[tuple[str, ...], str] = {}


def _silver_root(spark: SparkSession, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        _stored[key] = build_silver(raw(spark, sf_dir), shared_folder(spark, "warehouse"), SALT)
    return _stored[key]


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as a table, built once per application: what Gold reads in production."""
    return read_silver(spark, _silver_root(spark, sf_dir))


def silver_hours(
    spark: SparkSession, sf_dir: str, start_key: int | None = None, end_key: int | None = None
) -> DataFrame:
    """Some hours of the stored Silver; the folders of others are not listed."""
    return read_hours(spark, _silver_root(spark, sf_dir), SILVER, start_key, end_key)


# --- sources, contract, event time ---------------------------------------------------------------


@_query
def contract_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data of an older producer: no flag, no location, a narrower amount, one column more."""
    older = raw(spark, sf_dir).select(
        F.lit("v1").alias("producer_version"),
        "event_time_epoch_us",
        "transaction_id",
        "account_id",
        F.col("amount").cast("decimal(12,2)").alias("amount"),
        "currency",
        "device_id",
    )
    return conform_to_contract(older)


@_query
def epoch_and_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events(spark, sf_dir).select(
        "event_id", epoch_micros(F.col("ts")).alias("epoch_us"), money(F.col("value")).alias("amount")
    )


@_query
def transactions_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed(spark, sf_dir).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


# --- Bronze, rejected, Silver --------------------------------------------------------------------


@_query
def bronze_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.to_bronze(m.valid(timed(spark, sf_dir)))


@_query
def bronze_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.to_rejected(m.invalid(timed(spark, sf_dir)))


@_query
def rejected_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = m.with_reject_reason(m.invalid(timed(spark, sf_dir)))
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@_query
def silver_dedup_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir)


@_query
def silver_five_minute_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir, minutes=5)


@_query
def silver_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.silver_sample(silver(spark, sf_dir))


# --- Gold ----------------------------------------------------------------------------------------


@_query
def gold_fraud_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud_alerts(silver(spark, sf_dir))


@_query
def gold_hourly_liquidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_liquidity(silver(spark, sf_dir))


@_query
def gold_alerts_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud_alerts(silver_hours(spark, sf_dir, **BACKFILL), **BACKFILL)


@_query
def gold_liquidity_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_liquidity(silver_hours(spark, sf_dir, **BACKFILL), **BACKFILL)


@_query
def gold_alerts_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud_alerts(stored_silver(spark, sf_dir), cutoff_key=cutoff_hour_key(AS_OF, LOOKBACK_HOURS))


@_query
def gold_liquidity_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_liquidity(stored_silver(spark, sf_dir), cutoff_key=cutoff_hour_key(AS_OF, LOOKBACK_HOURS))


def _stale(df: DataFrame) -> DataFrame:
    return df.where(F.col("event_time_epoch_us") % 2 == 0)


def _built_incrementally(spark: SparkSession, sf_dir: str, model: str) -> str:
    """A first build over part of Silver that ends early, then an incremental one over all of it."""
    warehouse = shared_folder(spark, "warehouse")
    rows = stored_silver(spark, sf_dir)
    build_gold(spark, model, _stale(rows), warehouse, end_key=FIRST_BUILD_END)
    return build_gold(spark, model, rows, warehouse, as_of=AS_OF, lookback_hours=LOOKBACK_HOURS)


@_query
def gold_alerts_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _built_incrementally(spark, sf_dir, "gold_fraud_alerts"), ALERTS)


@_query
def gold_liquidity_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _built_incrementally(spark, sf_dir, "gold_hourly_liquidity"), LIQUIDITY)


@_query
def gold_alerts_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full build, then an incremental one over all hours of the same Silver: nothing changes."""
    warehouse = shared_folder(spark, "warehouse")
    rows = stored_silver(spark, sf_dir)
    build_gold(spark, "gold_fraud_alerts", rows, warehouse, as_of=AS_OF)
    root = build_gold(spark, "gold_fraud_alerts", rows, warehouse, as_of=AS_OF, lookback_hours=24 * 366)
    return read_table(spark, root, ALERTS)


@_query
def gold_added_column_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first build with one column more than the model, then the plain model over the lookback hours."""
    warehouse = shared_folder(spark, "warehouse")
    rows = stored_silver(spark, sf_dir)

    def wider(silver: DataFrame, **hours: int | None) -> DataFrame:
        return hourly_liquidity(silver, **hours).withColumn("mean_amount", _mean_amount())

    build_gold(spark, GoldModel(LIQUIDITY, wider), rows, warehouse, end_key=FIRST_BUILD_END)
    root = build_gold(spark, "gold_hourly_liquidity", rows, warehouse, as_of=AS_OF, lookback_hours=LOOKBACK_HOURS)
    return read_table(spark, root, LIQUIDITY.with_columns(wider(rows).schema))


def _mean_amount() -> Column:
    return (F.col("total_amount") / F.col("transaction_count")).cast("decimal(18,2)")


@_query
def merge_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert of the lookback hours with a column the target does not have yet."""
    rows = stored_silver(spark, sf_dir)
    cutoff = cutoff_hour_key(AS_OF, LOOKBACK_HOURS)
    target = hourly_liquidity(_stale(rows), end_key=FIRST_BUILD_END)
    updates = hourly_liquidity(rows, cutoff_key=cutoff).withColumn("mean_amount", _mean_amount())
    return merge_incremental(target, updates, LIQUIDITY.key, partition_hour_filter(">=", cutoff))


# --- hour keys -----------------------------------------------------------------------------------


@_query
def partition_hour_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = silver(spark, sf_dir).select(
        "transaction_id",
        "event_time",
        partition_hour_key().alias("hour_key"),
        hour_key_before(F.col("event_time"), LOOKBACK_HOURS).alias("cutoff_key"),
    )
    parts = zip(HOUR_COLUMNS, split_hour_key(F.col("cutoff_key")))
    return keyed.select("*", *[part.cast("int").alias(f"cutoff_{name}") for name, part in parts])


@_query
def partition_hour_comparisons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows per comparison of their hour with one key."""
    comparisons = {"ge": ">=", "le": "<=", "gt": ">", "lt": "<", "eq": "=", "ne": "<>"}
    return silver(spark, sf_dir).agg(
        *[F.count_if(partition_hour_filter(op, COMPARED_KEY)).alias(f"n_{name}") for name, op in comparisons.items()]
    )


# --- counts and checks ---------------------------------------------------------------------------


@_query
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = timed(spark, sf_dir)
    rows = stored_silver(spark, sf_dir)
    return count_rows(
        {
            BRONZE.name: m.to_bronze(m.valid(events)),
            REJECTED.name: m.to_rejected(m.invalid(events)),
            SILVER.name: rows,
            ALERTS.name: fraud_alerts(rows),
            LIQUIDITY.name: hourly_liquidity(rows),
        }
    )


@_query
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored_silver(spark, sf_dir)
    return run_checks({SILVER.name: rows, ALERTS.name: fraud_alerts(rows), LIQUIDITY.name: hourly_liquidity(rows)})


@_query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_not_null(silver(spark, sf_dir), list(table_checks()[SILVER.name].not_null))


@_query
def dq_not_null_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_not_null(raw(spark, sf_dir), CONTRACT.fieldNames())


@_query
def dq_duplicate_alert_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(fraud_alerts(silver(spark, sf_dir)), "fraud_alert_key")


@_query
def dq_unaccepted_currencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value check against a list that two of the five currencies are not on."""
    return check_accepted(silver(spark, sf_dir), "currency", ("USD", "EUR", "JPY"))


@_query
def dq_liquidity_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_liquidity_bounds(hourly_liquidity(silver(spark, sf_dir)))


@_query
def dq_alert_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_alert_rule(fraud_alerts(silver(spark, sf_dir)))


@_query
def dq_silver_outside_alert_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same check on all of Silver: the rows that raise no alert."""
    return check_alert_rule(silver(spark, sf_dir)).select("transaction_id", "event_time", "amount", "location")


# --- streaming -----------------------------------------------------------------------------------


def _stream_config(spark: SparkSession) -> PipelineConfig:
    return PipelineConfig(
        warehouse=shared_folder(spark, "warehouse"),
        checkpoint_dir=shared_folder(spark, "stream"),
        pii_hash_salt=SALT,
        watermark_lateness_seconds=LATENESS_SECONDS,
    )


def _stream(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, PipelineConfig]:
    return transactions_from_events(stream_events(spark, sf_dir)), _stream_config(spark)


def _streamed_silver(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, PipelineConfig]:
    source, config = _stream(spark, sf_dir)
    await_all([start_silver(source, config, available_now=True)])
    return read_silver(spark, table_root(config.warehouse, SILVER)), config


def _streamed_bronze(spark: SparkSession, sf_dir: str) -> PipelineConfig:
    source, config = _stream(spark, sf_dir)
    await_all([start_bronze(source, config, available_now=True)])
    return config


@_query
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed_silver(spark, sf_dir)[0]


@_query
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _streamed_bronze(spark, sf_dir)
    return read_table(spark, table_root(config.warehouse, BRONZE), BRONZE)


@_query
def stream_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _streamed_bronze(spark, sf_dir)
    return read_table(spark, table_root(config.warehouse, REJECTED), REJECTED)


@_query
def stream_medallion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both queries over one source, then the rows that reached each sink."""
    source, config = _stream(spark, sf_dir)
    start_medallion(source, config, wait=True, available_now=True)
    sinks = (BRONZE, REJECTED, SILVER)
    return count_rows({s.name: read_table(spark, table_root(config.warehouse, s), s) for s in sinks})


@_query
def stream_to_gold_liquidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the event stream to a Gold table: streamed Silver, then a first Gold build."""
    rows, config = _streamed_silver(spark, sf_dir)
    root = build_gold(spark, "gold_hourly_liquidity", rows, config.warehouse, as_of=AS_OF)
    return read_table(spark, root, LIQUIDITY)


#: Seconds by which some events of a staged stream come late: beyond the watermark's lateness.
DELAY_SECONDS = 172_800
#: Files of a staged stream, in the order they arrive; each is a micro-batch.
STAGED_FILES = 6
#: Last digits of the event ids that come late.
LATE_DIGITS = (4, 6, 7)


def staged_events(spark: SparkSession, sf_dir: str, delay_seconds: int = 0) -> str:
    """The raw events as files that arrive one after the other, each event at its time or, if it is one of the late, later.

    The files cut the time of arrival into equal parts; rows without a valid time come with the first one.
    """
    key = (spark.sparkContext.applicationId, sf_dir, f"staged-{delay_seconds}")
    if key not in _stored:
        events = raw(spark, sf_dir)
        digit = F.substring("transaction_id", -1, 1).cast("int")
        delay = F.when(digit.isin(*LATE_DIGITS), delay_seconds * 1_000_000).otherwise(0)
        arrival = F.when(m.is_valid(), F.col(m.EPOCH) + delay)
        span = events.agg(
            F.min(arrival).alias("first"), F.max(arrival).alias("last"), F.count(F.lit(1)).alias("rows")
        ).first()
        part = F.call_function("div", (arrival - span["first"]) * STAGED_FILES, F.lit(span["last"] - span["first"] + 1))
        arrived = events.withColumn("part", F.coalesce(part, F.lit(0).cast("long")).cast("int"))
        _stored[key] = shared_folder(spark, "staged")
        # A part in about as many files as the session has cores, so that many tasks read and copy it;
        # its rows keep their order, which compresses as well as one file.
        per_file = -(-span["rows"] // (STAGED_FILES * spark.sparkContext.defaultParallelism))
        writer = arrived.repartitionById(STAGED_FILES, "part").write.option("maxRecordsPerFile", max(per_file, 1))
        writer.partitionBy("part").parquet(_stored[key])
    return _stored[key]


class _Staged:
    """The staged parts, let into a stream's source folder one at a time.

    A part arrives as one file, a micro-batch of its own however many parts arrive before a run; or,
    ``spread``, in many files that one micro-batch reads in many tasks, which holds as long as one
    part arrives before each run.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, delay_seconds: int = 0, spread: bool = False):
        self.spark, self.folder = spark, staged_events(spark, sf_dir, delay_seconds)
        self.source, self.config = shared_folder(spark, "arrived"), _stream_config(spark)
        self.files, self.spread = 0, spread

    def arrive(self, files: int = 1) -> DataFrame:
        for _ in range(files):
            rows = self.spark.read.schema(CONTRACT).parquet(f"{self.folder}/part={self.files}")
            (rows if self.spread else rows.coalesce(1)).write.mode("append").parquet(self.source)
            self.files += 1
        return read_transactions_stream(self.spark, self.source, max_files=None if self.spread else 1)


@_query
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that came after their window was closed: in Bronze, but in no window of Silver.

    Several files make as many micro-batches, so the watermark moves while the streams run.
    """
    staged = _Staged(spark, sf_dir, DELAY_SECONDS, spread=True)
    for _ in range(STAGED_FILES):
        start_medallion(staged.arrive(), staged.config, wait=True, available_now=True)
    bronze = read_layered(spark, staged.config.warehouse, BRONZE)
    windows = read_layered(spark, staged.config.warehouse, SILVER).select("transaction_id", "dedup_window_start")
    start = F.date_trunc("minute", F.col("event_time")).cast("timestamp_ntz")
    rows = bronze.select("transaction_id", start.alias("dedup_window_start"), "event_time")
    return rows.join(windows, ["transaction_id", "dedup_window_start"], "left_anti")


@_query
def stream_restarted_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Silver stream that is stopped between files, resumed twice, and made to repeat its last batch."""
    staged = _Staged(spark, sf_dir)
    for files in (2, 1, STAGED_FILES - 3):
        await_all([start_silver(staged.arrive(files), staged.config, available_now=True)])
    forget_last_commit(spark, staged.config, "silver")
    await_all([start_silver(staged.arrive(0), staged.config, available_now=True)])
    return read_layered(spark, staged.config.warehouse, SILVER)


@_query
def stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that a stream still holds after its last batch, read from the state in its checkpoint."""
    staged = _Staged(spark, sf_dir, DELAY_SECONDS, spread=True)
    for _ in range(STAGED_FILES):
        await_all([start_silver(staged.arrive(), staged.config, available_now=True)])
    return open_windows(spark, staged.config)


# --- upkeep --------------------------------------------------------------------------------------


def _two_loads(spark: SparkSession, sf_dir: str) -> str:
    """A warehouse whose Silver has two loads, with the rows of every hour split between them."""
    warehouse = shared_folder(spark, "warehouse")
    rows = stored_silver(spark, sf_dir)
    for number in range(2):
        write_silver(rows.where(F.crc32("transaction_id") % 2 == number), table_root(warehouse, SILVER), f"batch-{number}")
    return warehouse


@_query
def compact_files_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of each hour after the closed hours of a fragmented Silver table have been taken into the layer."""
    warehouse = _two_loads(spark, sf_dir)
    compact_layer(spark, warehouse, SILVER, end_key=FIRST_BUILD_END)
    files = file_sizes(spark, compacted_root(warehouse, SILVER))
    return files.groupBy(partition_hour_key().alias("hour_key")).agg(F.count(F.lit(1)).alias("files"))


@_query
def layered_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver read from its compacted layer and the live loads, after a load that came later than the compaction."""
    warehouse = shared_folder(spark, "warehouse")
    rows, root = stored_silver(spark, sf_dir), table_root(warehouse, SILVER)
    for number in range(2):
        write_silver(rows.where(F.crc32("transaction_id") % 3 == number), root, f"batch-{number}")
    compact_layer(spark, warehouse, SILVER, end_key=FIRST_BUILD_END)
    write_silver(rows.where(F.crc32("transaction_id") % 3 == 2), root, "batch-2")
    return read_layered(spark, warehouse, SILVER)


@_query
def written_order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring rows of a file that are not in the table's order: in Silver as written, and in a shuffled copy."""
    written = _silver_root(spark, sf_dir)
    copy = f"{shared_folder(spark, 'warehouse')}/copy"
    # One file whose rows are in the order of their identifiers: sorted in ranges by many tasks, then
    # written range after range by one.
    stored_silver(spark, sf_dir).orderBy("transaction_id", "event_time").coalesce(1).write.parquet(copy)
    tables = {"as_written": written, "by_id": copy}
    found = [
        order_violations(read_places(spark, root, SILVER), SILVER)
        .agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit(name).alias("layout"), "violations")
        for name, root in tables.items()
    ]
    return found[0].unionByName(found[1])


@_query
def catalog_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table by SQL on the names that the tables have in the catalog, after partitions came in two steps."""
    warehouse, prefix = shared_folder(spark, "warehouse"), f"counted_{uuid.uuid4().hex}_"
    rows, root = stored_silver(spark, sf_dir), table_root(warehouse, SILVER)
    write_silver(rows.where(F.crc32("transaction_id") % 2 == 0), root, "batch-0")
    write_table(hourly_liquidity(rows), table_root(warehouse, LIQUIDITY), LIQUIDITY)
    create_tables(spark, warehouse, prefix)
    try:
        add_partitions(spark, warehouse, prefix=prefix)
        write_silver(rows.where(F.crc32("transaction_id") % 2 == 1), root, "batch-1")
        write_rejected(m.to_rejected(m.invalid(timed(spark, sf_dir))), table_root(warehouse, REJECTED), "batch-0")
        add_partitions(spark, warehouse, prefix=prefix)
        tables = (SILVER, REJECTED, LIQUIDITY)
        counts = " UNION ALL ".join(
            f"SELECT '{t.name}' AS table_name, count(*) AS row_count FROM {prefix}{t.name}" for t in tables
        )
        return spark.createDataFrame(spark.sql(counts).collect(), "table_name string, row_count long")  # a row per table
    finally:
        drop_tables(spark, prefix)


@_query
def compact_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed hours of a fragmented Silver table, compacted into another root."""
    warehouse = _two_loads(spark, sf_dir)
    compacted = f"{warehouse}/compacted/{SILVER.path}"
    compact_partitions(spark, table_root(warehouse, SILVER), compacted, SILVER, end_key=FIRST_BUILD_END)
    return read_table(spark, compacted, SILVER)


@_query
def compact_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Gold table with several files per hour, compacted in place."""
    rows = hourly_liquidity(stored_silver(spark, sf_dir))
    root = table_root(shared_folder(spark, "warehouse"), LIQUIDITY)
    (
        rows.repartition(*LIQUIDITY.partition_by, F.crc32("currency") % 2)
        .write.mode("overwrite")
        .partitionBy(*LIQUIDITY.partition_by)
        .parquet(root)
    )
    compact_partitions(spark, root, root, LIQUIDITY)
    return read_table(spark, root, LIQUIDITY)
