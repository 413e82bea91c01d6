"""The two streaming queries: raw events to Bronze and rejected rows, and raw events to Silver.

The queries are separate because their results are due at different times: Bronze takes every valid
row at once, late or not, while Silver waits until the watermark closes a window and then emits it
once. Each has its own checkpoint, and each micro-batch writes a folder named after the query and
the batch, so a batch that is replayed after a failure replaces its own output.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import PipelineConfig
from tidemark.contract import BRONZE, REJECTED, SILVER
from tidemark.operators.medallion import invalid, to_bronze, to_rejected, to_silver, valid, with_event_time
from tidemark.session import settings, use_utc
from tidemark.sources.folders import Folders
from tidemark.sources.tables import table_root, write_bronze, write_rejected, write_silver

START_TIMEOUT_SECONDS = 60
POLL_SECONDS = 1
# A stream's session plans without adaptive execution, since window state is bound to a fixed number
# of partitions. The write of a micro-batch comes after the state and has no such bond, and it needs
# adaptive execution to split a hot hour and merge slivers: usually a batch is nearly all one hour.
ADAPTIVE_WRITES = {"spark.sql.adaptive.enabled": "true"}


def _start(
    rows: DataFrame,
    write_batch: Callable[[DataFrame, str], None],
    name: str,
    config: PipelineConfig,
    available_now: bool,
) -> StreamingQuery:
    # The query id is kept in the checkpoint and survives restarts, but a new checkpoint gets a new
    # one: its batches, numbered from zero again, cannot overwrite the folders of an earlier query.
    started = threading.Event()
    query_id: list[str] = []

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if not started.wait(START_TIMEOUT_SECONDS):
            raise RuntimeError(f"query {name} did not report its id")
        with settings(batch.sparkSession, ADAPTIVE_WRITES):
            write_batch(batch, f"{query_id[0]}-{batch_id}")

    writer = (
        rows.writeStream.outputMode("append")
        .queryName(name)
        .option("checkpointLocation", _checkpoint(config, name))
        .foreachBatch(on_batch)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{config.trigger_interval_ms} milliseconds")
    with settings(use_utc(rows.sparkSession), config.stream_conf):
        query = writer.start()
    query_id.append(query.id)
    started.set()
    return query


def start_bronze(raw: DataFrame, config: PipelineConfig, available_now: bool = False) -> StreamingQuery:
    """Valid rows to Bronze and invalid rows to the rejected table, as soon as they arrive."""
    bronze_root = table_root(config.warehouse, BRONZE)
    rejected_root = table_root(config.warehouse, REJECTED)

    def write_batch(batch: DataFrame, load_id: str) -> None:
        # One read of the source feeds both sinks.
        batch.persist()
        try:
            write_bronze(to_bronze(valid(batch)), bronze_root, load_id)
            write_rejected(to_rejected(invalid(batch)), rejected_root, load_id)
        finally:
            batch.unpersist()

    return _start(with_event_time(raw), write_batch, "bronze", config, available_now)


def start_silver(raw: DataFrame, config: PipelineConfig, available_now: bool = False) -> StreamingQuery:
    """Deduplicated, masked rows of closed windows to Silver, each once."""
    root = table_root(config.warehouse, SILVER)
    rows = to_silver(
        valid(with_event_time(raw)),
        config.pii_hash_salt,
        config.dedup_window_minutes,
        config.watermark_lateness_seconds,
    )
    return _start(
        rows, lambda batch, load_id: write_silver(batch, root, load_id), "silver", config, available_now
    )


def start_medallion(
    raw: DataFrame,
    config: PipelineConfig,
    wait: bool | None = None,
    available_now: bool = False,
) -> list[StreamingQuery]:
    """Start both queries over one source; with ``wait`` (default: the config's choice) block until they end."""
    queries = [start_bronze(raw, config, available_now), start_silver(raw, config, available_now)]
    if config.wait_for_job if wait is None else wait:
        await_all(queries)
    return queries


def await_all(queries: list[StreamingQuery]) -> None:
    """Block until every query has ended. When one fails, stop the others and raise its error."""
    try:
        while any(query.isActive for query in queries):
            for query in queries:
                query.awaitTermination(POLL_SECONDS)
        for query in queries:
            query.awaitTermination()
    except Exception:
        for query in queries:
            query.stop()
        raise


def state_rows(query: StreamingQuery) -> int:
    """Rows of window state after the last micro-batch, to be watched against unbounded growth."""
    progress = query.lastProgress
    return sum(op["numRowsTotal"] for op in progress["stateOperators"]) if progress else 0


def open_windows(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """``transaction_id``, ``dedup_window_start``: windows the Silver query held after its last finished batch.

    Read from the state in its checkpoint, in as many tasks as the state has partitions; the query need not run.
    """
    state = spark.read.format("statestore").load(_checkpoint(config, "silver"))
    return state.select(
        F.col("key.transaction_id").alias("transaction_id"),
        F.col("key.window.start").cast("timestamp_ntz").alias("dedup_window_start"),
    )


def forget_last_commit(spark: SparkSession, config: PipelineConfig, name: str) -> int:
    """Leave a stopped query's checkpoint as a crash would, after a batch was written and before it was committed.

    The next start repeats that batch, whose number is returned.
    """
    folders = Folders(spark, _checkpoint(config, name))
    last = max(int(n) for n in folders.names("commits") if n.isdigit())
    folders.delete(f"commits/{last}")
    return last


def _checkpoint(config: PipelineConfig, name: str) -> str:
    return f"{config.checkpoint_dir.rstrip('/')}/{name}"
