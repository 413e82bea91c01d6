"""Scripted streams: one file per step, each step an available-now run on the same checkpoint."""

import pytest
from pyspark.sql import functions as F

from helpers import at, event, events, multiset
from tidemark.config import PipelineConfig
from tidemark.contract import BRONZE, REJECTED, SILVER
from tidemark.operators import medallion as m
from tidemark.sources.tables import read_table, table_root
from tidemark.sources.transactions import read_transactions_kafka, read_transactions_stream
from tidemark.streaming.medallion import (
    await_all,
    forget_last_commit,
    open_windows,
    start_bronze,
    start_medallion,
    start_silver,
    state_rows,
)


class Stream:
    def __init__(self, spark, folder, salt):
        self.spark, self.folder, self.input = spark, folder, f"{folder}/in"
        self.config = PipelineConfig(
            warehouse=f"{folder}/lake",
            checkpoint_dir=f"{folder}/checkpoint",
            pii_hash_salt=salt,
            parallelism=2,
            trigger_interval_ms=1_000,
        )

    def add(self, *rows):
        events(self.spark, *rows).coalesce(1).write.mode("append").parquet(self.input)

    def source(self, max_files=None):
        return read_transactions_stream(self.spark, self.input, max_files)

    def step(self, *rows, start=start_silver):
        if rows:
            self.add(*rows)
        query = start(self.source(), self.config, available_now=True)
        await_all([query])
        return query

    def table(self, spec):
        return read_table(self.spark, table_root(self.config.warehouse, spec), spec)

    def silver(self):
        rows = self.table(SILVER).select("transaction_id", F.minute("dedup_window_start")).collect()
        return sorted(map(tuple, rows))


@pytest.fixture()
def stream(spark, tmp_path, salt):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield Stream(spark, str(tmp_path), salt)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before != "2"


def test_windows_close_once_and_late_rows_are_dropped(stream):
    stream.step(event("a", at(0.001)), event("b", at(0.010)), event("a", at(59.999)))
    assert stream.silver() == []
    stream.step(event("c", at(64.999)))
    assert stream.silver() == []
    stream.step(event("d", at(65)))
    assert stream.silver() == [("a", 34), ("b", 34)]
    stream.step(event("late", at(0.030)), event("a", at(60.001)))
    assert stream.silver() == [("a", 34), ("b", 34)]
    query = stream.step(event("z", at(300)))
    assert stream.silver() == [("a", 34), ("a", 35), ("b", 34), ("c", 35), ("d", 35)]
    assert state_rows(query) == 1
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 2
    assert "rocksdbCommitCheckpointLatency" in query.lastProgress["stateOperators"][0]["customMetrics"]
    # A run without new data emits nothing again.
    stream.step()
    assert len(stream.silver()) == 5


def test_bronze_keeps_late_and_repeated_rows(stream):
    stream.step(event("a", at(1)), event("z", at(600)), start=start_bronze)
    stream.step(event("a", at(1)), event(None), event("bad", epoch=7), start=start_bronze)
    assert sorted(r.transaction_id for r in stream.table(BRONZE).collect()) == ["a", "a", "z"]
    reasons = stream.table(REJECTED).groupBy("reject_reason").count().collect()
    assert sorted(map(tuple, reasons)) == [("INVALID_EVENT_TIME", 1), ("MISSING_TRANSACTION_ID", 1)]


def test_rejected_rows_do_not_move_the_watermark(stream):
    stream.step(event("a", at(1)), event(None, epoch=at(900)), event("x", epoch=at(900) * 10))
    assert stream.silver() == []


def test_one_file_per_batch_equals_batch_result(spark, stream, salt):
    rows = [event(f"t{i % 40}", at(i * 7.3), account_id=f"acct_{i % 3}") for i in range(160)]
    for i in range(0, 160, 40):
        stream.add(*rows[i : i + 40])
    stream.add(event("closing", at(7200)))
    queries = start_medallion(stream.source(max_files=1), stream.config, wait=True, available_now=True)
    assert all(not q.isActive for q in queries)
    batch = m.to_silver(m.valid(m.with_event_time(events(spark, *rows))), salt)
    columns = [c for c in SILVER.columns if c != "ingest_time"]
    assert multiset(stream.table(SILVER), columns) == multiset(batch, columns)
    assert stream.table(BRONZE).count() == 161


def test_replayed_batch_replaces_its_own_output(stream):
    import glob
    import os

    stream.step(event("a", at(1)), start=start_bronze)
    stream.step(event("b", at(2)), start=start_bronze)
    # As after a crash between the write and the commit: the last batch has no commit mark.
    commits = glob.glob(f"{stream.config.checkpoint_dir}/bronze/commits/*")
    last = max((c for c in commits if os.path.basename(c).isdigit()), key=lambda c: int(os.path.basename(c)))
    os.replace(last, f"{stream.folder}/uncommitted")
    crc = os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")
    if os.path.exists(crc):
        os.replace(crc, f"{stream.folder}/uncommitted.crc")
    stream.step(start=start_bronze)
    assert sorted(r.transaction_id for r in stream.table(BRONZE).collect()) == ["a", "b"]


def test_state_holds_open_windows_only(spark, stream):
    """After each batch the state is what the watermark has not closed, however many rows came before."""
    for hour in range(4):
        query = stream.step(*[event(f"t{hour}-{i}", at(hour * 3600 + i * 90)) for i in range(20)])
        held = open_windows(spark, stream.config).collect()
        assert state_rows(query) == len(held) == 1
        assert [r.transaction_id for r in held] == [f"t{hour}-19"]
        assert len(stream.silver()) == 20 * (hour + 1) - 1


def test_repeated_last_batch_adds_nothing(spark, stream):
    stream.step(event("a", at(1)), event("b", at(2)))
    stream.step(event("z", at(600)))
    before = stream.silver()
    assert before == [("a", 34), ("b", 34)]
    batch = forget_last_commit(spark, stream.config, "silver")
    query = stream.step()
    assert query.lastProgress["batchId"] == batch
    assert stream.silver() == before
    stream.step(event("y", at(1200)))
    assert stream.silver() == [*before, ("z", 44)]


def test_new_checkpoint_does_not_overwrite_earlier_loads(stream, salt):
    stream.step(event("a", at(1)), start=start_bronze)
    stream.config = PipelineConfig(
        warehouse=stream.config.warehouse, checkpoint_dir=f"{stream.folder}/second", pii_hash_salt=salt, parallelism=2
    )
    stream.step(start=start_bronze)
    assert [r.transaction_id for r in stream.table(BRONZE).collect()] == ["a", "a"]


def test_failed_query_is_reported(stream):
    broken = stream.add(event("a", at(1))) or stream.source().withColumn(
        "location", F.raise_error(F.concat(F.lit("broken "), F.col("transaction_id"))).cast("string")
    )
    with pytest.raises(Exception, match="broken a"):
        await_all([start_bronze(broken, stream.config, available_now=True)])


def test_detached_start(stream):
    stream.add(event("a", at(1)))
    queries = start_medallion(stream.source(), stream.config)
    try:
        assert [q.name for q in queries] == ["bronze", "silver"] and all(q.isActive for q in queries)
    finally:
        for q in queries:
            q.processAllAvailable()
            q.stop()
    assert stream.table(BRONZE).count() == 1


def test_kafka_needs_its_packages(spark):
    with pytest.raises(Exception, match="(?i)kafka|avro"):
        read_transactions_kafka(spark, "localhost:1", "financial.transactions")
