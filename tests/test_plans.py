"""The physical plans that scale: pruned scans, partial aggregation, no needless shuffle, no Python."""

import re
from datetime import datetime

import pytest

from helpers import at, event, events
from tidemark.contract import ALERTS, SILVER
from tidemark.functions import partition_hour_filter
from tidemark.operators import medallion as m
from tidemark.operators.gold import fraud_alerts, hourly_liquidity
from tidemark.operators.merge import merge_incremental
from tidemark.plans import driver_queries
from tidemark.plans.medallion_batch import build_silver
from tidemark.sources.tables import read_silver
from tidemark.sources.transactions import read_transactions


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def initial_tree(df):
    return plan(df, "simple")


@pytest.fixture(scope="module")
def silver(spark, salt, tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("lake"))
    rows = [event(f"t{i}", at(i * 1800.0)) for i in range(8)]
    return read_silver(spark, build_silver(events(spark, *rows), warehouse, salt))


def test_fraud_alerts_only_scan_filter_project(silver):
    text = plan(fraud_alerts(silver, cutoff_key=2026053013))
    assert "Exchange" not in text and "Sort" not in text
    assert re.search(r"PartitionFilters: \[.*year#\d+ > 2026", text)
    pushed = re.search(r"PushedFilters: \[(.*?)\]\n", text)[1]
    assert "IsNotNull(transaction_id)" in pushed and "IsNotNull(amount)" in pushed
    schema = re.search(r"ReadSchema: struct<(.*)>", text)[1]
    assert "dedup_window" not in schema and "ingest_time" not in schema


def test_liquidity_aggregates_before_its_only_shuffle(silver):
    text = plan(hourly_liquidity(silver, start_key=2026053012, end_key=2026053013))
    tree = text[: text.index("(1) Scan")]
    assert tree.count("HashAggregate") == 2 and tree.count("Exchange") == 1
    schema = re.search(r"ReadSchema: struct<(.*)>", text)[1]
    assert {c.split(":")[0] for c in schema.split(",") if ":" in c} == {"amount", "currency", "is_flagged_suspicious", "event_time"}
    assert "PartitionFilters" in text


def test_partition_filters_skip_files(silver):
    for op, rows in (("=", 2), (">=", 7), ("<=", 3)):
        chosen = silver.where(partition_hour_filter(op, 2026053013))
        text = plan(chosen)
        filters = re.search(r"PartitionFilters: \[(.*?)\]\n", text)[1]
        assert "hour#" in filters and chosen.count() == rows


def test_dedup_combines_before_its_only_shuffle(spark, tmp_path):
    events(spark, event()).write.mode("overwrite").parquet(str(tmp_path))
    raw = read_transactions(spark, str(tmp_path))
    text = plan(m.dedup_window(m.valid(m.with_event_time(raw))))
    tree = text[: text.index("(1) Scan")]
    assert tree.count("Exchange") == 1 and tree.count("Aggregate") == 2
    pushed = re.search(r"PushedFilters: \[(.*?)\]\n", text)[1]
    assert "IsNotNull(transaction_id)" in pushed
    assert "GreaterThanOrEqual(event_time_epoch_us,1000000000000000)" in pushed


def test_merge_never_multiplies_rows(silver):
    updates = fraud_alerts(silver, cutoff_key=2026053013)
    text = plan(merge_incremental(fraud_alerts(silver), updates, ALERTS.key))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_no_query_leaves_the_jvm_or_forces_a_broadcast(spark, sf_dir):
    for name, query in driver_queries.QUERIES.items():
        if name.startswith(("stream", "compact")) or name.endswith(("_incremental", "_rebuild", "_kept")):
            continue
        text = plan(query(spark, sf_dir))
        for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert operator not in text, (name, operator)


def test_columns_of_silver_spec(silver):
    assert silver.columns == SILVER.columns
    assert isinstance(silver.first().event_time, datetime)
