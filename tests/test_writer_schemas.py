"""Messages of several writers, decoded by the schema id in their header; JSON payloads stand for Avro."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.contract import CONTRACT, CONTRACT_DEFAULTS, ContractError
from tidemark.sources.transactions import events_by_schema, schema_id

OLD = "event_time_epoch_us bigint, transaction_id string, amount decimal(12,2), currency string"
NEW = "transaction_id string, account_id string, amount decimal(18,2), is_flagged_suspicious boolean, channel string"


def from_json_bytes(payload, schema):
    return F.from_json(payload.cast("string"), schema)


def message(number, **fields):
    return bytearray(b"\x00" + number.to_bytes(4, "big") + json.dumps(fields).encode())


def table(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value binary")


def test_each_message_has_its_writers_schema(spark):
    rows = table(
        spark,
        message(7, transaction_id="a", amount=1.5, currency="USD", event_time_epoch_us=5),
        message(70_000, transaction_id="b", amount=2.25, account_id="x", is_flagged_suspicious=True, channel="web"),
    )
    assert [r[0] for r in rows.select(schema_id(F.col("value"))).collect()] == [7, 70_000]
    found = events_by_schema(rows, {7: OLD, 70_000: NEW}, from_json_bytes)
    assert found.columns == CONTRACT.fieldNames() and [f.dataType for f in found.schema] == [f.dataType for f in CONTRACT]
    a, b = sorted(found.collect(), key=lambda r: r.transaction_id)
    assert (a.event_time_epoch_us, str(a.amount), a.currency, a.account_id) == (5, "1.50", "USD", None)
    assert a.is_flagged_suspicious is CONTRACT_DEFAULTS["is_flagged_suspicious"]
    assert (b.event_time_epoch_us, str(b.amount), b.account_id, b.is_flagged_suspicious) == (None, "2.25", "x", True)


def test_unknown_writers_are_refused(spark):
    for value in (message(8, transaction_id="a"), bytearray(b""), None):
        with pytest.raises(Exception, match="no writer schema"):
            events_by_schema(table(spark, message(7, transaction_id="b"), value), {7: OLD}, from_json_bytes).collect()
    with pytest.raises(ContractError):
        events_by_schema(table(spark), {7: "transaction_id bigint"}, from_json_bytes)
    with pytest.raises(ValueError, match="at least one"):
        events_by_schema(table(spark), {}, from_json_bytes)


def test_messages_are_read_once(spark):
    plan = events_by_schema(table(spark, message(7)), {7: OLD, 8: NEW}, from_json_bytes)
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 1
