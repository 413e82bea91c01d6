import hashlib
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import (
    alert_reason,
    cutoff_hour_key,
    epoch_micros,
    event_time_of,
    fraud_rule,
    hour_key_before,
    is_risky_location,
    mask_pii,
    money,
    partition_hour_filter,
    partition_hour_key,
    split_hour_key,
)


def _one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_event_time_range_and_millisecond_cut(spark):
    cases = [
        (None, None),
        (999_999_999_999_999, None),
        (1_000_000_000_000_000, datetime(2001, 9, 9, 1, 46, 40)),
        (1_780_144_496_123_456, datetime(2026, 5, 30, 12, 34, 56, 123000)),
        (9_999_999_999_999_999, datetime(2286, 11, 20, 17, 46, 39, 999000)),
        (10_000_000_000_000_000, None),
    ]
    df = spark.createDataFrame([(e,) for e, _ in cases], "e bigint")
    assert _one(df, event_time_of(F.col("e")).cast("timestamp_ntz")) == [t for _, t in cases]


def test_epoch_micros_keeps_microseconds(spark):
    df = spark.sql("SELECT timestamp_ntz '2026-05-30 12:34:56.123456' AS n, timestamp '2026-05-30 12:34:56.123456Z' AS z")
    assert df.select(epoch_micros(F.col("n")), epoch_micros(F.col("z"))).first() == (1_780_144_496_123_456,) * 2


def test_money_rounds_half_up(spark):
    df = spark.createDataFrame([(0.005,), (1.005,), (2.675,), (0.004999999999999,), (12.0,)], "v double")
    assert _one(df, money(F.col("v"))) == [Decimal(x) for x in ("0.01", "1.01", "2.68", "0.00", "12.00")]


def test_mask_matches_salted_sha256(spark, salt):
    df = spark.createDataFrame([("acct_1",), (None,), ("",), ("ünïcode",)], "id string")
    wanted = [
        "ACC-SHA256-" + hashlib.sha256(f"{salt}:{x or ''}".encode()).hexdigest()[:32]
        for x in ("acct_1", None, "", "ünïcode")
    ]
    assert _one(df, mask_pii(F.col("id"), salt, "ACC-SHA256-")) == wanted
    assert wanted[1] == wanted[2]


BOUNDARY_HOURS = [
    (2023, 12, 31, 23),
    (2024, 1, 1, 0),
    (2024, 1, 31, 23),
    (2024, 2, 1, 0),
    (2024, 2, 28, 23),
    (2024, 2, 29, 0),
    (2024, 2, 29, 12),
    (2025, 1, 1, 0),
]


@pytest.mark.parametrize("op", [">=", "<=", ">", "<", "=", "<>", "!="])
@pytest.mark.parametrize("as_column", [False, True])
def test_hour_filter_equals_packed_comparison(spark, op, as_column):
    df = spark.createDataFrame(BOUNDARY_HOURS, "year int, month int, day int, hour int").alias("t")
    for key in (2024010100, 2024022912, 2024013123, 2026010100):
        bound = F.lit(key) if as_column else key
        got = {tuple(r) for r in df.where(partition_hour_filter(op, bound, "t")).collect()}
        packed = {tuple(r) for r in df.where(F.expr(f"year*1000000+month*10000+day*100+hour {op} {key}")).collect()}
        assert got == packed


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(key=st.datetimes(datetime(2020, 1, 1), datetime(2030, 1, 1)))
def test_hour_filter_property(spark, key):
    packed = int(key.strftime("%Y%m%d%H"))
    rows = [(t.year, t.month, t.day, t.hour) for t in (key + timedelta(hours=h) for h in (-800, -25, -1, 0, 1, 25, 800))]
    df = spark.createDataFrame(rows, "year int, month int, day int, hour int")
    assert df.where(partition_hour_filter(">=", packed)).count() == 4
    assert df.where(partition_hour_filter("<=", packed)).count() == 4


def test_hour_filter_refuses_unknown_operator():
    with pytest.raises(ValueError):
        partition_hour_filter("like", 2024010100)


def test_hour_keys(spark):
    assert split_hour_key(2024022912) == [2024, 2, 29, 12]
    assert cutoff_hour_key(datetime(2024, 1, 31), 48) == 2024012900
    assert cutoff_hour_key(datetime(2024, 1, 31, 2, tzinfo=timezone(timedelta(hours=7))), 1) == 2024013018
    df = spark.sql("SELECT timestamp_ntz '2024-03-01 01:59:59' AS ts, 2024 AS year, 3 AS month, 1 AS day, 1 AS hour")
    assert df.select(hour_key_before(F.col("ts"), 2), partition_hour_key()).first() == (2024022923, 2024030101)
    assert cutoff_hour_key(None, 0) >= 2024010100


def test_risky_location(spark):
    places = ["Bangkok, TH", "LAGOS", "old new yorkshire", "Sao  Paulo", None, ""]
    df = spark.createDataFrame([(p,) for p in places], "location string")
    assert _one(df, is_risky_location(F.col("location"))) == [True, True, True, False, False, False]


RULE_CASES = [
    # amount, location, flag -> rule, reason
    ("5000.00", "Lagos, NG", False, False, "RISK_RULE_MATCH"),
    ("5000.01", "LAGOS, NG", False, True, "ELEVATED_AMOUNT_HIGH_RISK_LOCATION"),
    ("5000.01", None, False, False, "RISK_RULE_MATCH"),
    ("10000.00", "Springfield, US", False, False, "RISK_RULE_MATCH"),
    ("10000.01", "Springfield, US", False, True, "HIGH_AMOUNT"),
    ("10000.01", "new york", False, True, "HIGH_AMOUNT_HIGH_RISK_LOCATION"),
    ("1.00", None, True, True, "SIMULATOR_FLAG"),
    ("99999.00", "Bangkok", True, True, "SIMULATOR_FLAG"),
    ("1.00", None, None, None, "RISK_RULE_MATCH"),
    ("10000.01", None, None, True, "HIGH_AMOUNT"),
    (None, "Bangkok", True, True, "SIMULATOR_FLAG"),
    (None, "Bangkok", False, None, "RISK_RULE_MATCH"),
]


def test_fraud_rule_and_reason(spark):
    rows = [(a and Decimal(a), loc, flag) for a, loc, flag, _, _ in RULE_CASES]
    df = spark.createDataFrame(rows, "amount decimal(18,2), location string, is_flagged_suspicious boolean")
    got = [tuple(r) for r in df.select(fraud_rule(), alert_reason()).collect()]
    assert got == [(rule, reason) for *_, rule, reason in RULE_CASES]
