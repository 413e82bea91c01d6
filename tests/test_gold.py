from datetime import datetime
from decimal import Decimal

import pytest

from helpers import at, event, events, multiset
from tidemark.contract import ALERTS, LIQUIDITY
from tidemark.operators import medallion as m
from tidemark.operators.gold import fraud_alerts, hourly_liquidity
from tidemark.plans.gold_build import build_gold
from tidemark.sources.tables import read_table

HOUR = 3600


@pytest.fixture(scope="module")
def to_silver(spark, salt):
    def build(*rows):
        return m.to_silver(m.valid(m.with_event_time(events(spark, *rows))), salt)

    return build


def big(txn, seconds, **changes):
    return event(txn, at(seconds), amount=changes.pop("amount", Decimal("20000.00")), **changes)


def test_alerts_need_an_amount(to_silver):
    silver = to_silver(big("a", 1), event("b", is_flagged_suspicious=True, amount=None), event("c"))
    rows = fraud_alerts(silver).collect()
    assert [(r.fraud_alert_key, r.alert_reason) for r in rows] == [("a", "HIGH_AMOUNT")]


def test_one_alert_per_window(spark, to_silver, tmp_path):
    silver = to_silver(big("a", 61, amount=Decimal("30000.00")), big("a", 1), big("b", 5))
    assert fraud_alerts(silver).count() == 3
    for _ in range(2):  # a merge of the same rows leaves them all
        root = build_gold(spark, "gold_fraud_alerts", silver, str(tmp_path), as_of=AS_OF)
        assert sorted(r.transaction_id for r in _rows(spark, root, ALERTS)) == ["a", "a", "b"]


def test_liquidity_sums_and_null_flags(spark, to_silver):
    silver = to_silver(
        event("a", at(1), amount=Decimal("0.10")),
        event("b", at(2), amount=Decimal("0.20"), is_flagged_suspicious=True),
        event("c", at(3), amount=None),
        event("d", at(4), currency=None),
        event("e", at(HOUR), amount=Decimal("7.00"), is_flagged_suspicious=True),
    )
    rows = {r.hour: r for r in hourly_liquidity(silver).collect()}
    assert rows[12].hour_bucket == datetime(2026, 5, 30, 12)
    assert rows[12].hourly_liquidity_key == f"{at(0) // 1_000_000 // 3600 * 3600}|USD"
    assert (rows[12].transaction_count, rows[12].suspicious_transaction_count) == (2, 1)
    assert (rows[12].total_amount, rows[12].net_amount) == (Decimal("0.30"), Decimal("0.10"))
    assert (rows[13].total_amount, rows[13].net_amount) == (Decimal("7.00"), Decimal("0.00"))
    # Silver turns a missing flag into false, but a table may hold NULL: then the amount counts as flagged.
    unknown = silver.where("transaction_id = 'a'").selectExpr(
        "* except (is_flagged_suspicious)", "cast(null as boolean) as is_flagged_suspicious"
    )
    row = hourly_liquidity(unknown).first()
    assert (row.suspicious_transaction_count, row.net_amount) == (0, Decimal("0.00"))


def test_backfill_bounds_are_inclusive(to_silver):
    silver = to_silver(*[big(f"t{h}", h * HOUR) for h in range(-2, 3)])
    got = fraud_alerts(silver, start_key=2026053011, end_key=2026053013)
    assert sorted(r.hour for r in got.collect()) == [11, 12, 13]
    assert hourly_liquidity(silver, cutoff_key=2026053013).count() == 2


AS_OF = datetime(2026, 5, 30, 15)


def _rows(spark, root, spec):
    return read_table(spark, root, spec).collect()


def test_incremental_build_updates_inserts_and_keeps(spark, to_silver, tmp_path):
    first = to_silver(big("old", -60 * HOUR), big("same", 1), big("gone", 2))
    root = build_gold(spark, "gold_fraud_alerts", first, str(tmp_path), as_of=AS_OF)
    stamps = {r.transaction_id: r.model_updated_at for r in _rows(spark, root, ALERTS)}

    second = to_silver(big("old", -60 * HOUR, amount=Decimal("1.00")), big("same", 1, amount=Decimal("25000.00")), big("new", HOUR))
    build_gold(spark, "gold_fraud_alerts", second, str(tmp_path), as_of=AS_OF)
    rows = {r.transaction_id: r for r in _rows(spark, root, ALERTS)}
    assert set(rows) == {"old", "same", "gone", "new"}
    assert rows["same"].amount == Decimal("25000.00")
    # Outside the lookback nothing changes, and a merge never deletes.
    assert rows["old"].amount == Decimal("20000.00") and rows["old"].model_updated_at == stamps["old"]
    assert rows["gone"].model_updated_at == stamps["gone"] < rows["same"].model_updated_at


def test_rebuilding_is_idempotent(spark, to_silver, tmp_path):
    silver = to_silver(*[event(f"t{i}", at(i * 977.0)) for i in range(40)])
    root = build_gold(spark, "gold_hourly_liquidity", silver, str(tmp_path), as_of=AS_OF)
    columns = [c for c in LIQUIDITY.columns if c != "model_updated_at"]
    before = multiset(read_table(spark, root, LIQUIDITY), columns)
    build_gold(spark, "gold_hourly_liquidity", silver, str(tmp_path), as_of=AS_OF)
    assert multiset(read_table(spark, root, LIQUIDITY), columns) == before


def test_alert_that_moves_hour_stays_until_a_full_refresh(spark, to_silver, tmp_path):
    moved = to_silver(big("a", 2 * HOUR))
    root = build_gold(spark, "gold_fraud_alerts", to_silver(big("a", HOUR), big("b", 1)), str(tmp_path), as_of=AS_OF)
    build_gold(spark, "gold_fraud_alerts", moved, str(tmp_path), as_of=AS_OF)
    hours = sorted((r.transaction_id, r.hour) for r in _rows(spark, root, ALERTS))
    assert hours == [("a", 13), ("a", 14), ("b", 12)]


def test_unfinished_first_build_is_done_again(spark, to_silver, tmp_path):
    old = to_silver(big("old", -90 * HOUR), big("new", 1))
    root = build_gold(spark, "gold_fraud_alerts", old, str(tmp_path), as_of=AS_OF)
    (tmp_path / "gold/gold_fraud_alerts/_built").unlink()
    build_gold(spark, "gold_fraud_alerts", to_silver(big("old", -80 * HOUR)), str(tmp_path), as_of=AS_OF)
    assert [r.transaction_id for r in _rows(spark, root, ALERTS)] == ["old"]


def test_empty_silver_is_refused(spark, to_silver, tmp_path):
    with pytest.raises(ValueError, match="Silver has no rows"):
        build_gold(spark, "gold_fraud_alerts", to_silver(big("a", 1)).limit(0), str(tmp_path), as_of=AS_OF)


def test_full_refresh_replaces_the_table(spark, to_silver, tmp_path):
    build_gold(spark, "gold_fraud_alerts", to_silver(big("a", 1), big("b", -90 * HOUR)), str(tmp_path), as_of=AS_OF)
    root = build_gold(spark, "gold_fraud_alerts", to_silver(big("c", 1)), str(tmp_path), as_of=AS_OF, full_refresh=True)
    assert [r.transaction_id for r in _rows(spark, root, ALERTS)] == ["c"]


def test_build_may_add_a_column(spark, to_silver, tmp_path):
    from dataclasses import replace

    from pyspark.sql import functions as F

    from tidemark.plans.gold_build import MODELS

    root = build_gold(spark, "gold_hourly_liquidity", to_silver(event("a", at(1))), str(tmp_path), as_of=AS_OF)
    plain = MODELS["gold_hourly_liquidity"]

    def with_region(silver, **hours):
        return plain.rows(silver, **hours).withColumn("region", F.lit("SEA"))

    wider = replace(plain, rows=with_region)
    build_gold(spark, wider, to_silver(event("b", at(HOUR))), str(tmp_path), as_of=AS_OF)
    spec = LIQUIDITY.with_columns(with_region(to_silver(event("b"))).schema)
    assert sorted((r.hour, r.region) for r in _rows(spark, root, spec)) == [(12, None), (13, "SEA")]
    build_gold(spark, plain, to_silver(event("c", at(2))), str(tmp_path), as_of=AS_OF)
    assert sorted((r.hour, r.region) for r in _rows(spark, root, spec)) == [(12, None), (13, "SEA")]
