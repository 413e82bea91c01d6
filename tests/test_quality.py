from decimal import Decimal

from helpers import at, event, events
from tidemark.contract import ALERTS, LIQUIDITY, SILVER
from tidemark.operators import medallion as m
from tidemark.operators.gold import fraud_alerts, hourly_liquidity
from tidemark.operators.quality import (
    check_accepted,
    check_alert_rule,
    check_liquidity_bounds,
    check_not_null,
    check_unique,
    run_checks,
    table_checks,
)


def test_number_of_checks(spark):
    checks = table_checks()
    assert [len(checks[t.name].not_null) for t in (SILVER, LIQUIDITY, ALERTS)] == [11, 11, 12]
    assert sum(len(c.accepted) for c in checks.values()) == 3
    assert sum(c.unique is not None for c in checks.values()) == 2
    assert sum(len(c.rows) for c in checks.values()) == 2


def test_single_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), (None, 3), ("b", None)], "k string, v int")
    assert [tuple(r) for r in check_not_null(df, ["k", "v"]).sort("column_name").collect()] == [("k", 2), ("v", 2)]
    assert check_not_null(df.dropna(), ["k", "v"]).count() == 0
    assert [tuple(r) for r in check_unique(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in check_accepted(df, "k", ("b",)).collect()] == [("a", 2)]
    assert check_accepted(df, "k", ("a", "b")).count() == 0


def test_summary_counts_failing_rows(spark, salt):
    silver = m.to_silver(
        m.valid(
            m.with_event_time(
                events(
                    spark,
                    event("a", at(1), amount=Decimal("20000.00")),
                    event("a", at(61), amount=Decimal("20000.00")),
                    event("b", amount=None),
                    event("c", currency="XXX"),
                    event("d", currency="XXX", amount=Decimal("-5.00")),
                    event("e", currency="YYY"),
                )
            )
        ),
        salt,
    )
    alerts = fraud_alerts(silver)
    broken = alerts.unionByName(alerts.limit(1).selectExpr("* except (amount)", "cast(1 as decimal(18,2)) as amount"))
    summary = run_checks({SILVER.name: silver, ALERTS.name: broken, LIQUIDITY.name: hourly_liquidity(silver)})
    assert summary.count() == 41
    failures = {(r.check_name, r.table_name, r.column_name): r.failures for r in summary.where("failures > 0").collect()}
    assert failures == {
        ("not_null", SILVER.name, "amount"): 1,
        ("accepted_values", SILVER.name, "currency"): 2,
        ("accepted_values", LIQUIDITY.name, "currency"): 2,
        ("unique", ALERTS.name, "fraud_alert_key"): 1,
        ("alert_rule", ALERTS.name, ""): 1,
    }
    assert check_alert_rule(broken).count() == 1
    negative = hourly_liquidity(silver.where("transaction_id = 'd'"))
    assert check_liquidity_bounds(negative).count() == 1
