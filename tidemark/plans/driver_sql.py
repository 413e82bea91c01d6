"""The queries of ``driver_queries.py`` as plain SQL over the driver's tables, written independently of them."""

from __future__ import annotations

from tidemark.plans.driver_queries import (
    BACKFILL,
    COMPARED_KEY,
    DELAY_SECONDS,
    FIRST_BUILD_END,
    LATE_DIGITS,
    LATENESS_SECONDS,
    LOOKBACK_HOURS,
    SALT,
    STAGED_FILES,
)

CUTOFF = 2024012900  # 48 hours before 2024-01-31 00:00
START, END = BACKFILL["start_key"], BACKFILL["end_key"]

HOUR_OF = """
    extract(year from event_time)::INT AS year, extract(month from event_time)::INT AS month,
    extract(day from event_time)::INT AS day, extract(hour from event_time)::INT AS hour"""
HOUR_KEY = "(year * 1000000 + month * 10000 + day * 100 + hour)"
RISKY = "regexp_matches(lower(coalesce(location, '')), 'lagos|sao paulo|new york|bangkok')"
RULE = f"(is_flagged_suspicious OR amount > 10000.00 OR (amount > 5000.00 AND {RISKY}))"

RAW = """
copies AS (
    SELECT event_id e, user_id u, epoch_us(ts) us, event_type, value FROM events
    UNION ALL
    SELECT event_id, user_id, epoch_us(ts), event_type, value FROM events WHERE event_id % 10 = 4
    UNION ALL
    SELECT event_id, user_id, epoch_us(ts), event_type, value + 0.01::DOUBLE FROM events WHERE event_id % 100 = 5
    UNION ALL
    SELECT event_id, user_id, epoch_us(ts) + 120000000, event_type, value FROM events WHERE event_id % 100 = 6
),
raw AS (
    SELECT
        CASE WHEN e % 50 <> 3 THEN 'txn_' || e END AS transaction_id,
        CASE WHEN e % 50 <> 17 THEN 'acct_' || u END AS account_id,
        CASE WHEN e % 50 <> 19 THEN round(value * 100)::DECIMAL(18,2) END AS amount,
        CASE WHEN e % 50 <> 21 THEN
            CASE u % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'THB' WHEN 2 THEN 'EUR' WHEN 3 THEN 'SGD' ELSE 'JPY' END
        END AS currency,
        CASE e % 50 WHEN 0 THEN NULL WHEN 1 THEN us // 1000 WHEN 2 THEN us * 10 ELSE us END::BIGINT
            AS event_time_epoch_us,
        CASE WHEN e % 50 <> 18 THEN 'dev_' || (u % 97) END AS device_id,
        CASE WHEN e % 50 <> 20 THEN
            CASE u % 8 WHEN 0 THEN 'Bangkok, TH' WHEN 1 THEN 'New York, US' WHEN 2 THEN 'Lagos, NG'
                WHEN 3 THEN 'Sao Paulo, BR' ELSE 'Springfield, US' END
        END AS location,
        CASE WHEN e % 50 <> 22 THEN event_type = 'error' AND e % 4 = 0 END AS is_flagged_suspicious
    FROM copies
),
timed AS (
    SELECT *, CASE WHEN event_time_epoch_us BETWEEN 1000000000000000 AND 9999999999999999
        THEN make_timestamp(event_time_epoch_us // 1000 * 1000) END AS event_time
    FROM raw
),
valid AS (
    SELECT * FROM timed
    WHERE transaction_id IS NOT NULL AND event_time_epoch_us IS NOT NULL AND event_time IS NOT NULL
),
rejected AS (
    SELECT *, CASE WHEN transaction_id IS NULL THEN 'MISSING_TRANSACTION_ID'
        WHEN event_time_epoch_us IS NULL THEN 'MISSING_EVENT_TIME_EPOCH_US'
        ELSE 'INVALID_EVENT_TIME' END AS reject_reason
    FROM timed
    WHERE transaction_id IS NULL OR event_time_epoch_us IS NULL OR event_time IS NULL
)"""


def _silver(minutes: int = 1) -> str:
    return f"""
grouped AS (
    SELECT transaction_id, time_bucket(INTERVAL '{minutes} minutes', event_time) AS dedup_window_start,
        min(account_id) AS account_id, min(device_id) AS device_id, min(amount) AS amount,
        min(currency) AS currency, min(event_time) AS event_time,
        min(event_time_epoch_us) AS event_time_epoch_us, min(location) AS location,
        max(CASE WHEN is_flagged_suspicious THEN 1 ELSE 0 END) = 1 AS is_flagged_suspicious
    FROM valid GROUP BY ALL
),
silver AS (
    SELECT transaction_id,
        'ACC-SHA256-' || substr(sha256('{SALT}:' || coalesce(account_id, '')), 1, 32) AS account_id,
        amount, currency, event_time_epoch_us,
        'DEV-SHA256-' || substr(sha256('{SALT}:' || coalesce(device_id, '')), 1, 32) AS device_id,
        location, is_flagged_suspicious, event_time, dedup_window_start,
        dedup_window_start + INTERVAL '{minutes} minutes' AS dedup_window_end, {HOUR_OF}
    FROM grouped
)"""


BASE = f"WITH {RAW},{_silver()}"

# Which file an event arrives in, and the watermark's rule: after each file it stands at the latest event time so far,
# less the lateness, and an event whose window had ended by then is late in the next file.
STAGED = f"""
arrivals AS (
    SELECT *, event_time_epoch_us + CASE WHEN right(transaction_id, 1)::INT IN {LATE_DIGITS}
        THEN {DELAY_SECONDS * 1_000_000} ELSE 0 END AS arrival,
        time_bucket(INTERVAL '1 minute', event_time) AS dedup_window_start
    FROM valid
),
span AS (SELECT min(arrival) AS first_us, max(arrival) AS last_us FROM arrivals),
arrived AS (
    SELECT transaction_id, event_time, dedup_window_start, dedup_window_start + INTERVAL '1 minute' AS window_end,
        (arrival - first_us) * {STAGED_FILES} // (last_us - first_us + 1) AS file
    FROM arrivals, span
),
marks AS (
    SELECT file, max(max(event_time)) OVER (ORDER BY file) - INTERVAL '{LATENESS_SECONDS} seconds' AS watermark
    FROM arrived GROUP BY file
),
taken AS (
    SELECT DISTINCT transaction_id, dedup_window_start, window_end
    FROM arrived ASOF LEFT JOIN marks ON arrived.file > marks.file
    WHERE marks.watermark IS NULL OR window_end > marks.watermark
),
finally AS (SELECT max(watermark) AS watermark FROM marks)"""


def _alerts(source: str = "silver", where: str = "TRUE") -> str:
    return f"""
    SELECT transaction_id AS fraud_alert_key, transaction_id, account_id, device_id, amount, currency,
        location, is_flagged_suspicious,
        CASE WHEN is_flagged_suspicious THEN 'SIMULATOR_FLAG'
            WHEN amount > 10000.00 AND {RISKY} THEN 'HIGH_AMOUNT_HIGH_RISK_LOCATION'
            WHEN amount > 10000.00 THEN 'HIGH_AMOUNT'
            WHEN amount > 5000.00 AND {RISKY} THEN 'ELEVATED_AMOUNT_HIGH_RISK_LOCATION'
            ELSE 'RISK_RULE_MATCH' END AS alert_reason,
        event_time, event_time_epoch_us, year, month, day, hour
    FROM {source}
    WHERE transaction_id IS NOT NULL AND event_time IS NOT NULL AND event_time_epoch_us IS NOT NULL
        AND amount IS NOT NULL AND {RULE} AND {where}"""


def _liquidity(source: str = "silver", where: str = "TRUE") -> str:
    return f"""
    SELECT epoch(date_trunc('hour', event_time))::BIGINT || '|' || currency AS hourly_liquidity_key,
        date_trunc('hour', event_time)::TIMESTAMP AS hour_bucket, currency,
        count(*) AS transaction_count,
        (count(*) FILTER (WHERE is_flagged_suspicious))::BIGINT AS suspicious_transaction_count,
        sum(amount)::DECIMAL(38,2) AS total_amount,
        sum(CASE WHEN NOT is_flagged_suspicious THEN amount ELSE 0.00 END)::DECIMAL(38,2) AS net_amount,
        year, month, day, hour
    FROM {source}
    WHERE event_time IS NOT NULL AND currency IS NOT NULL AND amount IS NOT NULL AND {where}
    GROUP BY date_trunc('hour', event_time), currency, year, month, day, hour"""


STALE = f"event_time_epoch_us % 2 = 0 AND {HOUR_KEY} <= {FIRST_BUILD_END}"
RECENT = f"{HOUR_KEY} >= {CUTOFF}"


def _merged(target: str, updates: str, keys: tuple[str, ...], new_column: str | None = None) -> str:
    """Upsert: matched target rows take their update, further updates are inserted, the rest stays."""
    padding = f", NULL::DECIMAL(18,2) AS {new_column}" if new_column else ""
    same = " AND ".join(f"t.{k} = u.{k}" for k in keys)
    return f"""
    , target AS ({target}), updates AS ({updates}), inside AS (SELECT * FROM target WHERE {RECENT})
    SELECT *{padding} FROM target WHERE NOT {RECENT}
    UNION ALL
    SELECT t.*{padding} FROM inside AS t WHERE NOT EXISTS (SELECT 1 FROM updates AS u WHERE {same})
    UNION ALL
    SELECT u.* FROM inside AS t JOIN updates AS u ON {same}
    UNION ALL
    SELECT u.* FROM updates AS u WHERE NOT EXISTS (SELECT 1 FROM inside AS t WHERE {same})"""


def _with_mean(liquidity: str, mean: str = "round(total_amount / transaction_count, 2)") -> str:
    return f"SELECT *, {mean}::DECIMAL(18,2) AS mean_amount FROM ({liquidity})"


def _not_null(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {table}"
        for c in columns
    )


def _dq_summary() -> str:
    hours = ["year", "month", "day", "hour"]
    money = ["total_amount", "net_amount"]
    not_null = {
        "silver.transactions": (
            "silver",
            ["transaction_id", "event_time", "event_time_epoch_us", "amount", "currency", "account_id", "device_id"],
        ),
        "gold.gold_hourly_liquidity": (
            "liquidity",
            ["hourly_liquidity_key", "hour_bucket", "currency", "transaction_count", "suspicious_transaction_count"]
            + money,
        ),
        "gold.gold_fraud_alerts": (
            "alerts",
            ["fraud_alert_key", "transaction_id", "account_id", "device_id", "alert_reason", "amount", "event_time",
             "event_time_epoch_us"],
        ),
    }
    parts = [
        f"SELECT 'not_null' AS check_name, '{name}' AS table_name, column_name, failures "
        f"FROM ({_not_null(table, columns + hours)})"
        for name, (table, columns) in not_null.items()
    ]
    currencies = "('USD', 'THB', 'EUR', 'SGD', 'JPY')"
    reasons = (
        "('SIMULATOR_FLAG', 'HIGH_AMOUNT_HIGH_RISK_LOCATION', 'HIGH_AMOUNT', "
        "'ELEVATED_AMOUNT_HIGH_RISK_LOCATION', 'RISK_RULE_MATCH')"
    )
    for name, table, column, accepted in (
        ("silver.transactions", "silver", "currency", currencies),
        ("gold.gold_hourly_liquidity", "liquidity", "currency", currencies),
        ("gold.gold_fraud_alerts", "alerts", "alert_reason", reasons),
    ):
        parts.append(
            f"SELECT 'accepted_values', '{name}', '{column}', count(DISTINCT {column}) FROM {table} "
            f"WHERE {column} NOT IN {accepted}"
        )
    for name, table, key in (
        ("gold.gold_hourly_liquidity", "liquidity", "hourly_liquidity_key"),
        ("gold.gold_fraud_alerts", "alerts", "fraud_alert_key"),
    ):
        parts.append(
            f"SELECT 'unique', '{name}', '{key}', count(*) FROM "
            f"(SELECT {key} FROM {table} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"
        )
    parts.append(
        "SELECT 'liquidity_bounds', 'gold.gold_hourly_liquidity', '', count(*) FROM liquidity "
        f"WHERE {BOUNDS}"
    )
    parts.append(f"SELECT 'alert_rule', 'gold.gold_fraud_alerts', '', count(*) FROM alerts WHERE NOT {RULE}")
    return f"{BASE}, alerts AS ({_alerts()}), liquidity AS ({_liquidity()}) " + " UNION ALL ".join(parts)


BOUNDS = (
    "transaction_count <= 0 OR suspicious_transaction_count < 0 OR total_amount < 0.00 OR net_amount < 0.00"
)
CLOSED = f"dedup_window_end <= (SELECT max(event_time) FROM valid) - INTERVAL '{LATENESS_SECONDS} seconds'"
BRONZE = f"SELECT *, {HOUR_OF} FROM valid"
CONTRACT_COLUMNS = [
    "transaction_id", "account_id", "amount", "currency", "event_time_epoch_us", "device_id", "location",
    "is_flagged_suspicious",
]


def _counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM ({sql})" for name, sql in tables.items()
    )


SQL: dict[str, str] = {
    "contract_conformed": f"""WITH {RAW}
        SELECT transaction_id, account_id, amount, currency, event_time_epoch_us, device_id,
            NULL::VARCHAR AS location, FALSE AS is_flagged_suspicious, 'v1' AS producer_version
        FROM raw""",
    "epoch_and_money": """
        SELECT event_id, epoch_us(ts) AS epoch_us, round(value, 2)::DECIMAL(18,2) AS amount FROM events""",
    "transactions_event_time": f"WITH {RAW} SELECT * FROM timed",
    "bronze_valid": f"WITH {RAW} {BRONZE}",
    "bronze_rejected": f"WITH {RAW} SELECT * FROM rejected",
    "rejected_by_reason": f"WITH {RAW} SELECT reject_reason, count(*) AS n FROM rejected GROUP BY reject_reason",
    "silver_dedup_masked": f"{BASE} SELECT * FROM silver",
    "silver_five_minute_windows": f"WITH {RAW},{_silver(5)} SELECT * FROM silver",
    "silver_sample": f"""{BASE} SELECT transaction_id, dedup_window_start, account_id, device_id FROM silver
        ORDER BY transaction_id, dedup_window_start LIMIT 5""",
    "gold_fraud_alerts": BASE + _alerts(),
    "gold_hourly_liquidity": BASE + _liquidity(),
    "gold_alerts_backfill": BASE + _alerts(where=f"{HOUR_KEY} BETWEEN {START} AND {END}"),
    "gold_liquidity_backfill": BASE + _liquidity(where=f"{HOUR_KEY} BETWEEN {START} AND {END}"),
    "gold_alerts_lookback": BASE + _alerts(where=RECENT),
    "gold_liquidity_lookback": BASE + _liquidity(where=RECENT),
    "gold_alerts_incremental": BASE
    + _merged(_alerts(where=STALE), _alerts(where=RECENT), ("transaction_id", "event_time_epoch_us")),
    "gold_alerts_rebuild": BASE + _alerts(),
    "gold_liquidity_incremental": BASE
    + _merged(_liquidity(where=STALE), _liquidity(where=RECENT), ("hourly_liquidity_key",)),
    "gold_added_column_kept": BASE
    + _merged(
        _with_mean(_liquidity(where=f"{HOUR_KEY} <= {FIRST_BUILD_END}")),
        _with_mean(_liquidity(where=RECENT), "NULL"),
        ("hourly_liquidity_key",),
    ),
    "merge_new_column": BASE
    + _merged(
        _liquidity(where=STALE), _with_mean(_liquidity(where=RECENT)), ("hourly_liquidity_key",), "mean_amount"
    ),
    "partition_hour_keys": f"""{BASE}, keyed AS (
            SELECT transaction_id, event_time, {HOUR_KEY}::INT AS hour_key,
                event_time - INTERVAL '{LOOKBACK_HOURS} hours' AS cutoff
            FROM silver)
        SELECT transaction_id, event_time, hour_key, strftime(cutoff, '%Y%m%d%H')::INT AS cutoff_key,
            year(cutoff)::INT AS cutoff_year, month(cutoff)::INT AS cutoff_month,
            day(cutoff)::INT AS cutoff_day, hour(cutoff)::INT AS cutoff_hour
        FROM keyed""",
    "partition_hour_comparisons": f"{BASE} SELECT "
    + ", ".join(
        f"count(*) FILTER (WHERE {HOUR_KEY} {op} {COMPARED_KEY}) AS n_{name}"
        for name, op in (("ge", ">="), ("le", "<="), ("gt", ">"), ("lt", "<"), ("eq", "="), ("ne", "<>"))
    )
    + " FROM silver",
    "table_counts": BASE
    + _counts(
        {
            "bronze.transactions": "FROM valid",
            "bronze.transactions_rejected": "FROM rejected",
            "silver.transactions": "FROM silver",
            "gold.gold_fraud_alerts": _alerts(),
            "gold.gold_hourly_liquidity": _liquidity(),
        }
    ),
    "dq_summary": _dq_summary(),
    "dq_not_null": f"{BASE} SELECT * FROM ("
    + _not_null(
        "silver",
        ["transaction_id", "event_time", "event_time_epoch_us", "amount", "currency", "account_id", "device_id",
         "year", "month", "day", "hour"],
    )
    + ") WHERE failures > 0",
    "dq_not_null_raw": f"WITH {RAW} SELECT * FROM ({_not_null('raw', CONTRACT_COLUMNS)}) WHERE failures > 0",
    "dq_duplicate_alert_keys": f"""{BASE}, alerts AS ({_alerts()})
        SELECT fraud_alert_key, count(*) AS n_records FROM alerts GROUP BY fraud_alert_key HAVING count(*) > 1""",
    "dq_unaccepted_currencies": f"""{BASE}
        SELECT currency, count(*) AS n_records FROM silver WHERE currency NOT IN ('USD', 'EUR', 'JPY')
        GROUP BY currency""",
    "dq_liquidity_bounds": f"{BASE}, liquidity AS ({_liquidity()}) SELECT * FROM liquidity WHERE {BOUNDS}",
    "dq_alert_rule": f"{BASE}, alerts AS ({_alerts()}) SELECT * FROM alerts WHERE NOT {RULE}",
    "dq_silver_outside_alert_rule": f"""{BASE}
        SELECT transaction_id, event_time, amount, location FROM silver WHERE NOT {RULE}""",
    "stream_silver": f"{BASE} SELECT * FROM silver WHERE {CLOSED}",
    "stream_bronze": f"WITH {RAW} {BRONZE}",
    "stream_rejected": f"WITH {RAW} SELECT * FROM rejected",
    "stream_medallion_counts": BASE
    + _counts(
        {
            "bronze.transactions": "FROM valid",
            "bronze.transactions_rejected": "FROM rejected",
            "silver.transactions": f"FROM silver WHERE {CLOSED}",
        }
    ),
    "stream_to_gold_liquidity": BASE + _liquidity(where=CLOSED),
    "stream_late_rows": f"""WITH {RAW},{STAGED}
        SELECT transaction_id, dedup_window_start, event_time FROM arrived
        WHERE (transaction_id, dedup_window_start) NOT IN (
            SELECT (transaction_id, dedup_window_start) FROM taken, finally WHERE window_end <= watermark)""",
    "stream_restarted_silver": f"{BASE} SELECT * FROM silver WHERE {CLOSED}",
    "stream_open_windows": f"""WITH {RAW},{STAGED}
        SELECT transaction_id, dedup_window_start FROM taken, finally WHERE window_end > watermark""",
    "compact_files_per_hour": f"""{BASE}
        SELECT DISTINCT {HOUR_KEY} AS hour_key, 1::BIGINT AS files FROM silver WHERE {HOUR_KEY} <= {FIRST_BUILD_END}""",
    "layered_silver": f"{BASE} SELECT * FROM silver",
    "written_order_violations": f"""{BASE}, told AS (
            SELECT (event_time, transaction_id) AS own,
                lag((event_time, transaction_id)) OVER (ORDER BY transaction_id, event_time) AS earlier FROM silver)
        SELECT 'as_written' AS layout, 0::BIGINT AS violations
        UNION ALL SELECT 'by_id', count(*) FROM told WHERE earlier > own""",
    "catalog_row_counts": BASE
    + _counts(
        {
            "silver.transactions": "FROM silver",
            "bronze.transactions_rejected": "FROM rejected",
            "gold.gold_hourly_liquidity": _liquidity(),
        }
    ),
    "compact_silver": f"{BASE} SELECT * FROM silver WHERE {HOUR_KEY} <= {FIRST_BUILD_END}",
    "compact_gold": BASE + _liquidity(),
}
