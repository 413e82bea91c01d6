import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import at, event, events, multiset
from tidemark.contract import BRONZE, LIQUIDITY, REJECTED, SILVER, TABLES
from tidemark.operators import medallion as m
from tidemark.operators.compact import compact_partitions
from tidemark.operators.gold import hourly_liquidity, in_hours
from tidemark.operators.layout import FILE, PLACE, order_violations, read_places
from tidemark.plans.medallion_batch import build_bronze, build_silver
from tidemark.sources.tables import (
    add_partitions,
    complete_loads,
    create_tables,
    read_hours,
    read_table,
    table_root,
    write_load,
    write_silver,
    write_table,
)
from tidemark.sources.folders import Folders
from tidemark.sources.layers import table_counts
from tidemark.sources.transactions import avro_contract, load_transactions, read_transactions, registry_payload

HOUR = 3600


def files(root):
    return sorted(glob.glob(f"{root}/**/*.parquet", recursive=True))


@pytest.fixture()
def raw(spark):
    return events(spark, *[event(f"t{i}", at(i * 900.5)) for i in range(12)], event(None))


def test_batch_build_layout(spark, raw, salt, tmp_path):
    warehouse = str(tmp_path)
    root = build_silver(raw, warehouse, salt)
    build_bronze(raw, warehouse)
    assert root == table_root(warehouse, SILVER)
    assert f"{root}/year=2026/month=5/day=30/hour=12" in files(root)[0]
    meta = pq.ParquetFile(files(root)[0])
    assert meta.metadata.row_group(0).column(0).compression == "ZSTD"
    counts = dict(
        tuple(r) for r in table_counts(spark, warehouse, [BRONZE.name, REJECTED.name, SILVER.name]).collect()
    )
    assert counts == {BRONZE.name: 12, REJECTED.name: 1, SILVER.name: 12}


def test_files_are_sorted(spark, salt, tmp_path):
    rows = [event(f"t{i:02d}", at((i * 37) % 60)) for i in range(60)]
    root = build_silver(events(spark, *rows).repartition(3), str(tmp_path), salt)
    for name in files(root):
        table = pq.read_table(name, columns=["event_time", "transaction_id"], partitioning=None).to_pydict()
        pairs = list(zip(table["event_time"], table["transaction_id"]))
        assert pairs == sorted(pairs)


def test_load_is_replaced_on_replay(spark, raw, salt, tmp_path):
    root = str(tmp_path / "silver")
    silver = m.to_silver(m.valid(m.with_event_time(raw)), salt)
    for load_id in ("q-0", "q-1", "q-1"):
        write_silver(silver, root, load_id)
    table = read_table(spark, root, SILVER)
    assert table.columns == SILVER.columns and table.count() == 24


def test_hours_are_read_from_their_own_folders(spark, salt, tmp_path):
    root = str(tmp_path / "silver")
    _fragmented(spark, root, salt, hours=30)
    for bounds in ({"start_key": 2026053022}, {"start_key": 2026053013, "end_key": 2026053014}, {"end_key": 2026053012}):
        rows = read_hours(spark, root, SILVER, **bounds)
        wanted = in_hours(read_table(spark, root, SILVER), **bounds)
        assert multiset(rows) == multiset(wanted) != []
        opened = rows.inputFiles()
        # Three loads of each hour, and no file of any other hour is even listed.
        assert len(opened) == 3 * wanted.select("day", "hour").distinct().count()
    assert read_hours(spark, root, SILVER, 2026060100).count() == 0
    assert Folders(spark, root).hours(2026050100, 2026053123) == ["year=2026/month=5"]


def test_loads_have_names_with_numbers(spark, raw, salt, tmp_path):
    silver = m.to_silver(m.valid(m.with_event_time(raw)), salt)
    with pytest.raises(ValueError, match="name of a load"):
        write_silver(silver, str(tmp_path), "batch")
    write_silver(silver, str(tmp_path), "some-query-7")
    assert complete_loads(spark, str(tmp_path)) == {"some-query": 7}


def test_hot_hour_is_split_over_files(spark, tmp_path):
    rows = spark.range(0, 40000, 1, 8).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in SILVER.schema if f.name not in ("transaction_id", "year", "month", "day", "hour")],
        F.sha2(F.col("id").cast("string"), 256).alias("transaction_id"),
        F.lit(2026).alias("year"), F.lit(5).alias("month"), F.lit(30).alias("day"),
        F.when(F.col("id") % 3 == 0, 12).otherwise(F.col("id") % 24).cast("int").alias("hour"),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        write_table(rows, str(tmp_path), SILVER)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    per_hour = {h: len(files(f"{tmp_path}/year=2026/month=5/day=30/hour={h}")) for h in range(24)}
    assert per_hour[12] > 2
    assert read_table(spark, str(tmp_path), SILVER).count() == 40000


def test_catalog_tables(spark, raw, salt, tmp_path):
    warehouse = str(tmp_path)
    build_silver(raw, f"{warehouse}/elsewhere", salt)
    silver = m.to_silver(m.valid(m.with_event_time(raw)), salt)
    write_load(silver, table_root(warehouse, SILVER), SILVER, "q-0")
    write_table(hourly_liquidity(silver), table_root(warehouse, LIQUIDITY), LIQUIDITY)
    create_tables(spark, warehouse)
    create_tables(spark, warehouse)
    try:
        assert add_partitions(spark, warehouse) == 4 + 4
        assert spark.sql("SELECT count(*) FROM silver.transactions").first()[0] == 12
        # A later load: only the partitions of its hours are looked for, and only new ones added.
        write_load(silver, table_root(warehouse, SILVER), SILVER, "q-1")
        assert add_partitions(spark, warehouse, 2026053013, 2026053013) == 1
        assert add_partitions(spark, warehouse) == 3
        assert add_partitions(spark, warehouse) == 0
        assert spark.sql("SELECT count(*) FROM silver.transactions WHERE load = 'q-1'").first()[0] == 12
        assert spark.sql("SELECT sum(transaction_count) FROM gold.gold_hourly_liquidity").first()[0] == 12
        assert spark.sql("SELECT account_id, device_id FROM silver.transactions LIMIT 5").count() == 5
        assert spark.table("bronze.transactions_rejected").count() == 0
        for name, spec in TABLES.items():
            assert set(spark.table(name).columns) - {"load"} == set(spec.columns)
    finally:
        for namespace in ("bronze", "silver", "gold"):
            spark.sql(f"DROP DATABASE IF EXISTS {namespace} CASCADE")


def test_order_in_files(spark, salt, tmp_path):
    rows = m.to_silver(m.valid(m.with_event_time(events(spark, *[event(f"t{i % 7}", at(i * 61 % 3000)) for i in range(300)]))), salt)
    write_table(rows, f"{tmp_path}/sorted", SILVER)
    assert order_violations(read_places(spark, f"{tmp_path}/sorted", SILVER), SILVER).count() == 0
    by_time = rows.select("event_time", "transaction_id").sort(F.desc("event_time"), "transaction_id")
    by_time.coalesce(1).write.parquet(f"{tmp_path}/backwards")
    places = read_places(spark, f"{tmp_path}/backwards", SILVER)
    listed = [tuple(r) for r in places.sort("_place").select("event_time", "transaction_id").collect()]
    assert order_violations(places, SILVER).count() == sum(a > b for a, b in zip(listed, listed[1:])) > 0


def test_sources(spark, raw, tmp_path):
    raw.write.parquet(str(tmp_path / "full"))
    assert multiset(read_transactions(spark, str(tmp_path / "full"))) == multiset(raw)
    raw.drop("is_flagged_suspicious").write.parquet(str(tmp_path / "old"))
    old = load_transactions(spark, str(tmp_path / "old"))
    assert old.columns == raw.columns and old.where("is_flagged_suspicious").count() == 0


def test_avro_contract_and_wire_header(spark):
    import json

    fields = {f["name"]: f for f in json.loads(avro_contract())["fields"]}
    assert fields["amount"]["type"] == {"type": "bytes", "logicalType": "decimal", "precision": 18, "scale": 2}
    assert fields["event_time_epoch_us"]["type"] == "long" and "default" not in fields["event_time_epoch_us"]
    assert fields["is_flagged_suspicious"]["default"] is False
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x07payload"),)], "value binary")
    assert bytes(df.select(registry_payload(F.col("value"))).first()[0]) == b"payload"


def _fragmented(spark, root, salt, hours=3):
    for load in range(3):
        rows = [event(f"t{load}-{h}-{i}", at(h * HOUR + i)) for h in range(hours) for i in range(4)]
        write_silver(m.to_silver(m.valid(m.with_event_time(events(spark, *rows))), salt), root, f"q-{load}")


def test_compaction_into_another_root(spark, salt, tmp_path):
    src, dst = f"{tmp_path}/src", f"{tmp_path}/dst"
    _fragmented(spark, src, salt)
    report = compact_partitions(spark, src, dst, SILVER, end_key=2026053013)
    assert (report.rewritten_hours, report.kept_hours) == (2, 0)
    assert report.files_planned == len(files(dst)) == 2 < report.files_before
    closed = read_table(spark, src, SILVER).where("hour <= 13")
    assert multiset(read_table(spark, dst, SILVER)) == multiset(closed)
    # The hour that was open is added by the next run; the earlier hours stay as they are.
    before = files(dst)
    compact_partitions(spark, src, dst, SILVER, start_key=2026053014)
    assert set(before) < set(files(dst))
    assert multiset(read_table(spark, dst, SILVER)) == multiset(read_table(spark, src, SILVER))
    # A repeated run replaces hours rather than adding to them, and compact input is only copied.
    compact_partitions(spark, src, dst, SILVER)
    report = compact_partitions(spark, dst, f"{tmp_path}/copy", SILVER)
    assert (report.rewritten_hours, report.kept_hours) == (0, 3)
    assert multiset(read_table(spark, f"{tmp_path}/copy", SILVER)) == multiset(read_table(spark, src, SILVER))


def test_compaction_in_place(spark, salt, tmp_path):
    silver = m.to_silver(
        m.valid(m.with_event_time(events(spark, *[event(f"t{i}", at(i * 60), currency=c) for i, c in enumerate(["USD", "THB", "EUR"] * 2)]))),
        salt,
    )
    root = f"{tmp_path}/gold"
    hourly_liquidity(silver).repartition(3).write.partitionBy(*LIQUIDITY.partition_by).parquet(root)
    rows = multiset(read_table(spark, root, LIQUIDITY))
    before = len(files(root))
    report = compact_partitions(spark, root, root, LIQUIDITY)
    assert before > 1 and report.rewritten_hours == 1 and len(files(root)) == 1
    assert multiset(read_table(spark, root, LIQUIDITY)) == rows
    assert compact_partitions(spark, root, root, LIQUIDITY).rewritten_hours == 0


def test_compaction_splits_a_large_hour_and_settles(spark, salt, tmp_path):
    src, dst = f"{tmp_path}/src", f"{tmp_path}/dst"
    one = m.to_silver(m.valid(m.with_event_time(events(spark, event("t")))), salt)
    ids = spark.range(0, 20000, 1, 12).select(F.sha2(F.col("id").cast("string"), 256).alias("transaction_id"))
    ids.crossJoin(one.drop("transaction_id")).repartition(12).write.partitionBy(*SILVER.partition_by).parquet(src)
    report = compact_partitions(spark, src, dst, SILVER, threshold="100KB", target="200KB")
    assert report.rewritten_hours == 1 and 1 < report.files_planned < report.files_before
    assert len(files(dst)) == report.files_planned
    assert multiset(read_table(spark, dst, SILVER)) == multiset(read_table(spark, src, SILVER))
    again = compact_partitions(spark, dst, f"{tmp_path}/again", SILVER, threshold="100KB", target="200KB")
    assert again.rewritten_hours == 0


def test_compaction_refuses_live_and_unpartitioned_tables(spark, tmp_path):
    with pytest.raises(ValueError, match="stream"):
        compact_partitions(spark, str(tmp_path), str(tmp_path), SILVER)
    with pytest.raises(ValueError, match="partitioned"):
        compact_partitions(spark, str(tmp_path), f"{tmp_path}/dst", REJECTED)


def test_order_in_files_without_a_window_per_file(spark, tmp_path):
    # Two files of rows in a shuffled order: each row is compared with the one before it in its own file,
    # by a join rather than a window that holds a whole file in one task.
    for number in range(2):
        rows = [(at((i * 37 + number) % 500), f"t{(i * 13) % 11}") for i in range(400)]
        listed = spark.createDataFrame(rows, "us long, transaction_id string")
        listed = listed.select(F.timestamp_micros("us").alias("event_time"), "transaction_id")
        listed.coalesce(1).write.mode("append").parquet(f"{tmp_path}/shuffled")
    places = read_places(spark, f"{tmp_path}/shuffled", SILVER)
    expected = 0
    for (file,) in places.select(FILE).distinct().collect():
        listed = [tuple(r) for r in places.where(F.col(FILE) == file).sort(PLACE).select("event_time", "transaction_id").collect()]
        expected += sum(a > b for a, b in zip(listed, listed[1:]))
    found = order_violations(places, SILVER)
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == expected > 0
