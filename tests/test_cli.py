"""A whole run from the command line: stream, Gold, checks, compaction."""

from helpers import at, event, events, multiset
from tidemark.__main__ import main
from tidemark.contract import LIQUIDITY, SILVER
from tidemark.sources.folders import Folders
from tidemark.sources.layers import compacted_root, read_layered
from tidemark.sources.tables import read_table, table_root


def test_pipeline(spark, salt, tmp_path, monkeypatch, capsys):
    lake = str(tmp_path / "lake")
    monkeypatch.setenv("PII_HASH_SALT", salt)
    monkeypatch.setenv("WAREHOUSE_DIR", lake)
    incoming = str(tmp_path / "in")
    rows = [event(f"t{i}", at(i * 600)) for i in range(12)] + [event(None)]
    events(spark, *rows).coalesce(1).write.parquet(incoming)

    assert main(["stream", "--path", incoming, "--available-now"], spark) == 0
    events(spark, event("z", at(7200))).coalesce(1).write.mode("append").parquet(incoming)
    assert main(["stream", "--path", incoming, "--available-now"], spark) == 0
    live = table_root(lake, SILVER)
    assert read_table(spark, live, SILVER).count() == 12

    assert main(["gold"], spark) == 0
    assert main(["gold", "--model", "gold_hourly_liquidity", "--full-refresh", "--end-key", "2026053013"], spark) == 0
    liquidity = read_table(spark, table_root(lake, LIQUIDITY), LIQUIDITY)
    assert sorted((r.hour, r.transaction_count) for r in liquidity.collect()) == [(12, 3), (13, 6)]

    assert main(["check"], spark) == 0
    assert main(["counts"], spark) == 0
    assert "gold.gold_hourly_liquidity" in capsys.readouterr().out

    tables = "lake.silver.transactions, lake.gold.gold_hourly_liquidity"
    assert main(["compact", "--tables", tables, "--end-key", "2026053012"], spark) == 0
    assert read_table(spark, compacted_root(lake, SILVER), SILVER).count() == 3
    rows = multiset(read_table(spark, live, SILVER))
    assert multiset(read_layered(spark, lake, SILVER)) == rows

    # Gold, checks and counts read the compacted layer: the closed hours need not be live any more.
    main(["gold", "--full-refresh"], spark)
    before = multiset(read_table(spark, table_root(lake, LIQUIDITY), LIQUIDITY).drop("model_updated_at"))
    capsys.readouterr()
    main(["counts"], spark)
    counts = capsys.readouterr().out
    assert main(["compact", "--tables", tables.split(",")[0], "--expire"], spark) == 0
    assert "loads expired" in capsys.readouterr().out
    assert Folders(spark, live).hours(end_key=2026053013, whole=True) != []
    assert read_table(spark, live, SILVER).count() < len(rows)
    assert multiset(read_layered(spark, lake, SILVER)) == rows
    main(["gold", "--full-refresh"], spark)
    assert multiset(read_table(spark, table_root(lake, LIQUIDITY), LIQUIDITY).drop("model_updated_at")) == before
    assert main(["check"], spark) == 0
    capsys.readouterr()
    main(["counts"], spark)
    assert capsys.readouterr().out == counts
    assert main(["init"], spark) == 0
    try:
        assert spark.table("silver.transactions").count() == read_table(spark, live, SILVER).count()
    finally:
        for namespace in ("bronze", "silver", "gold"):
            spark.sql(f"DROP DATABASE IF EXISTS {namespace} CASCADE")


def test_check_reports_failures(spark, salt, tmp_path, monkeypatch, capsys):
    lake = str(tmp_path / "lake")
    monkeypatch.setenv("PII_HASH_SALT", salt)
    monkeypatch.setenv("WAREHOUSE_DIR", lake)
    incoming = str(tmp_path / "in")
    events(spark, event("a", at(1), currency="XXX"), event("z", at(100))).coalesce(1).write.parquet(incoming)
    main(["stream", "--path", incoming, "--available-now"], spark)
    main(["gold"], spark)
    assert main(["check"], spark) == 1
    assert "accepted_values" in capsys.readouterr().out
