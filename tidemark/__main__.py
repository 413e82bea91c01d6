"""Command line of the pipeline: ``python -m tidemark <command>``; parameters come from the environment."""

from __future__ import annotations

import argparse
import logging
import os

from pyspark.sql import DataFrame, SparkSession

from tidemark.config import PipelineConfig, table_for
from tidemark.contract import ALERTS, LIQUIDITY, SILVER
from tidemark.operators.compact import FULL_FILE, SMALL_FILE, compact_tables
from tidemark.operators.quality import run_checks
from tidemark.plans.gold_build import LOOKBACK_HOURS, MODELS, build_gold
from tidemark.session import with_settings
from tidemark.sources.journal import recover
from tidemark.sources.layers import expire_compacted, read_layered, table_counts
from tidemark.sources.tables import add_partitions, create_tables, read_table, table_root
from tidemark.sources.transactions import read_transactions_kafka, read_transactions_stream
from tidemark.streaming.medallion import start_medallion

DEFAULT_TABLES = "lake.silver.transactions"


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tidemark")
    commands = root.add_subparsers(dest="command", required=True)
    init = commands.add_parser("init", help="register the tables, and their new partitions, in the catalog")
    init.add_argument("--start-key", type=int, help="look for new partitions from this hour on")
    init.add_argument("--end-key", type=int)
    stream = commands.add_parser("stream", help="run the Bronze and Silver streams")
    stream.add_argument("--path", help="folder of Parquet events instead of the Kafka topic")
    stream.add_argument("--max-files", type=int, default=1_000, help="files of --path per micro-batch")
    stream.add_argument("--max-offsets", type=int, default=50_000_000, help="topic records per micro-batch")
    stream.add_argument("--available-now", action="store_true", help="process what is there, then end")
    gold = commands.add_parser("gold", help="build or update the Gold tables")
    gold.add_argument("--model", choices=sorted(MODELS), action="append")
    gold.add_argument("--lookback-hours", type=int, default=LOOKBACK_HOURS)
    gold.add_argument("--start-key", type=int)
    gold.add_argument("--end-key", type=int)
    gold.add_argument("--full-refresh", action="store_true")
    commands.add_parser("check", help="run the data checks on Silver and Gold")
    commands.add_parser("counts", help="count the rows of every table that the streams write")
    compact = commands.add_parser("compact", help="merge small files")
    compact.add_argument("--tables", default=os.environ.get("COMPACT_TABLES", DEFAULT_TABLES))
    compact.add_argument("--threshold", default=SMALL_FILE)
    compact.add_argument("--target", default=FULL_FILE)
    compact.add_argument("--start-key", type=int, help="first hour of tables compacted in place")
    compact.add_argument("--end-key", type=int, help="last hour; by default the last closed one of a streamed table")
    compact.add_argument("--expire", action="store_true", help="delete live loads that have been taken in")
    return root


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=os.environ.get("LOG_LEVEL", "INFO").upper())
    spark = spark or with_settings(SparkSession.builder.appName(f"tidemark-{args.command}")).getOrCreate()
    config = PipelineConfig.from_env()
    warehouse = config.warehouse

    if args.command == "init":
        create_tables(spark, warehouse)
        print(f"{add_partitions(spark, warehouse, args.start_key, args.end_key)} partitions added")
    elif args.command == "stream":
        if args.path:
            raw = read_transactions_stream(spark, args.path, args.max_files)
        else:
            raw = read_transactions_kafka(
                spark, config.kafka_bootstrap_servers, config.source_topic, max_offsets=args.max_offsets
            )
        # The process ends with its last thread, so a detached start only makes sense within a session.
        start_medallion(raw, config, wait=True, available_now=args.available_now)
    elif args.command == "gold":
        def silver(start_key: int | None, end_key: int | None) -> DataFrame:
            return read_layered(spark, warehouse, SILVER, start_key, end_key)

        for model in args.model or MODELS:
            build_gold(
                spark,
                model,
                silver,
                warehouse,
                lookback_hours=args.lookback_hours,
                start_key=args.start_key,
                end_key=args.end_key,
                full_refresh=args.full_refresh,
            )
    elif args.command == "check":
        for spec in (LIQUIDITY, ALERTS):
            recover(spark, table_root(warehouse, spec))
        tables = {s.name: read_table(spark, table_root(warehouse, s), s) for s in (LIQUIDITY, ALERTS)}
        tables[SILVER.name] = read_layered(spark, warehouse, SILVER)
        failed = run_checks(tables).where("failures > 0").collect()  # at most one row per check
        for row in failed:
            print(row.asDict())
        return 1 if failed else 0
    elif args.command == "counts":
        table_counts(spark, warehouse).show(truncate=False)
    elif args.command == "compact":
        reports = compact_tables(
            spark, warehouse, args.tables, args.threshold, args.target, args.start_key, args.end_key
        )
        for name, report in reports.items():
            print(name, report)
            if args.expire and table_for(name).streamed:
                print(name, expire_compacted(spark, warehouse, table_for(name)), "loads expired")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
