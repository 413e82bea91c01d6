"""Readers and writers of the pipeline's own tables (partitioned Parquet below a warehouse root)."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import TABLES, TableSpec, append_new_columns
from tidemark.functions.partition_hours import partition_hour_filter
from tidemark.sources.folders import Folders

LOAD = "load"
# Beside the loads of a streamed table: per stream query, the number of the last load that is complete.
LOADS = "_loads"
# Least partitions before adaptive execution merges and splits them. Hours should rarely share one,
# since a partition that is split gives each part a share of all its hours.
REBALANCE_PARTITIONS = 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def table_root(warehouse: str, spec: TableSpec) -> str:
    return f"{warehouse.rstrip('/')}/{spec.path}"


def read_table(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """All rows of a table under its declared schema; the ``load`` folders of a streamed table vanish."""
    return spark.read.schema(spec.schema).parquet(root).select(spec.columns)


def read_hours(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    start_key: int | None = None,
    end_key: int | None = None,
    with_load: bool = False,
) -> DataFrame:
    """Rows of a table within hour bounds, both ends included. Only folders of these hours are listed.

    ``with_load`` keeps the ``load`` of a streamed table's rows.
    """
    load = [T.StructField(LOAD, T.StringType())] if with_load else []
    schema = T.StructType([*spec.schema.fields, *load])
    reader = spark.read.schema(schema)
    if start_key is None and end_key is None and Folders(spark, root).exists(""):
        return reader.parquet(root).select(schema.fieldNames())
    folders = Folders(spark, root).hours(start_key, end_key)
    if not folders:
        return spark.createDataFrame([], schema)
    rows = reader.option("basePath", root).parquet(*[f"{root.rstrip('/')}/{f}" for f in folders])
    for op, key in ((">=", start_key), ("<=", end_key)):
        if key is not None:
            rows = rows.where(partition_hour_filter(op, key))
    return rows.select(schema.fieldNames())


def open_table(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame | None:
    """Same as :func:`read_table`, or None where nothing has been written yet."""
    try:
        return read_table(spark, root, spec)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, TABLES["silver.transactions"])


def _writer(df: DataFrame, spec: TableSpec, mode: str, dynamic: bool, load: bool = False):
    # Ordering by the partition columns first is what the partitioned writer needs anyway, so the
    # in-file order costs no second sort.
    partitions = [*spec.partition_by, *([LOAD] if load else [])]
    ordered = df.sortWithinPartitions(*partitions, *spec.sort_by)
    writer = (
        ordered.write.mode(mode)
        .option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    )
    return writer.partitionBy(*partitions) if partitions else writer


def _table_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    fields = append_new_columns(spec.schema, df.schema)
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def write_table(
    df: DataFrame, root: str, spec: TableSpec, *, dynamic: bool = False, rebalance: bool = True
) -> None:
    """Overwrite a table, or with ``dynamic`` only the partitions that occur in ``df``.

    Rows are rebalanced on the partition columns first: small hours share a task, and adaptive
    execution splits an hour that exceeds the advisory size over several tasks and files, so a hot
    hour neither ends in one task nor leaves one sliver per upstream task.
    """
    rows = _table_columns(df, spec)
    _writer(_rebalanced(rows, spec) if rebalance else rows, spec, "overwrite", dynamic).parquet(root)


def _rebalanced(rows: DataFrame, spec: TableSpec) -> DataFrame:
    # A session for many hours sets more initial partitions; fewer than the least would mix hours.
    initial = int(rows.sparkSession.conf.get(INITIAL_PARTITIONS, None) or 0)
    return rows.hint("rebalance", max(REBALANCE_PARTITIONS, initial), *spec.partition_by)


def split_load(load: Column) -> tuple[Column, Column]:
    """The stream query of a load, and the load's number."""
    number = F.regexp_extract(load, "-([0-9]+)$", 1)
    return F.regexp_extract(load, "^(.*)-[0-9]+$", 1), F.try_to_number(number, F.lit("9" * 18)).cast("long")


def write_load(df: DataFrame, root: str, spec: TableSpec, load_id: str) -> None:
    """Add one micro-batch, named ``<query>-<number>``; a replay of the batch replaces its rows.

    Its folders lie below those of the hours, so that a reader of some hours lists these alone. Once all are
    there, the load is noted as complete; loads of a query are written one after the other.
    """
    query, _, number = load_id.rpartition("-")
    if not query or not number.isdigit():
        raise ValueError(f"not the name of a load: {load_id!r}")
    rows = _rebalanced(_table_columns(df, spec), spec).withColumn(LOAD, F.lit(load_id))
    _writer(rows, spec, "overwrite", dynamic=True, load=True).parquet(root)
    Folders(df.sparkSession, root).write_json(f"{LOADS}/{query}", {"last": int(number)})


def complete_loads(spark: SparkSession, root: str) -> dict[str, int]:
    """Per stream query the number of its last complete load."""
    folders = Folders(spark, root)
    queries = [name for name in folders.names(LOADS) if not name.startswith(".")]
    return {query: found["last"] for query in queries if (found := folders.read_json(f"{LOADS}/{query}"))}


def write_bronze(df: DataFrame, root: str, load_id: str) -> None:
    write_load(df, root, TABLES["bronze.transactions"], load_id)


def write_rejected(df: DataFrame, root: str, load_id: str) -> None:
    write_load(df, root, TABLES["bronze.transactions_rejected"], load_id)


def write_silver(df: DataFrame, root: str, load_id: str) -> None:
    write_load(df, root, TABLES["silver.transactions"], load_id)


def count_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` per table: Parquet answers it from row-group counts, without columns."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def create_tables(spark: SparkSession, warehouse: str, prefix: str = "") -> None:
    """Create the namespaces, with a prefix, and register every table in the session catalog, as far as missing.

    Streamed tables list ``load`` as their last partition column. Run :func:`add_partitions`
    after new data has landed to make it visible to SQL.
    """
    for namespace in dict.fromkeys(name.split(".")[0] for name in TABLES):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{namespace}")
    for spec in TABLES.values():
        partitions = _catalog_partitions(spec)
        fields = [f for f in spec.schema if f.name not in partitions]
        fields += [f for f in spec.schema if f.name in partitions]
        if LOAD in partitions:
            fields.append(T.StructField(LOAD, T.StringType()))
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
        clustering = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        location = table_root(warehouse, spec).replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {prefix}{spec.name} ({columns}) USING parquet "
            f"OPTIONS (compression 'zstd') {clustering} LOCATION '{location}'"
        )


def _catalog_partitions(spec: TableSpec) -> list[str]:
    return [*spec.partition_by, *([LOAD] if spec.streamed else [])]


#: Partitions that one statement adds to the catalog.
ADDED_TOGETHER = 500


def drop_tables(spark: SparkSession, prefix: str) -> None:
    """Take the tables out of the catalog again; their files stay."""
    for namespace in dict.fromkeys(name.split(".")[0] for name in TABLES):
        spark.sql(f"DROP DATABASE IF EXISTS {prefix}{namespace} CASCADE")


def add_partitions(
    spark: SparkSession, warehouse: str, start_key: int | None = None, end_key: int | None = None, prefix: str = ""
) -> int:
    """Make partitions visible to SQL that the catalog does not know yet; returns their number.

    With bounds, only the folders of those hours are listed and only their partitions compared.
    """
    added = 0
    for spec in TABLES.values():
        partitions = _catalog_partitions(spec)
        if not partitions:
            continue
        folders = Folders(spark, table_root(warehouse, spec))
        found = folders.hours(start_key, end_key, whole=True) if spec.partition_by else [""]
        if spec.streamed:
            loads = ((f, n) for f in found for n in folders.names(f) if n.startswith(f"{LOAD}="))
            found = [f"{folder}/{name}" if folder else name for folder, name in loads]
        listed = spark.sql(f"SHOW PARTITIONS {prefix}{spec.name}")
        wanted = spark.createDataFrame([(f,) for f in found], "partition string")
        new = [r["partition"] for r in wanted.join(listed, "partition", "left_anti").sort("partition").collect()]
        for first in range(0, len(new), ADDED_TOGETHER):
            clauses = [_partition_clause(name) for name in new[first : first + ADDED_TOGETHER]]
            spark.sql(f"ALTER TABLE {prefix}{spec.name} ADD IF NOT EXISTS {' '.join(clauses)}")
        added += len(new)
    return added


def _partition_clause(folder: str) -> str:
    values = (part.partition("=") for part in folder.split("/"))
    told = ", ".join(f"{name} = '{value}'" if name == LOAD else f"{name} = {int(value)}" for name, _, value in values)
    return f"PARTITION ({told})"
