"""Small-file compaction of partitioned tables.

A table that nothing writes to but this library is compacted in place. A streamed table's folders
belong to the running stream, so its closed hours are compacted into a second root, and read as a
layer below the live loads. In both cases hours are staged first and noted in a journal: a run that died is
finished or resumed by the next one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.config import parse_size, parse_tables, table_for
from tidemark.contract import TableSpec
from tidemark.functions.partition_hours import hour_of_folders, partition_hour_key
from tidemark.operators.gold import in_hours
from tidemark.sources.folders import Folders
from tidemark.sources.journal import LAYER, Change, begin, recover
from tidemark.sources.layers import END_OF_TIME, Layer, compacted_root, read_layer
from tidemark.sources.tables import (
    complete_loads,
    read_hours,
    read_table,
    table_root,
    write_table,
)

# Files below the threshold count as small; the target is the size of a full file.
SMALL_FILE = "64MB"
FULL_FILE = "128MB"
# Upper bound on the tasks that list file sizes, whatever the size of the table.
LISTING_TASKS = 2000
# Tasks of one merge shuffle, unless a single hour needs more. Further hours follow in another run.
RUN_TASKS = 10_000


@dataclass(frozen=True)
class Compaction:
    """What a run did."""

    rewritten_hours: int
    kept_hours: int
    files_before: int
    files_planned: int


def file_sizes(spark: SparkSession, root: str) -> DataFrame:
    """Path, length and partition columns of every data file. Reads file listings, not contents."""
    return _listed(spark, root, [root])


def _listed(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    lister = spark.newSession()
    lister.conf.set("spark.sql.files.maxPartitionNum", str(LISTING_TASKS))
    reader = lister.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("basePath", root)
    return reader.load(folders).drop("content", "modificationTime")


def hours_to_compact(files: DataFrame, threshold: int, target: int) -> DataFrame:
    """Per hour: its file count, the count it should have, and whether rewriting it is worth it.

    That is the case when it holds at least two small files and full files would be fewer. The
    second condition makes a repeated run find nothing to do.
    """
    per_hour = files.groupBy(partition_hour_key().alias("hour_key")).agg(
        F.count(F.lit(1)).cast("int").alias("files"),
        F.count_if(F.col("length") < threshold).alias("small_files"),
        F.sum("length").alias("bytes"),
    )
    wanted = F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(target)).cast("int"))
    return per_hour.select(
        "hour_key",
        "files",
        "bytes",
        wanted.alias("wanted_files"),
        ((F.col("small_files") > 1) & (wanted < F.col("files"))).alias("rewrite"),
    )


def _assign_tasks(hours: list[Row], target: int, parallelism: int) -> tuple[list[tuple[int, int, int]], int]:
    """``(hour, files, first task)`` per hour, and the number of tasks.

    Hours of one file share tasks up to the target size (less, to use the available cores); every
    file of a larger hour gets a task of its own.
    """
    shared_bytes = sum(h.bytes for h in hours if h.wanted_files == 1)
    task_bytes = max(1, min(target, shared_bytes // parallelism))
    layout, position = [], 0.0
    for h in hours:
        if h.wanted_files > 1:
            position = float(math.ceil(position))
        layout.append((h.hour_key, h.wanted_files, int(position)))
        position += h.wanted_files if h.wanted_files > 1 else h.bytes / task_bytes
    return layout, int(position) + 1


def _runs(hours: list[Row], most: int) -> Iterator[list[Row]]:
    """Whole hours in turn, as many as together get at most ``most`` files, or one hour."""
    run: list[Row] = []
    for h in hours:
        if run and sum(r.wanted_files for r in run) + h.wanted_files > most:
            yield run
            run = []
        run.append(h)
    if run:
        yield run


def _spread(rows: DataFrame, layout: list[tuple[int, int, int]], tasks: int) -> DataFrame:
    """Shuffle rows into the tasks assigned to their hour.

    The running number of a row within its scan task picks one of the hour's tasks, so an hour
    splits evenly even if it consists of copies of one row.
    """
    # One small row per hour, so even decades of hours are safe to broadcast.
    hours = rows.sparkSession.createDataFrame(layout, "_hour_key int, _files int, _first_task int")
    numbered = rows.withColumn("_row", F.monotonically_increasing_id()).withColumn(
        "_hour_key", partition_hour_key()
    )
    task = (F.col("_first_task") + F.col("_row") % F.col("_files")).cast("int")
    spread = numbered.join(F.broadcast(hours), "_hour_key").repartitionById(tasks, task)
    return spread.select(rows.columns)


def compact_partitions(
    spark: SparkSession,
    src: str,
    dst: str,
    spec: TableSpec,
    threshold: str = SMALL_FILE,
    target: str = FULL_FILE,
    start_key: int | None = None,
    end_key: int | None = None,
    run_tasks: int = RUN_TASKS,
) -> Compaction:
    """Merge the small files of each hour; rows stay the same.

    With ``dst`` equal to ``src`` only hours that need it are rewritten, in place. A streamed table
    is compacted into another root instead, one without ``load`` folders, because its own folders
    belong to the running stream; hours that need no merging are copied as they are. Limit such a
    run to closed hours with ``end_key``, and to hours not yet compacted with ``start_key``: a
    repeated run for the same hours replaces them.

    Spark lists the files of the table on the driver; of their sizes one row per hour is collected. Hours are
    rewritten in runs of at most ``run_tasks`` files, or of one hour. Replacing partitions is not one
    atomic step for readers of ``dst``.
    """
    in_place = dst.rstrip("/") == src.rstrip("/")
    if in_place and spec.streamed:
        raise ValueError(f"{spec.name} is written by a stream: compact it into another root")
    if not spec.partition_by:
        raise ValueError(f"{spec.name} is not partitioned by hour")
    if in_place:
        recover(spark, src)

    files = in_hours(file_sizes(spark, src), start_key=start_key, end_key=end_key)
    hours = hours_to_compact(files, parse_size(threshold), parse_size(target)).sort("hour_key").collect()
    worth_it = [h for h in hours if h.rewrite]
    kept = [h.hour_key for h in hours if not h.rewrite]

    rows = in_hours(read_table(spark, src, spec), start_key=start_key, end_key=end_key)
    change = begin(spark, src, "compact") if in_place and worth_it else None
    for run in _runs(worth_it, run_tasks):
        _write_merged(rows, change.staging if change else dst, spec, run, parse_size(target))
    if change:
        change.stage()
        change.finish()
    if kept and not in_place:
        copied = rows.where(partition_hour_key().isin(kept))
        write_table(copied, dst, spec, dynamic=True, rebalance=False)
    return Compaction(
        rewritten_hours=len(worth_it),
        kept_hours=len(kept),
        files_before=sum(h.files for h in hours),
        files_planned=sum(h.wanted_files if h.rewrite else h.files for h in hours),
    )


def _write_merged(rows: DataFrame, dst: str, spec: TableSpec, run: list[Row], target: int) -> None:
    """Write the rows of some hours with the wanted number of files each, and nothing else."""
    layout, tasks = _assign_tasks(run, target, rows.sparkSession.sparkContext.defaultParallelism)
    fragmented = rows.where(partition_hour_key().isin([h.hour_key for h in run]))
    write_table(_spread(fragmented, layout, tasks), dst, spec, dynamic=True, rebalance=False)


def compact_layer(
    spark: SparkSession,
    warehouse: str,
    spec: TableSpec,
    target: str = FULL_FILE,
    end_key: int | None = None,
    run_tasks: int = RUN_TASKS,
) -> Compaction:
    """Take the closed hours of a streamed table up to ``end_key`` into its compacted layer.

    Without ``end_key`` all hours before the table's newest one count as closed. Only hours with
    loads that the layer has not taken in yet are rewritten: new hours, and older ones that late rows
    have reached. Loads that may still be under way are left to a later run. A run that died is
    resumed with the hours and loads it had set out to take, staged hours are not written again, and
    then what came since is taken in.
    """
    if not (spec.streamed and spec.partition_by):
        raise ValueError(f"{spec.name} is not a streamed table with hours")
    compacted = compacted_root(warehouse, spec)
    reports = [_stage_layer(spark, warehouse, spec, target, run_tasks, c) for c in recover(spark, compacted)]
    layer = read_layer(spark, compacted)
    plan = _layer_plan(spark, warehouse, spec, layer, target, end_key)
    if plan:
        note = {LAYER: Layer(plan["through_key"], plan["loads"]).as_dict()}
        change = begin(spark, compacted, "layer", plan, note, resumable=True)
        reports.append(_stage_layer(spark, warehouse, spec, target, run_tasks, change))
    return Compaction(*(sum(getattr(r, f) for r in reports) for f in Compaction.__dataclass_fields__))


def _layer_plan(
    spark: SparkSession, warehouse: str, spec: TableSpec, layer: Layer | None, target: str, end_key: int | None
) -> dict | None:
    """Hours to take in, with the files they shall have, and the loads they are taken from."""
    live, compacted = table_root(warehouse, spec), compacted_root(warehouse, spec)
    loads = complete_loads(spark, live)
    if end_key is None:
        hours = Folders(spark, live).hours(whole=True)
        keys = sorted(hour_of_folders(tuple(int(part.partition("=")[2]) for part in hour.split("/")))[0] for hour in hours)
        end_key = keys[-2] if len(keys) > 1 else None
    if end_key is None or not loads:
        return None
    # The mark holds for all hours of the layer, so these are looked through in any case.
    end_key = max(end_key, layer.through_key) if layer else end_key
    folders = Folders(spark, live).hours(end_key=end_key)
    if not folders:
        return None
    files = in_hours(_listed(spark, live, [f"{live}/{f}" for f in folders]), end_key=end_key)
    files = files.where(Layer(END_OF_TIME, loads).has())
    if layer:
        files = files.where(~layer.has())
    new = files.groupBy(partition_hour_key().alias("hour_key")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    hours = {h.hour_key: [h.files, h.bytes] for h in new.collect()}  # a row per hour
    if not hours:
        return None
    if layer and (late := [key for key in hours if key <= layer.through_key]):
        have = [f"{compacted}/{f}" for key in late for f in Folders(spark, compacted).hours(key, key, whole=True)]
        if have:
            sizes = _listed(spark, compacted, have).groupBy(partition_hour_key().alias("hour_key"))
            for h in sizes.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")).collect():
                hours[h.hour_key] = [hours[h.hour_key][0] + h.files, hours[h.hour_key][1] + h.bytes]
    full = parse_size(target)
    listed = [[key, files_, size, max(1, math.ceil(size / full))] for key, (files_, size) in sorted(hours.items())]
    return {"hours": listed, "done": [], "loads": loads, "through_key": end_key}


def _stage_layer(
    spark: SparkSession, warehouse: str, spec: TableSpec, target: str, run_tasks: int, change: Change
) -> Compaction:
    """Stage the hours of a plan that are not staged yet, then let all take their places."""
    plan = change.plan
    before = read_layer(spark, change.root)
    after = Layer(END_OF_TIME, plan["loads"])
    hours = [Row(hour_key=k, files=f, bytes=b, wanted_files=w) for k, f, b, w in plan["hours"]]
    left = [h for h in hours if h.hour_key not in set(plan["done"])]
    for run in _runs(left, run_tasks):
        first, last = run[0].hour_key, run[-1].hour_key
        live = read_hours(spark, table_root(warehouse, spec), spec, first, last, with_load=True).where(after.has())
        if before:
            live = live.where(~before.has())
            closed = read_hours(spark, change.root, spec, first, min(last, before.through_key))
            rows = live.select(spec.columns).unionByName(closed)
        else:
            rows = live.select(spec.columns)
        _write_merged(rows, change.staging, spec, run, parse_size(target))
        plan["done"] += [h.hour_key for h in run]
        change.save()
    change.stage()
    change.finish()
    return Compaction(len(hours), 0, sum(h.files for h in hours), sum(h.wanted_files for h in hours))


def compact_tables(
    spark: SparkSession,
    warehouse: str,
    names: str,
    threshold: str = SMALL_FILE,
    target: str = FULL_FILE,
    start_key: int | None = None,
    end_key: int | None = None,
) -> dict[str, Compaction]:
    """Compact a comma-separated list of ``catalog.schema.table`` names, one after the other.

    Gold tables are compacted in place. Streamed ones are taken into ``<warehouse>/compacted``, which
    :func:`read_layered` reads together with the live loads; there the hours begin with the first.
    """
    reports = {}
    for name in parse_tables(names):
        spec = table_for(name)
        if spec.streamed:
            if start_key is not None:
                raise ValueError(f"{name} is compacted from its first hour on; leave the start out")
            reports[name] = compact_layer(spark, warehouse, spec, target, end_key)
        else:
            root = table_root(warehouse, spec)
            reports[name] = compact_partitions(spark, root, root, spec, threshold, target, start_key, end_key)
    return reports

