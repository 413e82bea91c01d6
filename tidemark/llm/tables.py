"""Small helpers of the training-data operators: inputs by name, shared intermediate tables, batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_folder

#: Bytes of text that a task works on at once, if a single text is not longer.
TOGETHER = 4_000_000
#: Stands for a missing id while rows are grouped and linked: it sorts before every other id.
NO_ID = -(2**63)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a written table in the shared folder: computed once, and safe from lost executors."""
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def packed(docs: DataFrame, *columns: Column) -> DataFrame:
    """Whole rows as a struct ``_row``, so that no name of theirs can clash with those of ``columns``."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), *columns)


def known_id(name: str) -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def given_id(column: Column) -> Column:
    return F.nullif(column, F.lit(NO_ID))


def content_of(text: Column) -> Column:
    """The SHA-256 of a text; a missing one has no bytes, unlike the empty text."""
    return F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b""))


def portions(batch: pa.RecordBatch, column: int, most: int = TOGETHER) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with up to ``most`` bytes of the texts in a column, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def joined(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The rows in fewer batches, which hold up to ``most`` bytes of the texts in a column, or one batch."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        own = pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
        if held and size + own > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += own
    if held:
        yield pa.concat_batches(held)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Cut batches of rows sorted by ``keys`` so that no group is spread over two of the tables.

    Memory is bounded by one batch and the largest group.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        last = int(np.flatnonzero(change)[-1]) if change.any() else 0
        same = bool(held) and all(held[-1].column(k)[-1].as_py() == batch.column(k)[0].as_py() for k in keys)
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        elif same:
            held.append(batch)
        else:
            if held:
                yield pa.Table.from_batches(held)
            held = [batch]
    if held:
        yield pa.Table.from_batches(held)
