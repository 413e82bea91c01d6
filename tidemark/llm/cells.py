"""Comparing the rows of a bucket with each other, when a bucket may hold any share of all rows.

A bucket of more than ``block`` rows is dealt into blocks of about that size. Each pair of blocks is a
cell, and a row goes to the cells of its block. So every two rows of a bucket meet in one cell
exactly, no task holds more than one cell of a bucket, and nothing is dropped.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a task compares at once, in rows of a block.
BLOCK = 1000
CELL = ("bucket", "cell_a", "cell_b")


def dealt(rows: DataFrame, id_column: str, block: int = BLOCK) -> DataFrame:
    """``rows`` (with a long column ``bucket``), each once per cell that it goes to.

    Adds ``cell_a`` and ``cell_b``, the two blocks a cell compares, and ``side``, the row's own one.
    Buckets of one row are left out, having nothing to compare.
    """
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = sizes.select("bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64(F.col(id_column), F.lit("block")), F.col("blocks")).cast("int")
    return (
        rows.join(blocks, "bucket")
        .withColumn("side", own)
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .withColumn("cell_a", F.least("side", "other"))
        .withColumn("cell_b", F.greatest("side", "other"))
        .drop("other", "blocks")
    )


def gathered(rows: DataFrame) -> DataFrame:
    """Dealt rows, sorted so that a cell's rows follow each other."""
    return rows.repartition(*CELL).sortWithinPartitions(*CELL)


def into_cells(rows: DataFrame, id_column: str, block: int = BLOCK) -> DataFrame:
    """``rows`` as cells that are ready to be compared."""
    return gathered(dealt(rows, id_column, block))


def spanning(left: np.ndarray, right: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Of links between ``nodes`` numbered nodes, as many as keep the same nodes connected: a forest.

    Each round hangs every tree below the smallest root it is linked to, then flattens the trees.
    """
    root = np.arange(nodes)
    u, v = left, right
    while len(u):
        a, b = root[u], root[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        if not len(u):
            break
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            above = root[root]
            if (above == root).all():
                break
            root = above
    tied = np.flatnonzero(root != np.arange(nodes))
    return tied, root[tied]
