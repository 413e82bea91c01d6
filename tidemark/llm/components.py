"""Connected components of a graph of any size, by alternating large and small stars.

After Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). A node's neighbours are
never gathered: only their minimum is, and that combines before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) as ``node``, ``component``: the smallest node reachable.

    Only nodes with a link to another node are returned. Repeated, reversed and self links are
    harmless; links with a null end are ignored. Every round is a written table.
    """
    edges = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    while not _is_stars(edges):
        edges = stored(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie the larger neighbours of each node to its smallest neighbour or itself."""
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
        edges.select(F.col("v").alias("x"), F.col("u").alias("y"))
    )
    smallest = both.groupBy("x").agg(F.min("y").alias("m"))
    return (
        both.filter("y > x")
        .join(smallest, "x")
        .select(F.col("y").alias("u"), F.least("m", "x").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(smallest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(smallest.withColumnRenamed("m", "v")).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has only that one, and that is a root."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    bad = (
        ends.groupBy("node")
        .agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        .filter("up > 1 OR (up > 0 AND down > 0)")
    )
    return bad.isEmpty()
