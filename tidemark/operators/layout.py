"""How the rows of a table lie in its files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import TableSpec

FILE, PLACE = "_file", "_place"


def read_places(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """The columns a table is sorted by, with the file of each row and its place in the file."""
    rows = spark.read.schema(spec.schema).parquet(root)
    return rows.select(
        *spec.sort_by, F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(PLACE)
    )


def order_violations(places: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that stand right behind a greater one of the same file, in the order the table is declared to have.

    Missing values come first. Each row meets the one before it by a join on file and place, so that
    no task holds a whole file, however large.
    """
    own = F.struct(*spec.sort_by)
    before = places.select(FILE, (F.col(PLACE) + 1).alias(PLACE), own.alias("_before"))
    paired = places.join(before, [FILE, PLACE]).select(*places.columns, "_before")
    return paired.where(F.col("_before") > own)
