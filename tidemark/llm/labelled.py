"""What the trained classifiers share: the documents held out, and a bounded sample of the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of an id's text, modulo; a missing id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def means(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id``, ``y``: repeated labels of a document count as their mean; those without id or label as none."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y"))
        .filter("doc_id IS NOT NULL AND y IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.avg("y").alias("y"))
    )


def sample(labels: DataFrame, most: int) -> DataFrame:
    """All labels, or by a hash of the id about ``most`` of them; the models here are fitted on no more."""
    rows = labels.count()
    if rows <= most:
        return labels
    share = int(most / rows * (1 << 32))
    return labels.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 32)) < share)
