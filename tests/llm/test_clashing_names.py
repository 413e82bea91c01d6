"""Stages keep the columns of their input, also those named like the ones they use inside."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm.mixture import mixed
from tidemark.llm.quality_rff import _one_text, accepted
from tidemark.llm.secret_ledger import clean
from tidemark.llm.simhash_anchors import keep_one

NAMES = [
    "_secret", "_clean", "_blob", "_bad_content", "_own_content", "_own_id", "_own_tokens", "_number", "_row", "_used_id",
    "_times", "_epoch", "_kept_id", "node", "fp", "first", "shard", "a.b",
]


@pytest.fixture(scope="module")
def docs(spark, sample):
    return sample.limit(60).withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in NAMES})


@pytest.mark.parametrize("stage", ["accepted", "clean", "mixed", "keep_one"])
def test_values_stay(spark, sf_dir, docs, stage):
    if stage == "accepted":
        found = accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    else:
        found = {"clean": clean, "mixed": mixed, "keep_one": keep_one}[stage](docs)
    assert found.columns == docs.columns
    rows = found.collect()
    assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in NAMES)


def test_label_goes_to_the_same_text_in_any_order(spark):
    rows = [(1, [1.0], b"b"), (1, [2.0], b"a"), (1, [3.0], b"c"), (2, [4.0], b"")]
    table = spark.createDataFrame(rows, "doc_id long, x array<double>, content binary")
    for parts in (1, 3):
        found = {r.doc_id: r.x for r in _one_text(table.repartition(parts)).collect()}
        assert found == {1: [2.0], 2: [4.0]}
