"""Each row is filtered by its own prediction, whatever its id."""

from pyspark.sql import functions as F

from tidemark.llm import quality_rff as q


def test_rows_that_share_an_id_are_judged_apart(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = {r.doc_id: r.predicted for r in q.score_quality(docs, labels).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    bad = {texts[i] for i, predicted in scored.items() if not predicted}
    assert 0 < len(bad) < len(set(texts.values()))
    # Copies of all rows without an id, and under one id that has no label.
    more = docs.withColumn("doc_id", F.lit(None).cast("long")).union(docs.withColumn("doc_id", F.lit(10**9)))
    kept = q.accepted(docs.union(more), labels)
    wanted = sorted(t for t in texts.values() if t not in bad)
    for ids in ("doc_id IS NULL", "doc_id = 1000000000", "doc_id < 1000000000"):
        assert sorted(r.text for r in kept.filter(ids).collect()) == wanted
