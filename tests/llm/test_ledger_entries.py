"""One entry per content and set of rules, however often its rows repeat."""

from tidemark.llm import secret_ledger as s


def test_repeated_rows_and_rows_without_ids(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    text = "x token = abcdefgh12"
    rows = [(None, text)] * 40 + [(3, text)] * 5 + [(4, text), (None, "clean"), (None, "clean"), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = s.scan(docs, ledger).collect()
    assert len(found) == len(rows) and sum(len(r.found) for r in found) == 46
    assert s.read_ledger(spark, ledger).count() == 3
    s.scan(docs.union(docs), ledger).count()
    assert s.read_ledger(spark, ledger).count() == 3
