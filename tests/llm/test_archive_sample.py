"""The sample for the archives' dictionary stays small, whatever is repeated."""

from tidemark.llm import warc


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(warc, "SAMPLE_PAGES", 50)
    monkeypatch.setattr(warc, "SAMPLE_CHARACTERS", 20)
    pages = spark.range(3000).selectExpr(
        "if(id % 3 = 0, null, id) page_id", "'u' url", "if(id % 3 = 0, repeat('same', 100), repeat(cast(id as string), 100)) html"
    )
    found = [r.begin for r in warc._sample(pages).collect()]
    assert 10 < len(found) < 120 and max(map(len, found)) == 20
    assert sum(b.startswith("same") for b in found) <= 1
    assert [r.begin for r in warc._sample(pages.repartition(7)).collect()] == found


def test_small_tables_are_taken_whole(spark):
    pages = spark.createDataFrame([(1, "u", "a"), (2, None, "b"), (None, "u", "")], "page_id long, url string, html string")
    assert sorted(r.begin for r in warc._sample(pages).collect()) == ["", "a", "b"]
    assert warc._sample(pages.limit(0)).count() == 0
