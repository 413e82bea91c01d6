"""Weights of zero below the top level: the budget goes to those that can use it."""

import pytest

from tidemark.llm import mixture as mx

LEAVES = [("web", "de", "src2", 100), ("books", "en", "src1", 100), ("books", "en", "src3", 100)]


@pytest.mark.parametrize(
    ("lang", "source", "wanted"),
    [
        ({"de": 0}, {}, {"src2": 0, "src1": 75, "src3": 75}),  # all of web is German
        ({}, {"src2": 0}, {"src2": 0, "src1": 75, "src3": 75}),
        ({}, {"src1": 0}, {"src2": 75, "src1": 0, "src3": 75}),
        ({"en": 0}, {}, {"src2": 150, "src1": 0, "src3": 0}),
        ({"en": 0}, {"src2": 0}, {"src2": 0, "src1": 0, "src3": 0}),
    ],
)
def test_zero_at_language_or_source(spark, lang, source, wanted):
    mixture = mx.Mixture({"web": 1, "books": 1}, lang, source, share=0.5, epochs=2)
    leaves = spark.createDataFrame(LEAVES, "domain string, lang string, source string, tokens long")
    assert {r.source: r.given for r in mx.budgets(leaves, mixture).collect()} == wanted
