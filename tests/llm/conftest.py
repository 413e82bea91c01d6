import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm.queries import prepared

#: Also columns that an operator might use inside.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, id long, blob string, y double"


@pytest.fixture(scope="session", autouse=True)
def ready(spark):
    return prepared(spark)


def documents(spark, rows):
    """Rows of (doc_id, text[, lang, source]) as documents, with columns of clashing names."""
    full = [(*r, *("en", "src1")[len(r) - 2 :]) for r in rows]
    return spark.createDataFrame([(*r, None, 5, 6, "b", 0.5) for r in full], DOCS).withColumn(
        "n_chars", F.length("text").cast("long")
    )


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and blank texts, repeated rows and ids, a long text, other scripts."""
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma,", "delta", "ünï", "日本", "x", "42", "it's", "\n", "  "]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    rows = [
        (None, "no id at all, but some text here"), (None, None), (1, None), (2, ""), (3, " \t\n "), (4, "one"),
        (5, "Hello hello HELLO world"), (5, "Hello hello HELLO world"), (5, "another text of the same id"),
        (6, long), (7, long + " z"), (8, "a" * 5000), (9, "🙂 émoji and  two  spaces\r\nnew line "), (10, "<|endoftext|>"),
    ]
    full = [(*r, "en", "src1") for r in rows] + [(11, "no lang", None, "src2"), (12, "no source", "de", None)]
    return documents(spark, full)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars"
    )
