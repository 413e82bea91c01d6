"""A third of the rows share an id, or have none: they are spread like others."""

from collections import Counter

import numpy as np
from tokenizers import Tokenizer

from tidemark.llm import token_files as tf
from tidemark.llm import winnowing as w


def test_token_files_of_one_id(spark, monkeypatch):
    monkeypatch.setattr(tf, "DOCUMENTS", 30)
    rows = spark.range(900).selectExpr(
        "if(id % 3 = 0, null, if(id % 3 = 1, 7, id)) doc_id", "if(id % 6 = 0, 'the same text', concat('text ', id)) text"
    )
    files = tf.write_token_files(rows)
    sizes = sorted(r.documents for r in files.collect())
    assert sum(sizes) == 900 and len(sizes) >= 25 and sizes[-1] < 3 * sizes[len(sizes) // 2]
    library = Tokenizer.from_file(tf.VOCABULARY)
    found = tf.read_token_files(files).orderBy("start").collect()
    assert [-1 if r.doc_id is None else r.doc_id for r in found] == sorted(-1 if r.doc_id is None else r.doc_id for r in rows.collect())
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    wanted = sorted([*library.encode(r.text, add_special_tokens=False).ids, 0] for r in rows.collect())
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in found) == wanted


def test_ranges_of_one_id(spark):
    rows = spark.range(9000).selectExpr("if(id % 3 = 0, null, if(id % 3 = 1, 7, id)) doc_id", "concat('text ', id) text")
    found = w.with_next(rows).collect()
    sizes = sorted(Counter(r.range for r in found).values())
    assert len(sizes) > 60 and sizes[-1] < 3 * sizes[len(sizes) // 2]
    assert sum(r.copy == 0 for r in found) == 9000 and len(found) < 9200
    own = sorted(((r.doc_id, r.content, r.text, r.next_text) for r in found if r.copy == 0))
    assert [r[3] for r in own] == [r[2] for r in own[1:]] + [own[0][2]]


def test_next_of_repeated_rows(spark):
    rows = spark.range(1000).selectExpr("if(id % 2 = 0, null, id % 50) doc_id", "if(id % 4 = 0, 'same', concat('text ', id % 7)) text")
    for table in (rows, rows.filter("doc_id IS NULL"), rows.limit(3), rows.limit(1)):
        own = sorted((r.doc_id, r.content, r.text, r.next_text) for r in w.with_next(table).collect() if r.copy == 0)
        texts = [r[2] for r in own]
        # Of equal rows only the last has another one after it; which of them that is does not matter.
        assert sorted(zip((r[:3] for r in own), texts[1:] + texts[:1], strict=True)) == sorted((r[:3], r[3]) for r in own)
