"""Token files against the library as it comes, with strings of added tokens in the texts."""

import random

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from tidemark.llm import token_files as tf

TEXTS = [
    "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "end<|endoftext|>\n\n  next", "a <|endoftext| > b",
    "  <|endoftext|>  's  <|endoftext|>", "<|endoftext|>é日本🙂", "no token at all",
]


def test_strings_of_added_tokens(spark, odd):
    library = Tokenizer.from_file(tf.VOCABULARY)
    assert library.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for table in (docs, odd):
        rows = tf.read_token_files(tf.write_token_files(table)).orderBy("start").collect()
        assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
        wanted = sorted([*library.encode(r.text or "", add_special_tokens=False).ids, 0] for r in table.collect())
        assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in rows) == wanted


def test_remembered_pieces_are_the_library():
    library = Tokenizer.from_file(tf.VOCABULARY)
    encoder = tf.TextEncoder(tf.VOCABULARY)
    rng = random.Random(12)
    parts = ["a", "th", " ", "  ", "\n", "'s", "é", "1", "<|endoftext|>", "<|end", "oftext|>", "|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    for text, ids in zip(texts, encoder.encode(pa.array(texts)).to_pylist(), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
