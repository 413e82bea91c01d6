"""Byte-level BPE against the library of the same vocabulary, and the token files."""

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import bpe_transducer as bpe
from tidemark.llm import token_files as tf
from tidemark.llm.files import new_file, open_file
from tidemark.llm.queries import QUERIES


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_of_any_bytes(ranks, library):
    rng = random.Random(3)
    machine = bpe.Transducer(ranks, states=500)  # forgets again and again
    for n in range(3000):
        kinds = b"aabcdethingso   \xc3\xa9\xff" if n % 2 else bytes(range(256))
        piece = bytes(rng.choice(kinds) for _ in range(rng.randint(1, 30)))
        assert machine.encode(piece) == library._core_bpe.encode_single_piece(piece)
    assert machine.encode(b"") == []


def test_unknown_byte():
    with pytest.raises(ValueError, match="no token"):
        bpe.Transducer({b"a": 0}).encode(b"ab")


def test_texts(library):
    rng = random.Random(4)
    parts = ["a", "th", " ", "  ", "\n", "\t ", "'s", "'re", "'", "ing", "é", "日本", "1", "!!", "🙂", "\x1c", "\x85", "'LL", "½", "<|endoftext|>"]
    memory = bpe._memory(bpe.VOCABULARY)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)] + ["", " ", "a" * 3000]
    for text, ids in zip(texts, memory.encode(pa.array(texts)).to_pylist(), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), text


def test_incremental_utf8():
    rng = random.Random(6)
    some = [0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x99, 0x82, 0xFF, 0xED, 0xA0, 0xE0, 0x80, 0xF4, 0x90]
    for _ in range(3000):
        data = bytes(rng.choice(some) for _ in range(rng.randint(0, 9)))
        machine = bpe.Utf8Machine()
        cut = rng.randint(1, 3)
        text = "".join(machine.feed(data[i : i + cut]) for i in range(0, len(data), cut)) + machine.finish()
        assert text == data.decode("utf-8", "replace")


def test_round_trip_of_odd_rows(odd, none, library):
    found = bpe.decoded(bpe.encoded(odd)).collect()
    wanted = sorted((r.doc_id or -1, r.text or "") for r in odd.collect())
    assert sorted((r.doc_id or -1, r.text) for r in found) == wanted
    assert all(np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(r.text) for r in found)
    assert bpe.decoded(bpe.encoded(none)).count() == 0


def test_query_of_bpe(spark, sf_dir, sample, library):
    found = {r.doc_id: r.n_tokens for r in QUERIES["op1_byte_bpe"](spark, sf_dir).collect()}
    assert found == {r.doc_id: len(library.encode_ordinary(r.text)) for r in sample.collect()}


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 31, 32])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 5000, dtype=np.uint64).astype(np.uint32)
    data = tf.pack(ids, bits)
    assert len(data) == -(-len(ids) * bits // 8)
    assert (tf.unpack(data, len(ids), bits) == ids).all()
    with pytest.raises(ValueError):
        tf.pack(np.array([1 << 20], np.uint32), 16)


def test_random_access(tmp_path):
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 50_000, n).astype(np.uint32) for n in (5, 9000, 0, 1, 4096, 77)]
    path, out = new_file(str(tmp_path), "t")
    writer = tf.TokenWriter(out, 17)
    for n, ids in enumerate(docs):
        writer.add(n, ids)
    writer.close()
    reader = tf.TokenReader(open_file(path))
    everything = np.concatenate(docs)
    for n, ids in enumerate(docs):
        assert (reader.document(n) == ids).all()
    for first, last in ((0, 0), (4000, 4200), (0, len(everything)), (9004, 9006)):
        assert (reader.read(first, last) == everything[first:last]).all()


def test_token_files_of_odd_rows(odd, none):
    library = Tokenizer.from_file(tf.VOCABULARY)
    rows = tf.read_token_files(tf.write_token_files(odd)).orderBy("start").collect()
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda x: -1 if x is None else x)
    wanted = sorted([*library.encode(r.text or "", add_special_tokens=False).ids, 0] for r in odd.collect())
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in rows) == wanted
    assert tf.read_token_files(tf.write_token_files(none)).count() == 0


def test_query_of_token_files(spark, sf_dir, sample):
    library = Tokenizer.from_file(tf.VOCABULARY)
    start, wanted = 0, {}
    for r in sample.orderBy("doc_id").collect():
        ids = np.array([*library.encode(r.text, add_special_tokens=False).ids, 0], "<u4")
        wanted[r.doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert {r.doc_id: tuple(r)[1:] for r in QUERIES["op7_token_files"](spark, sf_dir).collect()} == wanted
