"""Cutting by Arrow and the remembered units, against cutting each text by the pattern."""

import random

import pyarrow as pa
import pytest

from tidemark.llm import pieces
from tidemark.llm.pieces import PIECE, PieceMemory, pack_ids
from tidemark.llm.tables import joined, portions

WHITE = [" ", " ", " ", "\n", "\t", "\r", " ", " ", "　", "\x85", " "]
BLACK = ["a", "word", "I", "it's", "don't", "'ll", "12", "3.5", "end.", "x.)", "(y),", "é", "日本", "!", "?!", ".", "\x01", "\x1c", "_", "a1", "١٢", "²"]


def ids_of(piece):
    return pack_ids([ord(c) for c in piece])


def by_pattern(text):
    """Ids of the pieces, each closed by a mark, so that another cut gives other ids."""
    return b"".join(ids_of(p + "|") for p in PIECE.findall(text))


class Marked(PieceMemory):
    calls = 0

    def __init__(self, limit=pieces.REMEMBERED_BYTES):
        super().__init__(self.told, limit)

    def told(self, found):
        self.calls += len(found)
        return [ids_of(p + "|") for p in found]


def some_texts(seed, count=400):
    rng = random.Random(seed)
    texts = ["", " ", "\n", "  ", "a  ", "a \n", "a\n\n", "a\n b", "a \nb", "a   b", "\n\n\nb", "a.\n", "a. ", "a.", ".a", "a .b"]
    for _ in range(count):
        parts = []
        for _ in range(rng.randint(1, 12)):
            parts.append(rng.choice(BLACK))
            parts.append("".join(rng.choice(WHITE) for _ in range(rng.choice([0, 1, 1, 1, 2, 2, 3]))))
        texts.append("".join(parts[rng.randint(0, 1) :]))
    return texts


@pytest.mark.parametrize("seed", range(6))
def test_cuts_are_those_of_the_pattern(seed):
    texts = some_texts(seed)
    memory = Marked()
    for _ in range(2):
        assert memory.encode(pa.array(texts)).to_pylist() == [by_pattern(t) for t in texts]
    for text in texts:  # each on its own: no text is spared the cuts by another one
        assert Marked().encode(pa.array([text])).to_pylist() == [by_pattern(text)]
    sliced = pa.array(texts)[7:90]
    assert memory.encode(sliced).to_pylist() == [by_pattern(t) for t in texts[7:90]]
    assert memory.encode(pa.array([], pa.string())).to_pylist() == []


@pytest.mark.parametrize("limit", [0, 2_000, 20_000])
def test_memory_is_bounded(limit):
    texts = some_texts(9, 2000)
    memory = Marked(limit)
    for begin in range(0, len(texts), 100):
        some = texts[begin : begin + 100]
        assert memory.encode(pa.array(some)).to_pylist() == [by_pattern(t) for t in some]
        assert memory.held <= limit and len(memory.old) * 150 <= limit + 1000


def test_units_are_remembered():
    memory = Marked()
    texts = pa.array(["the cat sat on the mat.\nThe cat", "a longer one, with the cat."])
    memory.encode(texts)
    first = memory.calls
    memory.encode(texts)
    assert memory.calls == first
    memory.encode(pa.array(["x" * 500]))
    assert all(len(unit) <= pieces.REMEMBERED_LENGTH for unit in memory.young)


def test_batches_are_joined_and_cut():
    batches = [pa.RecordBatch.from_pydict({"t": pa.array(["x" * n, None])}) for n in (3, 4, 50, 2, 2)]
    assert [b.num_rows for b in joined(iter(batches), 0, 10)] == [4, 2, 4]
    whole = pa.concat_batches(batches)
    cut = list(portions(whole, 0, 8))
    assert pa.concat_batches(cut).equals(whole)
    assert [sum(len(t or "") for t in c.column(0).to_pylist()) for c in cut] == [7, 50, 4]
