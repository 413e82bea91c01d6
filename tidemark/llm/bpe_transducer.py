"""Byte-level BPE as a finite-state transducer, and streaming decoding.

**Encoding.** A sequence of tokens is what the merges make of its bytes exactly if every two
neighbours stay apart when merged on their own. So the encodings of all prefixes of a text can be
followed at once: an item is a sequence of tokens not yet certain, and a node in the trie of token
bytes that is being read. A state is the last certain token and the set of its items, with the
tokens that all items share taken out and emitted: the determinisation of a transducer. States are
made when first reached and kept up to a bound, after which all are forgotten and made anew. An item
dies when the trie ends, so tokens are emitted after a lookahead bounded by the vocabulary's
longest token. The time per byte does not depend on the length of a piece.
(Berglund and van der Merwe, "Formalizing BPE Tokenization", 2023; Mohri, "Finite-State Transducers
in Language and Speech Processing", 1997.)

**Decoding.** Bytes of ids are decoded as they come; the state kept between steps is the incomplete
character at their end.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pieces import PieceMemory, pack_ids
from tidemark.llm.tables import joined, portions

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
STATES = 100_000
#: Bytes of texts that are cut together: the more, the fewer distinct units for each.
CUT_TOGETHER = 8_000_000
#: Ids turned to bytes at once when decoding.
CHUNK = 1 << 15

_START = -1
_NEVER = float("inf")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class _State:
    __slots__ = ("last", "items", "moves", "final")

    def __init__(self, last: int, items: tuple):
        self.last, self.items = last, items
        self.moves: dict[int, tuple[tuple[int, ...], _State]] = {}
        self.final = items[-1][0]  # the item that has ended a token stands last


class Transducer:
    """Compiled from ``ranks`` (token bytes to rank); ``encode`` gives the ids of one piece."""

    def __init__(self, ranks: dict[bytes, int], states: int = STATES):
        self.ranks = ranks
        self.limit = states
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        # Per node of the trie and byte: the next node (0 if no token goes on) and the token that ends there.
        self.trie: list[dict[int, tuple[int, int]]] = [{}]
        for token in sorted(ranks):
            node = 0
            for byte in token[:-1]:
                after, ends = self.trie[node].get(byte, (0, _START))
                if not after:
                    after = len(self.trie)
                    self.trie.append({})
                    self.trie[node][byte] = (after, ends)
                node = after
            self.trie[node][token[-1]] = (self.trie[node].get(token[-1], (0, _START))[0], ranks[token])
        self.left: dict[int, list[tuple[int, float, float]]] = {}
        self.right: dict[int, list[tuple[int, float, float]]] = {}
        self.apart: dict[tuple[int, int], bool] = {}
        self.states: dict[tuple, _State] = {}
        self._begin()

    def _begin(self) -> None:
        for state in self.states.values():  # states refer to each other
            state.moves.clear()
        self.states = {}
        self.start = self._state(_START, (((), 0),))

    def _state(self, last: int, items: tuple) -> _State:
        key = (last, items)
        if key not in self.states:
            self.states[key] = _State(last, items)
        return self.states[key]

    def encode(self, piece: bytes) -> list[int]:
        if len(self.states) > self.limit:
            self.apart.clear()
            self._begin()
        state, out = self.start, []
        for byte in piece:
            move = state.moves.get(byte) or self._move(state, byte)
            emitted, state = move
            if emitted:
                out += emitted
        out += state.final
        return out

    def _move(self, state: _State, byte: int) -> tuple[tuple[int, ...], _State]:
        trie, apart = self.trie, self.apart
        reading, ended = [], None
        for pending, node in state.items:
            step = trie[node].get(byte)
            if step is None:
                continue
            after, token = step
            if after:
                reading.append((pending, after))
            if ended is None and token != _START:  # a prefix has one encoding: one item at most ends a token here
                pair = (pending[-1] if pending else state.last, token)
                if pair not in apart:
                    apart[pair] = pair[0] == _START or not self._merge_across(*pair)
                if apart[pair]:
                    ended = (*pending, token)
        if ended is None:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        shared = len(ended)
        for pending, _ in reading:
            shared = min(shared, len(pending))
            while pending[:shared] != ended[:shared]:
                shared -= 1
        emitted = ended[:shared]
        if shared:
            reading = [(pending[shared:], node) for pending, node in reading]
        after = self._state(emitted[-1] if emitted else state.last, (*reading, (ended[shared:], 0)))
        state.moves[byte] = move = (emitted, after)
        return move

    def _merge_across(self, a: int, b: int) -> bool:
        """Whether some part at the end of ``a`` meets one at the start of ``b`` and is merged with it.

        A part exists from the merge that makes it to the merge that takes it up. Equal merges are
        done from the left, so one inside ``a`` goes before one across, which goes before one in ``b``.
        """
        for x, x_from, x_until in self._edge(self.right, a, -1):
            for y, y_from, y_until in self._edge(self.left, b, 0):
                rank = self.ranks.get(self.token_bytes[x] + self.token_bytes[y])
                if rank is None:
                    continue
                when = max(rank, x_from, y_from)
                if when < x_until and (when < y_until or when == rank == y_until):
                    return True
        return False

    def _edge(self, known: dict, token: int, end: int) -> list[tuple[int, float, float]]:
        """(part, made, taken up) of the parts that are the first (0) or last (-1) of a token in turn."""
        if token not in known:
            parts, until = [], _NEVER
            part = token
            while True:
                halves = self._halves(part)
                made = part if halves else -1
                parts.append((part, made, until))
                if not halves:
                    break
                part, until = halves[end], part
            known[token] = parts
        return known[token]

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes a token; None for a single byte."""
        data = self.token_bytes[token]
        if len(data) == 1:
            return None
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 2:
            ranks = [self.ranks.get(parts[i] + parts[i + 1], _NEVER) for i in range(len(parts) - 1)]
            i = ranks.index(min(ranks))
            if ranks[i] is _NEVER:
                raise ValueError(f"token {token} cannot be made by merges")
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]


class Utf8Machine:
    """Text of bytes that come in any portions; invalid bytes become replacement characters."""

    def __init__(self) -> None:
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        keep = self._open(data)
        self.held = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def finish(self) -> str:
        held, self.held = self.held, b""
        return held.decode("utf-8", "replace")

    @staticmethod
    def _open(data: bytes) -> int:
        """Bytes at the end that begin a character and wait for more."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:  # inside a character; its first byte is further back
                continue
            wanted = 2 if 0xC2 <= byte < 0xE0 else 3 if 0xE0 <= byte < 0xF0 else 4 if 0xF0 <= byte < 0xF5 else 1
            if back >= wanted:
                return 0
            if back > 1:  # the second byte's range depends on the first
                low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
                high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)
                if not low <= data[-back + 1] <= high:
                    return 0
            return back
        return 0


def decode_stream(ids: Iterable[np.ndarray], token_bytes: list[bytes]) -> Iterator[str]:
    """Text of ids that come in portions, as far as it is certain after each."""
    machine = Utf8Machine()
    for portion in ids:
        yield machine.feed(b"".join(map(token_bytes.__getitem__, portion.tolist())))
    yield machine.finish()


@lru_cache(maxsize=2)
def _memory(path: str) -> PieceMemory:
    """Of a worker process, kept from task to task."""
    transducer = Transducer(read_ranks(path))

    def encode(pieces: list[str]) -> Iterator[bytes]:
        for piece in pieces:
            yield pack_ids(transducer.encode(piece.encode("utf-8")))

    return PieceMemory(encode)


@lru_cache(maxsize=2)
def _token_bytes(path: str) -> list[bytes]:
    ranks = read_ranks(path)
    listed = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        listed[rank] = token
    return listed


def encoded(
    docs: DataFrame, vocabulary: str = VOCABULARY, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers) per row of ``docs``.

    A null text counts as empty and has no ids; a null id stays null; repeated rows stay; an empty
    table gives an empty result. Columns other than the two are not read. ``vocabulary`` is a file of
    ranks that every executor can open.
    """

    return _texts(docs, id_column, text_column).mapInArrow(
        lambda batches: _encode(batches, vocabulary), "doc_id long, n_tokens long, ids binary"
    )


def decoded(encodings: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``encodings`` (doc_id, n_tokens, ids) with the ``text`` of the ids; null ids count as none."""
    return encodings.select("doc_id", "n_tokens", "ids").mapInArrow(
        lambda batches: _decode(batches, vocabulary), "doc_id long, n_tokens long, ids binary, text string"
    )


def round_trip(
    docs: DataFrame, vocabulary: str = VOCABULARY, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """What ``decoded(encoded(docs))`` gives, with both steps in the same worker."""
    return _texts(docs, id_column, text_column).mapInArrow(
        lambda batches: _decode(_encode(batches, vocabulary), vocabulary),
        "doc_id long, n_tokens long, ids binary, text string",
    )


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def _encode(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    memory = _memory(vocabulary)
    for batch in joined(batches, 1, CUT_TOGETHER):
        for part in portions(batch, 1, CUT_TOGETHER):
            ids = memory.encode(part.column(1).fill_null(""))
            counts = pc.divide(pc.binary_length(ids), 4).cast(pa.int64())
            yield from portions(
                pa.RecordBatch.from_arrays([part.column(0), counts, ids], ["doc_id", "n_tokens", "ids"]), 2
            )


def _decode(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    token_bytes = _token_bytes(vocabulary)
    for batch in batches:
        texts = []
        for data in batch.column(2).to_pylist():
            ids = np.frombuffer(data or b"", "<u4")
            parts = (ids[i : i + CHUNK] for i in range(0, len(ids), CHUNK))
            texts.append("".join(decode_stream(parts, token_bytes)))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids", "text"]
        )
