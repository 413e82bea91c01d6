"""Cutting texts into the pieces that byte-level vocabularies merge within, with a bounded memory.

A piece is a match of the vocabulary's pattern. White space always starts a piece or is one, so a text
may be cut before a space and around a line break without looking at the neighbours, unless more than
two white characters follow each other there, or two end the text. It may also be cut before the last mark of a
word, if a letter or a digit comes before it. Arrow cuts the texts of a batch, numbers the distinct units
and puts their ids together; only distinct units are handled one by one, and those seen before
are remembered.
"""

from __future__ import annotations

import gc
import struct
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: ``\s`` is the Unicode property; Python's own class has four control characters more.
PIECE = regex.compile(public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
UNIT = regex.compile(r"\p{White_Space}*\P{White_Space}+|\p{White_Space}+")

#: The characters of the Unicode property White_Space, for Arrow's expressions, which lack it (fixed values).
_WHITE = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: Marks the cuts; texts that hold it, or runs of white space that must not be cut, are cut by ``UNIT``.
_CUT = "\x01"
_LAST_MARK = r"([\pL\pN])([.,;:!?])(" + _CUT + r"|\z)"
_BY_UNIT = _CUT + "|" + _WHITE + "{3}|" + _WHITE + r"{2}\z"

#: Bytes of remembered units and their ids, by an estimate. Long ones are not kept.
REMEMBERED_BYTES = 160_000_000
REMEMBERED_LENGTH = 200
#: What a remembered unit takes besides its characters and ids.
_ENTRY_BYTES = 150


def pack_ids(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


@contextmanager
def uncollected() -> Iterator[None]:
    """Without the cycle collector, which would go through all that is remembered again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        gc.freeze()
        if was:
            gc.enable()


class PieceMemory:
    """Encodes texts by ``encode_pieces``, which gives the id bytes of each of some pieces."""

    def __init__(self, encode_pieces: Callable[[list[str]], Iterable[bytes]], limit: int = REMEMBERED_BYTES):
        self.encode_pieces = encode_pieces
        self.limit = limit
        # Two generations: when the young one is full it becomes the old one, which is forgotten but for what is met again.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def encode(self, texts: pa.Array) -> pa.Array:
        """Id bytes of each text of an array of strings without nulls."""
        if not len(texts):
            return pa.array([], pa.binary())
        with uncollected():
            return self._encode(texts.cast(pa.string()))

    def _encode(self, texts: pa.Array) -> pa.Array:
        by_unit = pc.match_substring_regex(texts, _BY_UNIT)
        if not pc.any(by_unit).as_py():
            return self._by_cuts(texts)
        cut = by_unit.to_numpy(zero_copy_only=False)
        apart = np.flatnonzero(cut)
        out = np.empty(len(texts), object)
        if len(apart) < len(texts):
            out[~cut] = self._by_cuts(texts.filter(pa.array(~cut))).to_pylist()
        for n in apart.tolist():
            units = UNIT.findall(texts[n].as_py())
            ids = self._ids(list(dict.fromkeys(units)))
            out[n] = b"".join(map(ids.__getitem__, units))
        return pa.array(out, pa.binary())

    def _by_cuts(self, texts: pa.Array) -> pa.Array:
        marked = pc.replace_substring(pc.replace_substring(texts, " ", _CUT + " "), "\n", _CUT + "\n" + _CUT)
        units = pc.split_pattern(pc.replace_substring_regex(marked, _LAST_MARK, r"\1" + _CUT + r"\2\3"), _CUT)
        numbered = units.flatten().dictionary_encode()
        distinct = numbered.dictionary.to_pylist()
        ids = list(map(self._ids(distinct).__getitem__, distinct))
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        listed = pa.LargeListArray.from_arrays(
            np.concatenate([[0], np.cumsum(lengths)]), pa.array(np.frombuffer(b"".join(ids), "<u4"))
        ).take(numbered.indices)
        # The ids of a text are those of its units, which follow each other.
        ends = listed.offsets.to_numpy()[units.offsets.to_numpy() - units.offsets[0].as_py()]
        values = listed.values.to_numpy()[ends[0] : ends[-1]]
        offsets = ((ends - ends[0]) * 4).astype(np.int64)
        buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(values))]
        return pa.Array.from_buffers(pa.large_binary(), len(texts), buffers).cast(pa.binary())

    def _ids(self, units: list[str]) -> dict[str, bytes]:
        """Ids of these units."""
        found = self._remembered(units)
        new = [unit for unit in units if unit not in found]
        if not new:
            return found
        # Letters alone are one piece, also after a space.
        cut = {u: (u,) if u.isalpha() or (u[:1] == " " and u[1:].isalpha()) else PIECE.findall(u) for u in new}
        pieces = list(dict.fromkeys(piece for parts in cut.values() for piece in parts))
        ids = self._remembered(pieces)
        fresh = [piece for piece in pieces if piece not in ids]
        ids.update(zip(fresh, self.encode_pieces(fresh), strict=True))
        # A piece is a unit of one piece.
        found.update((u, ids[p[0]] if len(p) == 1 else b"".join(map(ids.__getitem__, p))) for u, p in cut.items())
        self._remember((u, found[u]) for u in new)
        return found

    def _remembered(self, units: list[str]) -> dict[str, bytes]:
        young, old = self.young, self.old
        found = {u: young[u] for u in units if u in young}
        if len(found) < len(units) and old:
            again = {u: old[u] for u in units if u in old and u not in found}
            self._remember(again.items())
            found |= again
        return found

    def _remember(self, entries: Iterable[tuple[str, bytes]]) -> None:
        for unit, ids in entries:
            if len(unit) <= REMEMBERED_LENGTH:
                self.young[unit] = ids
                self.held += len(unit) + len(ids) + _ENTRY_BYTES
                if self.held > self.limit // 2:
                    self.old, self.young, self.held = self.young, {}, 0
