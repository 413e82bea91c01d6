"""Token ids in binary files of fixed-width bit packing.

A file holds documents in ascending id order. Every id takes as many bits as the largest id of the
vocabulary needs, lowest bit first. Ids are packed in blocks of ``BLOCK``; a block begins at a byte,
and the table of block offsets gives the place of any id, so a range of ids is read by fetching its
blocks and unpacking them with numpy.

Layout, little-endian: the blocks; block offsets (u64 each, one more than blocks); document ids (i64);
place of each document's first id (u64, one more than documents); the trailer ``TRAILER``. It stands
at the end because streams of object stores can only be appended to.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import NativeFile
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.files import new_file, open_file
from tidemark.llm.pieces import PieceMemory, pack_ids
from tidemark.llm.tables import given_id, joined, known_id, portions, stored
from tidemark.session import shared_folder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
#: Bytes of units that a worker remembers: more than elsewhere, as this job holds little else.
REMEMBERED_BYTES = 240_000_000
#: Documents of a file, until their square root is more.
DOCUMENTS = 4_000
#: Bytes of texts that are cut together: the more, the fewer distinct units for each.
CUT_TOGETHER = 8_000_000
BLOCK = 4096
MAGIC = b"TMTOKENS"
#: magic, bits of an id, ids per block, documents, ids, bytes of the tables
TRAILER = struct.Struct("<8sHIQQQ")


def bits_for(vocabulary_size: int) -> int:
    return max(1, (vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as ``bits`` bits each, lowest bit first; the last byte is filled with zeros."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    """The first ``count`` ids of packed bytes."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    place = np.arange(count, dtype=np.int64) * bits
    padded = np.frombuffer(data + bytes(8), np.uint8)
    byte, shift = place >> 3, (place & 7).astype(np.uint64)
    word = np.zeros(count, np.uint64)
    for k in range((bits + 14) // 8):
        word |= padded[byte + k].astype(np.uint64) << np.uint64(8 * k)
    return ((word >> shift) & np.uint64((1 << bits) - 1)).astype(np.uint32)


class TokenWriter:
    """Writes one file; holds one block, and the tables of the documents written so far."""

    def __init__(self, out: NativeFile, bits: int):
        self.out, self.bits = out, bits
        self.offsets, self.doc_ids, self.starts = [0], [], [0]
        self.held: list[np.ndarray] = []
        self.waiting = 0

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(self.starts[-1] + len(ids))
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BLOCK:
            ids = np.concatenate(self.held)
            whole = len(ids) // BLOCK * BLOCK
            for start in range(0, whole, BLOCK):
                self._block(ids[start : start + BLOCK])
            self.held, self.waiting = [ids[whole:]], len(ids) - whole

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.out.write(data)
        self.offsets.append(self.offsets[-1] + len(data))

    def close(self) -> None:
        if self.waiting:
            self._block(np.concatenate(self.held))
        tables = ((self.offsets, "<u8"), (self.doc_ids, "<i8"), (self.starts, "<u8"))
        raw = b"".join(np.array(values, kind).tobytes() for values, kind in tables)
        self.out.write(raw)
        self.out.write(TRAILER.pack(MAGIC, self.bits, BLOCK, len(self.doc_ids), self.starts[-1], len(raw)))
        self.out.close()


class TokenReader:
    """Random access to a file of token ids."""

    def __init__(self, source: NativeFile):
        self.source = source
        size = source.size()
        head = source.read_at(TRAILER.size, size - TRAILER.size)
        magic, self.bits, self.block, docs, self.ids, tables = TRAILER.unpack(head)
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        blocks = -(-self.ids // self.block)
        raw = source.read_at(tables, size - TRAILER.size - tables)
        if len(raw) != 8 * (blocks + 1 + docs + docs + 1):
            raise ValueError("the file's tables are cut short")
        self.offsets = np.frombuffer(raw, "<u8", blocks + 1).astype(np.int64)
        self.doc_ids = np.frombuffer(raw, "<i8", docs, 8 * (blocks + 1))
        self.starts = np.frombuffer(raw, "<u8", docs + 1, 8 * (blocks + 1 + docs)).astype(np.int64)

    def read(self, first: int, last: int) -> np.ndarray:
        """Ids from place ``first`` up to ``last``, from the blocks that hold them."""
        if last <= first:
            return np.zeros(0, np.uint32)
        low, high = first // self.block, -(-last // self.block)
        raw = self.source.read_at(int(self.offsets[high] - self.offsets[low]), int(self.offsets[low]))
        parts = []
        for block in range(low, high):
            begin = int(self.offsets[block] - self.offsets[low])
            end = int(self.offsets[block + 1] - self.offsets[low])
            count = min(self.block, self.ids - block * self.block)
            parts.append(unpack(raw[begin:end], count, self.bits))
        return np.concatenate(parts)[first - low * self.block : last - low * self.block]

    def documents(self, first: int, last: int) -> list[bytes]:
        """Ids of documents that follow each other, as little-endian unsigned 32-bit integers, from one read."""
        begin = int(self.starts[first])
        data = self.read(begin, int(self.starts[last])).astype("<u4").tobytes()
        ends = (4 * (self.starts[first : last + 1] - begin)).tolist()
        return [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def document(self, number: int) -> np.ndarray:
        return self.read(int(self.starts[number]), int(self.starts[number + 1]))


class TextEncoder:
    """Encodes texts as the vocabulary's library does, by remembered pieces.

    The library cuts a text at the strings of added tokens before anything else, so a text that
    holds one is encoded by it whole.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.memory = PieceMemory(self._encode, REMEMBERED_BYTES)

    def _encode(self, pieces: list[str]) -> Iterator[bytes]:
        for start in range(0, len(pieces), 10_000):
            some = pieces[start : start + 10_000]
            found = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            counts = np.bincount(np.array(found.word_ids, np.int64), minlength=len(some))
            data, begin = np.array(found.ids, "<u4").tobytes(), 0
            for end in (4 * np.cumsum(counts)).tolist():
                yield data[begin:end]
                begin = end

    def encode(self, texts: pa.Array) -> pa.Array:
        """Id bytes of each text of an array of strings without nulls."""
        whole = np.zeros(len(texts), bool)
        for token in self.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self.memory.encode(texts)
        ids = np.empty(len(texts), object)
        ids[~whole] = self.memory.encode(texts.filter(pa.array(~whole))).to_pylist()
        for n in np.flatnonzero(whole).tolist():  # one at a time: they may be long
            ids[n] = pack_ids(self.tokenizer.encode(texts[n].as_py(), add_special_tokens=False).ids)
        return pa.array(ids, pa.binary())


@lru_cache(maxsize=1)
def _encoder(path: str) -> TextEncoder:
    """Of a worker process, kept from task to task."""
    return TextEncoder(path)


def write_token_files(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Write the ids of all documents, each followed by ``end_id``; returns one row per file.

    ``part`` (ascending with the ids inside), ``path``, ``documents``, ``ids``. Equal ids are ordered
    by a hash of their texts, and may be spread over files. The string of an added token, such as ``<|endoftext|>``, has that
    token's id, as in the library. A null text counts as empty, a missing id as the smallest; repeated
    rows stay. A file has about ``DOCUMENTS`` documents, or as many as there are files, whichever is
    more. ``vocabulary`` is a file that every executor can open.
    """
    folder = shared_folder(docs.sparkSession, "token-files")
    rows = docs.select(known_id(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    count = rows.count()
    files = max(1, min(math.isqrt(count), count // DOCUMENTS))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer = _encoder(vocabulary), None
        end = np.array([end_id], "<u4")
        for batch in joined(batches, 2, CUT_TOGETHER):
            for some in portions(batch, 2, CUT_TOGETHER):
                if writer is None:
                    number = some.column(0)[0].as_py()
                    path, out = new_file(folder, f"part-{number:09d}")
                    writer = TokenWriter(out, bits_for(max(encoder.size, end_id + 1)))
                ids = encoder.encode(some.column(2).fill_null(""))
                for doc_id, data in zip(some.column(1).to_pylist(), ids, strict=True):
                    writer.add(doc_id, np.concatenate([np.frombuffer(data.as_buffer(), "<u4"), end]))
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {"part": [number], "path": [path], "documents": [len(writer.doc_ids)], "ids": [writer.starts[-1]]}
            )

    # Rows that share an id, or even their text, may be many: the row's number lets them be spread, too.
    keyed = rows.withColumn("content", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = ("doc_id", "content", "row")
    ordered = keyed.repartitionByRange(files, *order).sortWithinPartitions(*order)
    numbered = ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    return stored(numbered.mapInArrow(write, "part long, path string, documents long, ids long"), "token-manifest")


def read_token_files(files: DataFrame) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start``, ``n_tokens``, ``ids`` (unsigned 32-bit, little-endian)."""
    before = F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = files.select("path", before.alias("start"))
    # A task reads a few files; the rows that name them are too small for adaptive sizing.
    tasks = max(1, files.count() // 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open_file(path) as source:
                    reader = TokenReader(source)
                    for low in range(0, len(reader.doc_ids), 200):
                        high = min(low + 200, len(reader.doc_ids))
                        ids = reader.documents(low, high)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(reader.doc_ids[low:high]),
                                pa.array(reader.starts[low:high] + start),
                                pa.array(np.diff(reader.starts[low : high + 1])),
                                pa.array(ids, pa.binary()),
                            ],
                            ["doc_id", "start", "n_tokens", "ids"],
                        )

    found = starts.repartition(tasks).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
    return found.withColumn("doc_id", given_id(F.col("doc_id")))
