"""Web pages in WARC archives compressed with Zstandard, written and read back.

An archive begins with a skippable frame that holds the dictionary all its other frames need. Each
further frame holds exactly one record, so a reader needs the memory of one record and can start at
any frame. Pages with equal payloads are stored once: the others are revisit records, whose block
holds the HTTP header alone and which name the record they repeat.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import NativeFile
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.files import new_file, open_file
from tidemark.llm.tables import given_id, known_id, stored
from tidemark.session import shared_folder

#: Payloads shorter than this are always stored.
MIN_BYTES = 0
#: The dictionary is trained on so many pages at most, of each so many characters.
SAMPLE_PAGES, SAMPLE_CHARACTERS, DICTIONARY_BYTES = 1000, 16_000, 65_536
ARCHIVE_BYTES = 256_000_000
LEVEL = 3
DATE = "2026-01-01T00:00:00Z"

# Fixed values of the WARC and Zstandard formats.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"

_RECORD_ID = "<urn:tidemark:page:{}>"
_PAGE = re.compile(r"<urn:tidemark:page:(-?\d+)>")
_READ = 1 << 16


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary, or nothing where the samples are too few or too alike to make one."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def record(page_id: int, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, which leaves the payload out."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _RECORD_ID.format(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="".join(map(chr, range(0x21, 0x7F))))))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _RECORD_ID.format(refers_to))]
    head = b"".join(f"{name}: {value}\r\n".encode() for name, value in fields)
    return b"%s\r\n%s\r\n%s\r\n\r\n" % (VERSION, head, block)


class ArchiveWriter:
    def __init__(self, out: NativeFile, dictionary: bytes):
        self.out, self.records, self.size = out, 0, 0
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True).compress
        if dictionary:
            self._write(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)

    def add(self, data: bytes) -> None:
        self._write(self.compress(data))
        self.records += 1

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)


def frames(source: NativeFile) -> Iterator[bytes]:
    """The content of each frame after the dictionary; what is read ahead is bounded."""
    held = source.read(8)
    decompressor = zstandard.ZstdDecompressor()
    if len(held) == 8 and struct.unpack("<I", held[:4])[0] == SKIPPABLE:
        size = struct.unpack("<I", held[4:])[0]
        dictionary, held = source.read(size), b""
        if len(dictionary) != size:
            raise ValueError("the dictionary is cut short")
        if dictionary[:4] == FRAME:  # it may be compressed itself
            dictionary = decompressor.decompress(dictionary)
        decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    while held or (held := source.read(_READ)):
        frame, parts = decompressor.decompressobj(), []
        while True:
            parts.append(frame.decompress(held))
            if frame.eof:
                held = frame.unused_data
                break
            held = source.read(_READ)
            if not held:
                raise ValueError("the last frame is cut short")
        yield b"".join(parts)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of a record, with its lengths and digest checked."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] != VERSION:
        raise ValueError(f"no WARC record: {data[:40]!r}")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon or not name.strip() or name.strip().lower() in fields:
            raise ValueError(f"bad or repeated header field: {line!r}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"the record lacks {name}")
    length = fields["content-length"]
    if not length.isascii() or not length.isdigit() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError(f"the block has another length than {length!r}")
    block = rest[:-4]
    if fields.get("warc-block-digest") not in (None, f"sha1:{digest(block)}"):
        raise ValueError("the block has another digest")
    return fields, block


def page(data: bytes) -> dict:
    """Columns of one record of this module's archives, with the payload checked."""
    fields, block = parse(data)
    http, found, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length: *(\d+)\r?$", http)
    named = _PAGE.fullmatch(fields["warc-record-id"])
    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if not found or not length or not named:
        raise ValueError(f"no page record: {fields['warc-record-id']}")
    size, revisit, refers_to = int(length[1]), fields["warc-type"] == "revisit", None
    if revisit:
        original = _PAGE.fullmatch(fields.get("warc-refers-to", ""))
        if fields.get("warc-profile") != PROFILE or not original or payload:
            raise ValueError("a revisit needs its profile, the record it repeats, and no payload")
        refers_to = int(original[1])
    elif fields["warc-type"] != "response" or len(payload) != size or digest(payload) != stated:
        raise ValueError("the payload has another length or digest")
    return {
        "page_id": int(named[1]), "payload_bytes": size, "payload_digest": stated,
        "record_type": fields["warc-type"], "refers_to": refers_to, "payload": None if revisit else payload,
    }


def _sample(rows: DataFrame) -> DataFrame:
    """``begin``: the first ``SAMPLE_CHARACTERS`` of about ``SAMPLE_PAGES`` pages, picked by a hash of the whole row.

    A share of the hashes is taken, and equal rows count once, so each task passes on its share of a
    bounded sample, however many pages there are and however often one is repeated.
    """
    share = int(min(1.0, SAMPLE_PAGES / max(1, rows.count())) * (1 << 32))
    picked = F.xxhash64("page_id", "url", "html", F.lit("sample"))
    begins = rows.select(picked.alias("picked"), F.substring("html", 1, SAMPLE_CHARACTERS).alias("begin"))
    return begins.filter(F.pmod("picked", F.lit(1 << 32)) < share).dropDuplicates(["picked"]).orderBy("picked").select("begin")


def write_archives(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write a record for every row of ``pages`` (page_id, url, html); returns ``path``, ``records`` per archive.

    Of equal payloads of at least ``min_bytes`` bytes the largest page_id is stored, in all of its
    rows, and the others revisit it. A null html counts as empty, a missing page_id as the smallest;
    a null url is left out. Repeated rows repeat their record. An empty table gives no archive.
    """
    folder = shared_folder(pages.sparkSession, "archives")
    rows = pages.select(
        known_id("page_id").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    samples = [r["begin"].encode() for r in _sample(rows).collect()]
    dictionary = train_dictionary([s for s in samples if s])
    sums = rows.withColumn("sha1", F.sha1("html"))
    # The length is part of the key only to say which payloads may be left out.
    last = (
        sums.filter(F.octet_length("html") >= min_bytes).groupBy("sha1").agg(F.max("page_id").alias("stored_id"))
    )
    joined = sums.join(last, "sha1", "left").select(
        "page_id", "url", "html", "sha1", F.when(F.col("page_id") < F.col("stored_id"), F.col("stored_id")).alias("refers_to")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = path = None

        def done() -> pa.RecordBatch:
            writer.out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [writer.records]})

        for batch in batches:
            for page_id, url, html, sha1, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if writer is None:
                    path, out = new_file(folder, "pages")
                    writer = ArchiveWriter(out, dictionary)
                named = base64.b32encode(bytes.fromhex(sha1)).decode()
                writer.add(record(page_id, url, html.encode(), named, refers_to))
                if writer.size >= ARCHIVE_BYTES:
                    yield done()
                    writer = None
        if writer is not None:
            yield done()

    return stored(joined.mapInArrow(write, "path string, records long"), "archive-list")


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Per record: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``payload``.

    The payload is null for a revisit, and everywhere without ``payloads``. Every header, length and
    digest is checked; a damaged archive fails the job.
    """
    kinds = (
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    )

    def table(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, pa.schema(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with open_file(path) as source:
                    for data in frames(source):
                        rows.append(page(data))
                        held += len(data)
                        if not payloads:
                            rows[-1]["payload"] = None
                        if held > 8_000_000:
                            yield table(rows)
                            rows, held = [], 0
                if rows:
                    yield table(rows)

    # A task reads one archive; the rows that name them are too small for adaptive sizing.
    spread = archives.select("path").repartition(max(1, archives.count()))
    found = spread.mapInArrow(
        run,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary",
    )
    return found.withColumn("page_id", given_id(F.col("page_id"))).withColumn("refers_to", given_id(F.col("refers_to")))
