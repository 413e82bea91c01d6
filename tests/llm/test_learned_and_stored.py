"""Classifiers by held-out rows, archives by round trips, mixtures by a plain computation."""

import base64
import hashlib
import io
import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import mixture as mx
from tidemark.llm import quality_rff as q
from tidemark.llm import toxicity_ftrl as tox
from tidemark.llm import warc
from tidemark.llm.queries import QUERIES


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(("name", "label", "modulus", "out"), [("op3_quality_rff", "quality", 5, 0), ("op8_toxicity_ftrl", "toxic", 4, 2)])
def test_held_out(spark, name, label, modulus, out):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES[name](spark, folder).collect()
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == len({r.doc_id for r in rows}) == 1000
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == out) for r in rows)
    scores = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    pairs = [(a > b) + (a == b) / 2 for a, x in scores for b, y in scores if x > y]
    assert np.mean(pairs) > (0.9 if label == "quality" else 0.6)


def test_learned_from_odd_rows(spark, odd, none):
    some = labels(spark, [(i, i % 2, i % 2) for i in range(1, 13)] + [(5, 1, None), (None, 1, 1), (5, 0, 1)])
    for score in (q.score_quality, tox.score_toxicity):
        for table in (some, some.limit(0), some.filter("doc_id % 2 = 1")):
            rows = score(odd, table).collect()
            assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
        assert score(none, some).count() == 0
    kept = q.accepted(odd, some)
    assert kept.columns == odd.columns and q.accepted(none, some).count() == 0


def test_isotonic():
    x, y = q.isotonic(np.array([1.0, 2, 3, 4, 4]), np.array([0.0, 1, 0, 1, 1]))
    assert x.tolist() == [1.0, 2.5, 4.0] and y.tolist() == [0.0, 0.5, 1.0]


def test_coordinates():
    at = tox.coordinates("a b c")
    assert at[0] == 0 and len(at) == 1 + 3 + 2 + 1
    assert tox.coordinates(None).tolist() == tox.coordinates("").tolist() == [0]
    assert (tox.coordinates("One TWO") == tox.coordinates("one  two")).all()


PAGES = [
    (1, "http://a/ü x\r\nX: y", "same"), (2, "http://b/", "same"), (7, None, "same"), (3, "http://c", None), (4, "http://d", ""),
    (5, "u", "ünï 🙂\r\n\r\n"), (6, "v", "x" * 200_000), (None, "w", "same"), (None, "w", "only"), (7, "again", "same"),
]


@pytest.mark.parametrize("least", [0, 5])
def test_archives(spark, least):
    pages = spark.createDataFrame([(*p, "x", 3) for p in PAGES], "page_id long, url string, html string, sha1 string, records int")
    rows = warc.read_archives(warc.write_archives(pages, least)).collect()
    wanted = []
    for page_id, _, html in PAGES:
        data = (html or "").encode()
        same = [-1 if p is None else p for p, _, h in PAGES if (h or "") == (html or "")]
        last = max(same)
        repeats = len(data) >= least and (-1 if page_id is None else page_id) < last
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        wanted.append(repr((page_id, len(data), digest, "revisit" if repeats else "response", last if repeats else None, None if repeats else data)))
    assert sorted(repr((*tuple(r)[:5], None if r.payload is None else bytes(r.payload))) for r in rows) == sorted(wanted)
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


@pytest.mark.parametrize("dictionary", [b"", warc.train_dictionary([b"some html %d <p>text</p>" % (n * n) for n in range(2000)], 2048)])
def test_frames(dictionary):
    out = io.BytesIO()
    writer = warc.ArchiveWriter(out, dictionary)
    records = [warc.record(n, "http://x", b"<p>%d</p>" % n * 5000, warc.digest(b"<p>%d</p>" % n * 5000), None) for n in range(20)]
    for record in records:
        writer.add(record)
    data = out.getvalue()
    assert list(warc.frames(pa.BufferReader(data))) == records
    with pytest.raises(ValueError, match="cut short"):
        list(warc.frames(pa.BufferReader(data[:-5])))


@pytest.mark.parametrize(
    ("change", "message"),
    [
        (lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"), "no WARC record"),
        (lambda r: r[:-1], "another length"),
        (lambda r: r.replace(b"payload", b"pAyload"), "another digest"),
        (lambda r: r.replace(b"WARC-Date: ", b"WARC-When: "), "lacks"),
        (lambda r: r.replace(b"WARC-Date: ", b"WARC-Type: "), "repeated"),
        (lambda r: r.replace(b"Content-Length: 9", b"Content-Length: +9", 1), "another length"),
    ],
)
def test_damaged_records(change, message):
    record = warc.record(1, "http://x", b"a payload", warc.digest(b"a payload"), None)
    assert warc.page(record)["payload"] == b"a payload"
    with pytest.raises(ValueError, match=message):
        warc.page(change(record))


def test_archive_query(spark, sf_dir):
    rows = QUERIES["op5_warc"](spark, sf_dir).collect()
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in rows} == {
        i: (len(h), base64.b32encode(hashlib.sha1(h).digest()).decode()) for i, h in pages.items()
    }


def plain_fill(budget, rooms, weights):
    """Share a budget by weight, filling one child after the other."""
    given, left = {}, {k: w for k, w in weights.items() if w > 0}
    given.update({k: 0 for k in rooms if k not in left})
    while left:
        level = budget / sum(left.values())
        full = [k for k in left if rooms[k] / left[k] <= level]
        if not full:
            return given | {k: math.floor(level * w) for k, w in left.items()}
        for k in full:
            given[k] = rooms[k]
            budget -= rooms[k]
            del left[k]
    return given


def plain_mix(rows, m):
    """(id, domain, lang, source, tokens, epoch, used tokens) of rows (id, text, lang, source)."""
    docs = []
    for i, text, lang, source in rows:
        domain = "web" if source and source[-1] in "02468" else "books"
        words = [x for x in __import__("re").split("[ \t-\r]+", (text or "").strip(" ")) ]
        docs.append((-(2**63) if i is None else i, domain, lang, source, max(1, len(words))))
    supply = defaultdict(int)
    for d in docs:
        supply[d[1:4]] += d[4]
    budget = {(): math.floor(sum(supply.values()) * m.share)}
    for depth, level in enumerate(mx.LEVELS):
        weights, after = getattr(m, level), {}
        for parent, amount in budget.items():
            rooms = defaultdict(int)
            for leaf, tokens in supply.items():
                if leaf[:depth] == parent:
                    rooms[leaf[: depth + 1]] += tokens * m.epochs
            after |= plain_fill(amount, rooms, {k: weights.get(k[-1], m.other) for k in rooms})
        budget = after
    used = []
    for leaf, given in budget.items():
        own = [d for d in docs if d[1:4] == leaf]
        whole, part = divmod(given, supply[leaf])
        used += [(*d, e, d[4]) for d in own for e in range(whole)]
        place = {d: int(hashlib.md5(f"{m.seed}:{whole}:{d[0]}".encode()).hexdigest()[:10], 16) for d in own}
        before = 0
        for d in sorted(own, key=lambda d: (place[d], d[0], d[4])):
            if before < part:
                used.append((*d, whole, min(d[4], part - before)))
            before += d[4]
    return sorted(map(repr, used))


@pytest.mark.parametrize("table", ["odd", "sample"])
@pytest.mark.parametrize("mixture", [mx.DEFAULT, mx.Mixture({"web": 1, "books": 0}, {"en": 1}, {}, share=0.9, epochs=3, other=2)])
def test_mixture(request, table, mixture):
    docs = request.getfixturevalue(table)
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    found = [repr((-(2**63) if r.doc_id is None else r.doc_id, *tuple(r)[1:])) for r in mx.mix(docs, mixture).collect()]
    assert sorted(found) == plain_mix(rows, mixture)
    uses = mx.mixed(docs, mixture)
    assert uses.columns == docs.columns and uses.count() == len(found)


def test_mixture_of_nothing(none, spark, sf_dir):
    assert mx.mix(none).count() == 0 and mx.mixed(none).count() == 0
    assert QUERIES["op10_mixture"](spark, sf_dir).count() > 0


def test_pipeline(spark, sf_dir, sample, odd, none):
    import corpus_pipeline as pipeline

    assert [name for name, _ in pipeline.STAGES][0] == "quality classifier" and len(pipeline.STAGES) == 5
    docs = {r.doc_id: r.text for r in sample.collect()}
    rows = pipeline.run(spark, sf_dir).collect()
    import pyarrow as pa

    from tidemark.llm.bpe_transducer import VOCABULARY, _memory

    assert rows and {r.doc_id for r in rows} <= set(docs)
    same = [r for r in rows if bytes(r.ids) == _memory(VOCABULARY).encode(pa.array([docs[r.doc_id]]))[0].as_py()]
    assert len(same) > 0.9 * len(rows)  # the others held a secret
    for table in (odd, none):
        for _, stage in pipeline.STAGES[:-1]:
            assert stage(spark, table, sf_dir).columns == table.columns
        assert pipeline.STAGES[-1][1](spark, table, sf_dir).count() == table.count()
