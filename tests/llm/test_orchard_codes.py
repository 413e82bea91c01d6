import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm.orchard_codes import Neighbours, compress, exact_kind
from tidemark.llm.queries import QUERIES
from tests.llm.tests_llm_rows import collected

ROWS = "vec_id long, embedding array<float>, label int, code string, vector string, of int, part int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "v", 1, 2) for r in rows], ROWS)


def wanted(rows, entries=256, rounds=4):
    """Rows (id, vector, label) coded with Python's whole numbers, every entry compared."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(1024 * x) for x in np.array(v, np.float32).astype(float).tolist()] for _, v, _ in kept]
    width = len(whole[0]) // 4
    cut = [[v[p * width : (p + 1) * width] for v in whole] for p in range(4)]
    books = [[list(q) for q in part[:entries]] for part in cut]

    def nearest(part, book):
        return [min((sum((x - y) ** 2 for x, y in zip(q, m)), e) for e, m in enumerate(book)) for q in part]

    for _ in range(rounds):
        for p in range(4):
            chosen = [e for _, e in nearest(cut[p], books[p])]
            for e in set(chosen):
                own = [q for q, c in zip(cut[p], chosen) if c == e]
                books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    found = [nearest(cut[p], books[p]) for p in range(4)]
    errors = [sum(f[n][0] for f in found) for n in range(len(kept))]
    totals = {}
    for (_, _, label), error in zip(kept, errors):
        totals[label] = totals.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(x) for b in books for m in b for x in m).encode()).hexdigest()
    return sorted(
        ((i, "".join(f"{f[n][1]:02x}" for f in found), errors[n], totals[label]) for n, (i, _, label) in enumerate(kept)),
        key=repr,
    ), sha


def test_codes_of_odd_rows(spark):
    rng = random.Random(2)
    grid = [-1.5, -0.25, 0.0, 0.1, 0.7, 2.0]  # few values: ties between entries
    rows = [(rng.randint(0, 300), [rng.choice(grid) for _ in range(8)], rng.choice([None, 1, 2])) for _ in range(400)]
    rows += [rows[0], rows[0], (None, [0.3] * 8, 1), (None, [-0.3] * 8, None), (1, None, 1), (2, [None] * 8, 1)]
    rows += [(3, [float("nan")] * 8, 1), (4, [float("inf")] + [0.0] * 7, 2), (900, [0.0] * 8, 7)]
    codes, books = compress(frame(spark, rows))
    found, sha = wanted(rows)
    assert collected(codes) == found
    assert books.sha256 == sha


def test_fewer_rows_than_entries(spark):
    rows = [(i, [i / 7.0, -i / 3.0, 0.0, 1.0], None) for i in range(5)] + [(2, [9.0, 9.0, 9.0, 9.0], 1)]
    codes, books = compress(frame(spark, rows))
    found, sha = wanted(rows)
    assert collected(codes) == found
    assert books.sha256 == sha and len(books.parts[0]) == 6


def test_large_components_are_exact(spark):
    rows = [(i, [x * 3.0e4 for x in (i, -i, i % 7, 1)], i % 2) for i in range(300)]
    codes, books = compress(frame(spark, rows))
    found, sha = wanted(rows)
    assert collected(codes) == found and books.sha256 == sha
    huge, _ = compress(frame(spark, [(1, [3.0e38, 0.0, 0.0, 0.0], 1), (2, [-3.0e38, 0.0, 0.0, 0.0], 1)]))
    assert [r.code for r in huge.orderBy("vec_id").collect()] == ["00000000", "01000000"]


def test_other_lengths_and_empty_tables(spark):
    rows = [(1, [0.5] * 4, 1), (2, [0.5] * 8, 1), (3, [], 1), (4, [0.75] * 4, 1)]
    codes, _ = compress(frame(spark, rows))
    got = {r.vec_id: (r.code, r.error, r.label_error) for r in codes.collect()}
    assert got == {1: ("00000000", 0, 0), 2: (None, None, 0), 3: (None, None, 0), 4: ("01010101", 0, 0)}
    nothing, books = compress(frame(spark, [(1, None, 1)]))
    assert nothing.collect() == [] and books is None
    empties, _ = compress(frame(spark, [(1, [], 1), (2, [], None)]))
    assert collected(empties) == [(1, "00000000", 0, 0), (2, "00000000", 0, 0)]


@pytest.mark.parametrize("entries", [1, 2, 17, 256])
@pytest.mark.parametrize("kind", [np.float64, np.int64, object])
def test_search_finds_the_nearest(entries, kind):
    rng = np.random.default_rng(entries)
    centres = rng.integers(-900, 900, (12, 6))
    book = (centres[rng.integers(0, 12, entries)] + rng.integers(-9, 9, (entries, 6))).astype(kind)
    queries = (centres[rng.integers(0, 12, 700)] + rng.integers(-20, 20, (700, 6))).astype(kind)
    entry, distance = Neighbours(book).search(queries)
    apart = queries.astype(np.int64)[:, None, :] - book.astype(np.int64)[None, :, :]
    squared = (apart**2).sum(axis=2)
    assert entry.tolist() == squared.argmin(axis=1).tolist()
    assert [int(d) for d in distance] == squared.min(axis=1).tolist()


def test_search_stops_before_it_has_seen_all():
    class Counting(Neighbours):
        seen = 0

        def _squared(self, queries, entry):
            self.seen += len(entry)
            return super()._squared(queries, entry)

    rng = np.random.default_rng(1)
    centres = rng.integers(-100_000, 100_000, (32, 8))
    book = (centres.repeat(8, axis=0) + rng.integers(-50, 50, (256, 8))).astype(float)
    queries = (centres[rng.integers(0, 32, 500)] + rng.integers(-50, 50, (500, 8))).astype(float)
    found = Counting(book)
    found.search(queries)
    assert found.seen < 256 * 500 / 3


def test_kinds_hold_their_distances():
    for largest, width in ((1000, 16), (1 << 22, 64), (1 << 28, 16), (1 << 50, 16)):
        kind = exact_kind(largest, width)
        value = kind(4 * largest * largest * width) if kind is not object else 4 * largest * largest * width
        assert int(value) == 4 * largest * largest * width


def test_query_gives_brute_force_rows(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    found, sha = wanted([(r.vec_id, list(r.embedding), r.label) for r in table])
    got = QUERIES["op13_vector_codes"](spark, sf_dir)
    assert collected(got.select("vec_id", "code", "error", "label_error")) == found
    assert {r.codebooks_sha256 for r in got.select("codebooks_sha256").collect()} == {sha}
