"""Near-duplicates of documents and vectors against brute force."""

import math
import random
import re

import numpy as np
import pytest
import xxhash

from tests_llm_brute import grouped
from tidemark.llm.cells import into_cells, spanning
from tidemark.llm.components import components
from tidemark.llm.embedding_lsh import Tables, collision, near_vectors
from tidemark.llm.queries import QUERIES
from tidemark.llm.simhash_anchors import anchors, keep_one, near_duplicates, near_fingerprints


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def wanted_groups(rows):
    prints = [(-1 if i is None else i, plain_simhash(t)) for i, t in rows]
    return grouped(prints, lambda a, b: (a ^ b).bit_count() <= 3)


@pytest.mark.parametrize("table", ["odd", "sample"])
def test_documents(request, table):
    docs = request.getfixturevalue(table)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint, -1 if r.component_id is None else r.component_id) for r in near_duplicates(docs).collect())
    wanted = sorted((i, f"{fp:016x}", c) for i, fp, c in wanted_groups(rows))
    assert found == wanted


def test_query(spark, sf_dir, sample):
    assert QUERIES["op6_simhash_anchors"](spark, sf_dir).count() == sample.count()


def test_no_document(none, odd):
    assert keep_one(none).count() == 0 and near_duplicates(none).count() == 0
    assert keep_one(odd).columns == odd.columns  # which rows stay: test_groups.py


def test_every_pair_within_three_bits_meets(spark):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(150)]
    near = [b ^ sum(1 << p for p in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(3)]
    fps = sorted(set(base + near))
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    links = near_fingerprints(spark.createDataFrame(signed, "fp long"))
    found = {r.node: r.component for r in components(links).collect()}
    wanted = {i: c for i, _, c in grouped([(s[0], x) for s, x in zip(signed, fps, strict=True)], lambda a, b: (a ^ b).bit_count() <= 3)}
    assert {i: found.get(i, i) for i in wanted} == wanted


def test_anchors_cover():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 32, 300, dtype=np.uint64).astype(np.uint32)
    for near in (words, words ^ np.uint32(1 << 31), words ^ np.uint32(1 << 7)):
        index, anchor = anchors(words)
        other, theirs = anchors(near)
        assert np.bincount(index).max() <= 17
        for i in range(len(words)):
            assert set(anchor[index == i]) & set(theirs[other == i])


def test_hot_bucket_meets_in_cells(spark):
    rows = spark.range(1050).selectExpr("7L AS bucket", "id").union(spark.createDataFrame([(8, 1), (9, 1), (9, 2)], "bucket long, id long"))
    cells = into_cells(rows, "id", block=100).collect()
    assert {r.bucket for r in cells} == {7, 9}
    hot = [r for r in cells if r.bucket == 7]
    by_cell: dict = {}
    for r in hot:
        by_cell.setdefault((r.cell_a, r.cell_b), []).append((r.id, r.side))
    assert max(map(len, by_cell.values())) < 400
    pairs = [(min(x, y), max(x, y)) for (a, b), rows in by_cell.items() for n, (x, s) in enumerate(rows) for y, t in rows[n + 1 :] if a == b or s != t]
    assert len(pairs) == len(set(pairs)) == 1050 * 1049 // 2


def test_spanning_forest():
    a, b = np.array([1, 2, 5, 6, 0]), np.array([2, 3, 6, 5, 0])
    u, v = spanning(a, b, 8)
    assert len(u) == 3 and {*u.tolist(), *v.tolist()} == {1, 2, 3, 5, 6}


def test_components_of_chain_star_and_none(spark):
    links = [(i, i + 1) for i in range(40)] + [(1000, 100 + i) for i in range(50)] + [(7, 7), (3, 2), (None, 4)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}, 1000: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_chance_of_collision():
    assert collision(0.0) == 1.0 and collision(0.4) > collision(0.5) > collision(1.4)
    small, large = Tables.sized(100, 8), Tables.sized(10**9, 8)
    assert small.width < large.width and small.tables < large.tables


def test_vectors(spark):
    rng = np.random.default_rng(8)
    centers = rng.standard_normal((30, 16))
    vectors = [(c + rng.standard_normal(16) * s).tolist() for c in centers for s in (0, 0.05, 0.1, 0.15, 0.3)]
    vectors += [vectors[0]] * 4 + [[2 * x for x in vectors[1]]]
    rows = [(i, v) for i, v in enumerate(vectors, 1)]
    odd = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] + [1.0] * 15), (904, [None] + [1.0] * 15), (905, [float("inf")] * 16), (906, [1.0, 2.0]), (None, vectors[3]), (5, vectors[4]), (907, [1e-30 * x for x in vectors[2]])]
    table = spark.createDataFrame([(i, v, 0, 1) for i, v in rows + odd], "vec_id long, embedding array<double>, label int, copies int")
    found = sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, -1 if r.component_id is None else r.component_id, r.kept) for r in near_vectors(table).collect())

    def near(a, b):
        if any(v is None or len(v) != 16 or any(x is None or not math.isfinite(x) for x in v) or not any(v) for v in (a, b)):
            return False
        a, b = np.array(a), np.array(b)
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.9

    listed = [(-1 if i is None else i, v) for i, v in rows + odd]
    wanted = sorted((i, sum(near(v, w) for m, (_, w) in enumerate(listed) if m != n), c, c == i) for n, (i, v, c) in enumerate(grouped(listed, near)))
    assert found == wanted
    assert near_vectors(table.limit(0)).count() == 0


def test_query_of_vectors(spark, sf_dir):
    found = QUERIES["op2_embedding_lsh"](spark, sf_dir)
    assert found.count() == 500 and found.filter("kept").count() == found.select("component_id").distinct().count()
