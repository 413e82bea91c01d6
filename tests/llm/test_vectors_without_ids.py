"""Vectors with missing and repeated ids against brute force."""

import numpy as np

from tests_llm_brute import grouped
from tidemark.llm.embedding_lsh import near_vectors


def test_missing_and_repeated_ids(spark):
    rng = np.random.default_rng(4)
    centers = rng.standard_normal((12, 16))
    vectors = [(c + rng.standard_normal(16) * s).tolist() for c in centers for s in (0, 0.05, 0.1)]
    ids = [None if n % 3 == 0 else 7 if n % 5 == 0 else 100 + n for n in range(len(vectors))]
    rows = [*zip(ids, vectors, strict=True), (None, vectors[1]), (7, vectors[4]), (None, rng.standard_normal(16).tolist()), (7, rng.standard_normal(16).tolist())]

    def near(a, b):
        a, b = np.array(a), np.array(b)
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.9

    listed = [(-1 if i is None else i, v) for i, v in rows]
    # Numbers of their own first: rows that share an id are linked by their vectors alone.
    parts = [c for _, _, c in grouped(list(enumerate(v for _, v in listed)), near)]
    smallest = {c: min(i for (i, _), d in zip(listed, parts, strict=True) if d == c) for c in parts}
    links = [sum(near(v, w) for m, (_, w) in enumerate(listed) if m != n) for n, (_, v) in enumerate(listed)]
    wanted = sorted((i, n, smallest[c], smallest[c] == i) for (i, _), n, c in zip(listed, links, parts, strict=True))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = [(-1 if r.vec_id is None else r.vec_id, r.n_links, -1 if r.component_id is None else r.component_id, r.kept) for r in near_vectors(table).collect()]
    assert sorted(found) == wanted
