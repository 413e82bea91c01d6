"""Pairs planted just above the threshold among unrelated vectors: recall and counts."""

import numpy as np
import pytest

from tidemark.llm.embedding_lsh import near_vectors


@pytest.mark.parametrize("kind", ["float", "double"])
def test_planted_pairs(spark, kind):
    rng = np.random.default_rng(4)
    pairs, dimension = 1000, 64
    base = rng.standard_normal((20_000, dimension))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    aside = rng.standard_normal((pairs, dimension))
    aside -= (aside * base[:pairs]).sum(axis=1, keepdims=True) * base[:pairs]
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cosines = rng.uniform(0.9001, 0.95, (pairs, 1))
    partner = cosines * base[:pairs] + np.sqrt(1 - cosines**2) * aside
    every = np.concatenate([base, partner]).astype(np.float32 if kind == "float" else np.float64)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(every)], f"vec_id long, embedding array<{kind}>")
    unit = every.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links = {
        (int(i) + low, int(j))
        for low in range(0, len(unit), 1000)
        for i, j in zip(*np.nonzero(unit[low : low + 1000] @ unit.T >= 0.9), strict=True)
        if i + low < j
    }
    assert len(links) >= pairs
    found = {r.vec_id: r for r in near_vectors(table).collect()}
    assert len(found) == len(every)
    wanted = {i for link in links for i in link}
    # Every link that is told is a real one, and few real ones are missed.
    assert {i for i, r in found.items() if r.n_links} <= wanted
    told = sum(r.n_links for r in found.values()) / 2
    assert 0.95 * len(links) <= told <= len(links)
    tied = sum(found[a].component_id == found[b].component_id for a, b in links)
    assert tied >= 0.95 * len(links)
