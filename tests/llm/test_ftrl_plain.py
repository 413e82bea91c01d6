"""The distributed fit against the algorithm written down plainly, one coordinate at a time."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity_ftrl as tox
from tidemark.llm.toxicity_ftrl import coordinates, fit

WORDS = ["vile", "awful", "trash", "kind", "lovely", "thanks", "river", "stone", "paper", "window"]


def plain(examples, rounds):
    """Weights after FTRL-proximal over (coordinates, label), as in the paper's first algorithm."""
    z, n = {}, {}

    def weight(i):
        penalty = 0.0 if i == 0 else tox.L1
        if abs(z.get(i, 0.0)) <= penalty:
            return 0.0
        return -(z[i] - math.copysign(penalty, z[i])) / ((tox.BETA + math.sqrt(n[i])) / tox.ALPHA + tox.L2)

    for _ in range(rounds):
        for places, label in examples:
            w = {i: weight(i) for i in places}
            g = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w.values()))))) - label
            for i in places:
                before = n.get(i, 0.0)
                rate = (math.sqrt(before + g * g) - math.sqrt(before)) / tox.ALPHA
                z[i] = z.get(i, 0.0) + g - rate * w[i]
                n[i] = before + g * g
        z, n = ({i: float(np.float32(x)) for i, x in state.items()} for state in (z, n))  # as they are sent
    return {i: weight(i) for i in z if weight(i)}


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(4)
    rows = []
    for turn in range(160):
        toxic = rng.random() < 0.4
        some = [rng.choice(WORDS[:3] if toxic and rng.random() < 0.5 else WORDS[3:]) for _ in range(rng.randint(1, 12))]
        rows.append((turn % 4, turn, float(toxic), " ".join(some)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "shard int, turn long, y double, text string")


def test_one_shard_is_plain_ftrl(spark, texts):
    rows = [(0, turn, y, text) for _, turn, y, text in texts]
    places, weights = fit(frame(spark, rows).repartition(5))
    wanted = plain([(coordinates(text).tolist(), y) for _, _, y, text in rows], tox.ROUNDS)
    assert places.tolist() == sorted(wanted)
    assert weights.tolist() == pytest.approx([wanted[i] for i in sorted(wanted)], rel=1e-9)


def test_shards_have_tasks_of_their_own(spark, texts):
    dealt = frame(spark, texts).repartitionById(tox.SHARDS, F.col("shard"))
    held = dealt.select("shard", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(held) == len({r.task for r in held}) == tox.SHARDS
