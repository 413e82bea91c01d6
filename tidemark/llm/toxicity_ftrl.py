"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Every coordinate has its own learning rate, and the L1 penalty keeps most weights at zero, so what
is sent to score all documents is small (McMahan et al., "Ad Click Prediction: a View from the
Trenches", 2013). Shards of a bounded sample are learned side by side; after each round the states of
the shards are averaged, coordinate by coordinate, and the next round goes on from there.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import means, remainder, sample
from tidemark.llm.tables import given_id, known_id, portions, stored

#: Labelled documents used at most, in so many shards and rounds.
FIT_ROWS = 40_000
SHARDS = 4
ROUNDS = 3
#: Coordinates are 2 ** BITS; the first one is the constant.
BITS = 20
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1.5, 0.1
HELD_OUT, HELD_OUT_REMAINDER = 4, 2
ACCEPT = 0.3

#: Shards send their states in single precision.
_SENT = np.dtype("<f4")
_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def coordinates(text: str | None) -> np.ndarray:
    """Distinct hashed words, pairs of neighbours, and pairs with one word skipped; the constant is first."""
    words = _WORD.findall((text or "").lower())
    h = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        one = h * _MIX
        two = (one[:-1] ^ (h[1:] << np.uint64(31))) * _MIX + np.uint64(2)
        skip = (one[:-2] ^ (h[2:] << np.uint64(29))) * _MIX + np.uint64(3)
        mixed = np.concatenate([one, two, skip]) * _MIX
    places = (mixed >> np.uint64(64 - BITS)).astype(np.int64)
    return np.concatenate([[0], np.unique(places[places > 0])])


@dataclass
class Ftrl:
    """State of all coordinates: ``z``, the gradients less what the weights account for, and ``n``, their squares."""

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def empty(cls) -> Ftrl:
        return cls(np.zeros(1 << BITS), np.zeros(1 << BITS))

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.maximum(np.abs(z) - np.where(at == 0, 0.0, L1), 0.0)
        return -np.sign(z) * shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, label: float) -> None:
        weights = self.weights(at)
        gradient = 1 / (1 + np.exp(-np.clip(weights.sum(), -30, 30))) - label
        n = self.n[at]
        rate = (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / ALPHA
        self.z[at] += gradient - rate * weights
        self.n[at] = n + gradient * gradient


def _mean(states: pa.ChunkedArray) -> np.ndarray:
    total = np.zeros(1 << BITS)
    for state in states:
        total += np.frombuffer(state.as_buffer(), _SENT)
    return total / len(states)


def fit(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and weights that are not zero, of a bounded sample (``shard``, ``turn``, ``y``, ``text``).

    A shard is learned by one task, in the order of ``turn``; the shards side by side. Texts are
    hashed anew in each round: their coordinates take more room than they do.
    """
    spark = texts.sparkSession
    state = Ftrl.empty()
    for _ in range(ROUNDS):
        start = spark.sparkContext.broadcast((state.z, state.n))

        def learn(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            shards: dict[int, Ftrl] = {}
            for batch in batches:
                for shard, label, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if shard not in shards:
                        shards[shard] = Ftrl(*(a.copy() for a in start.value))
                    shards[shard].learn(coordinates(text), label)
            for shard, ftrl in shards.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), *(pa.array([a.astype(_SENT).tobytes()], pa.binary()) for a in (ftrl.z, ftrl.n))],
                    ["shard", "z", "n"],
                )

        # By number: a hash of so few shards would put some of them on the same partition.
        ordered = texts.repartitionById(SHARDS, F.col("shard")).sortWithinPartitions("shard", "turn", "text")
        learned = ordered.select("shard", "y", "text").mapInArrow(learn, "shard int, z binary, n binary")
        # A row per shard with the state of all coordinates: a fixed size, whatever the texts are.
        found = learned.toArrow().sort_by("shard")
        if found.num_rows:
            state = Ftrl(*(_mean(found.column(name)) for name in ("z", "n")))
        start.unpersist()
    weights = state.weights(np.arange(1 << BITS))
    places = np.flatnonzero(weights)
    return places, weights[places]


def score_toxicity(
    docs: DataFrame, labels: DataFrame, held_out: int = HELD_OUT, held_out_remainder: int = HELD_OUT_REMAINDER
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Learns from labels (doc_id, toxic) of documents that are not held out, and from the text alone.
    Repeated labels count as their mean; without labels all scores are one half. A null text counts
    as empty, a null id stays null, repeated rows stay. Other columns are not read.
    """
    known = means(labels, "toxic").filter(remainder(F.col("doc_id"), held_out) != held_out_remainder)
    rows = docs.select(known_id("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = sample(known, FIT_ROWS).join(rows, "doc_id").select(
        F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(SHARDS)).cast("int").alias("shard"),
        F.xxhash64("doc_id", F.lit("turn")).alias("turn"),
        "y",
        "text",
    )
    places, found = fit(stored(dealt, "toxicity-sample"))
    sent = docs.sparkSession.sparkContext.broadcast((places.astype(np.int32), found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << BITS)
        weights[sent.value[0]] = sent.value[1]
        for batch in batches:
            for part in portions(batch, 1):
                logits = np.array([weights[coordinates(text)].sum() for text in part.column(1).to_pylist()])
                scores = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores)], ["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double").select(
        given_id(F.col("doc_id")).alias("doc_id"),
        (remainder(given_id(F.col("doc_id")), held_out) == held_out_remainder).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )
