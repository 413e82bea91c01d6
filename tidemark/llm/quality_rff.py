"""Document quality: kernel ridge scores on document statistics, calibrated.

Random Fourier features (Rahimi and Recht, 2007) stand for a Gaussian kernel over standardised
statistics of a text. Ridge weights solve normal equations whose sums each partition of the sample
forms on its own. Labelled documents that took no part in them then calibrate the scores, by isotonic
regression, to the share of label 1.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.labelled import means, remainder, sample
from tidemark.llm.tables import NO_ID, content_of, given_id, known_id, packed, stored

#: Labelled documents used at most, to fit and to calibrate.
FIT_ROWS = 100_000
#: Sums are formed in so many tasks, so the driver gets as many matrices.
FIT_TASKS = 8
FEATURES = 384
BANDWIDTH = 5.0
RIDGE = 1e-3
SEED = 11
#: Of the labelled documents, one in so many calibrates.
CALIBRATE = 4
HELD_OUT = 5
ACCEPT = 0.3

_CLASSES = (string.ascii_lowercase, string.ascii_uppercase, string.digits, " ", "\n\r", "\t\v\f", *string.punctuation)
_CLASS_OF = np.zeros((256, len(_CLASSES) + 2))
for _n, _chars in enumerate(_CLASSES):
    _CLASS_OF[list(_chars.encode()), _n] = 1
_CLASS_OF[0xC0:, len(_CLASSES)] = 1  # first bytes of other characters
_CLASS_OF[:32, len(_CLASSES) + 1] = 1


def statistics(text: str | None) -> np.ndarray:
    """Shares of kinds of characters, lengths, and repetition of words and lines; defined for an empty text."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(data, minlength=256) @ _CLASS_OF
    words = (text or "").split()
    lines = (text or "").splitlines()
    n, unlike = len(words), len(set(words))
    letters = sum(map(len, words))
    shape = [
        np.log1p(len(data)),
        np.log1p(n),
        letters / max(n, 1),
        unlike / max(n, 1),
        np.log1p(len(lines)),
        len(set(lines)) / max(len(lines), 1),
        np.log1p(n / max(len(lines), 1)),
        np.log1p(max(map(len, words), default=0)),
    ]
    # Rare signs matter by their order of magnitude.
    return np.concatenate([np.log1p(1000 * kinds / max(len(data), 1)), shape])


WIDTH = len(_CLASSES) + 2 + 8


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``content``, ``x`` (doubles as bytes) per row, from the whole text; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(text.as_py()).tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.binary())], ["doc_id", "content", "x"]
            )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(known_id("doc_id").alias("doc_id"), text.alias("text"), content_of(text).alias("content"))
    return rows.mapInArrow(run, "doc_id long, content binary, x binary")


def _stack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, WIDTH)


def isotonic(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nondecreasing means of labels over scores: pools of violators, as (mean score, mean label)."""
    order = np.argsort(scores, kind="stable")
    x, first = np.unique(scores[order], return_index=True)
    weight = np.diff(np.append(first, len(scores))).astype(float)
    y = np.add.reduceat(labels[order], first) / weight
    pools: list[list[float]] = []  # weight, weighted score, weighted label
    for score, label, w in zip(x, y, weight, strict=True):
        pools.append([w, w * score, w * label])
        while len(pools) > 1 and pools[-2][2] / pools[-2][0] >= pools[-1][2] / pools[-1][0]:
            above = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], above, strict=True)]
    found = np.array(pools)
    return found[:, 1] / found[:, 0], found[:, 2] / found[:, 0]


@dataclass(frozen=True)
class QualityModel:
    """Without ``weights`` every score is ``prior``."""

    prior: float
    center: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    knots: np.ndarray | None = None
    levels: np.ndarray | None = None

    def raw(self, x: np.ndarray) -> np.ndarray:
        return expand((x - self.center) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        raw = self.raw(x)
        return np.clip(raw if self.knots is None else np.interp(raw, self.knots, self.levels), 0, 1)


def expand(z: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    rng = np.random.default_rng(SEED)
    directions = rng.standard_normal((z.shape[1], FEATURES)) / BANDWIDTH
    shifts = rng.uniform(0, 2 * np.pi, FEATURES)
    waves = np.sqrt(2 / FEATURES) * np.cos(np.clip(z, -8, 8) @ directions + shifts)
    return np.hstack([waves, np.ones((len(z), 1))])


def _summed(rows: DataFrame, each) -> np.ndarray | None:
    """Sum over all rows of the array that ``each`` makes of a batch's statistics and labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = each(_stack(batch.column(0)), batch.column(1).to_numpy())
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": [total.tobytes()]})

    parts = [np.frombuffer(r[0]) for r in rows.select("x", "y").mapInArrow(run, "part binary").collect()]
    return sum(parts[1:], parts[0].copy()) if parts else None


def _one_text(features: DataFrame) -> DataFrame:
    """Of rows that share an id the one whose text has the smallest hash: a label tells nothing of the others."""
    return features.groupBy("doc_id").agg(F.min_by("x", "content").alias("x"))


def fit(features: DataFrame, labels: DataFrame) -> QualityModel:
    """A model of the labels (``doc_id``, ``y``) of documents whose statistics are in ``features``."""
    joined = sample(labels, FIT_ROWS).join(_one_text(features), "doc_id")
    dealt = joined.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(CALIBRATE)))
    rows = stored(dealt.select("doc_id", "x", "y", "fold").repartition(FIT_TASKS, "doc_id"), "quality-sample")
    learn = rows.filter("fold > 0")
    sums = _summed(learn, lambda x, y: np.concatenate([[len(x), y.sum()], x.sum(0), (x * x).sum(0)]))
    if sums is None:
        return QualityModel(0.5)
    n, positive = sums[:2]
    center = sums[2 : 2 + WIDTH] / n
    spread = np.sqrt(np.maximum(sums[2 + WIDTH :] / n - center**2, 0))
    scale = np.where(spread > 1e-9, spread, 1.0)
    if n < 2 or positive in (0, n):
        return QualityModel(float(positive / n))

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        phi = expand((x - center) / scale)
        return np.hstack([phi.T @ phi, (phi.T @ y)[:, None]]).ravel()

    solved = _summed(learn, equations).reshape(FEATURES + 1, FEATURES + 2)
    penalty = np.diag(np.append(np.full(FEATURES, RIDGE * n), 0.0))
    weights = np.linalg.solve(solved[:, :-1] + penalty, solved[:, -1])
    model = QualityModel(float(positive / n), center, scale, weights)
    # Bounded as the sample is.
    calibrate = rows.filter("fold = 0").select("x", "y").toArrow()
    if calibrate.num_rows:
        raw = model.raw(_stack(calibrate.column(0)))
        model = QualityModel(model.prior, center, scale, weights, *isotonic(raw, calibrate.column(1).to_numpy()))
    return model


def score_quality(docs: DataFrame, labels: DataFrame, held_out: int = HELD_OUT) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Learns from labels (doc_id, quality) of documents that are not held out, and from the text alone.
    Repeated labels count as their mean; without labels, or with one kind only, all scores are equal.
    A null text counts as empty, a null id stays null, repeated rows stay. Other columns are not read.
    """
    return _scored(docs, labels, held_out).select(
        given_id(F.col("doc_id")).alias("doc_id"),
        (remainder(given_id(F.col("doc_id")), held_out) == 0).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def _scored(docs: DataFrame, labels: DataFrame, held_out: int = HELD_OUT) -> DataFrame:
    """``doc_id``, ``content``, ``score`` per row of ``docs``."""
    features = stored(document_statistics(docs), "statistics")
    known = means(labels, "quality").filter(remainder(F.col("doc_id"), held_out) != 0)
    model = fit(features.filter(F.col("doc_id") != NO_ID), known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(_stack(batch.column(2))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores)], ["doc_id", "content", "score"]
            )

    return features.mapInArrow(run, "doc_id long, content binary, score double")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, each judged by its own text.

    A null text counts as empty; rows without an id, repeated rows and rows that share an id stay or
    go by their texts; other columns are kept whatever their names. An empty table gives an empty result.
    """
    # A score follows from the text alone, so a rejected content takes its copies along and nothing else.
    bad = _scored(docs, labels).filter(F.col("score") < ACCEPT).select(F.col("content").alias("_bad_content"))
    rows = packed(docs, content_of(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_own_content"))
    # Written, so that both sides of the join come from a shuffle and a hot content can be split.
    bad = stored(bad.distinct(), "rejected")
    return rows.join(bad, F.col("_own_content") == F.col("_bad_content"), "left_anti").select("_row.*")
