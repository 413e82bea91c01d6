"""Near-duplicate vectors: Euclidean p-stable hashing, then exact cosines.

Vectors are normalised, so cosine ``c`` means distance ``sqrt(2 - 2c)``. A hash is a Gaussian random
projection, shifted and cut into steps of a fixed width; ``width`` hashes of a table together name a
bucket (Datar et al., "Locality-Sensitive Hashing Scheme Based on p-Stable Distributions", 2004). The
chance that two vectors share one hash is known for every distance, and the sizes follow from it:
as many hashes per table as keep a bucket of unrelated vectors near ``BUCKET`` rows, and as many
tables as find a pair exactly at the threshold with probability ``RECALL``. Closer pairs are found
more surely. Every candidate is checked by its cosine in double precision, so no link is wrong.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tidemark.llm.cells import CELL, dealt, gathered, spanning
from tidemark.llm.components import components
from tidemark.llm.tables import given_id, known_id, stored, whole_groups

COSINE = 0.9
RECALL = 0.98
STEP = 2.5
BUCKET = 32
SEED = 7


def collision(distance: float, step: float = STEP) -> float:
    """Probability that one hash of step width ``step`` is equal for two points ``distance`` apart."""
    if distance <= 0:
        return 1.0
    r = step / distance
    outside = math.erfc(r / math.sqrt(2))
    return 1 - outside - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


@dataclass(frozen=True)
class Tables:
    """``tables`` hash tables of ``width`` hashes over vectors of ``dimension`` components."""

    dimension: int
    width: int
    tables: int
    seed: int = SEED
    step: float = STEP

    @classmethod
    def sized(cls, vectors: int, dimension: int, cosine: float = COSINE, recall: float = RECALL) -> Tables:
        near, far = collision(math.sqrt(max(0.0, 2 - 2 * cosine))), collision(math.sqrt(2))
        width = max(4, math.ceil(math.log(max(2, vectors) / BUCKET) / -math.log(far)))
        tables = math.ceil(math.log(1 - recall) / math.log(1 - near**width)) if near < 1 else 1
        return cls(dimension, width, tables)

    def projections(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rng = np.random.default_rng([self.seed, self.dimension, self.width, self.tables])
        normals = rng.standard_normal((self.dimension, self.tables * self.width))
        shifts = rng.uniform(0, self.step, self.tables * self.width)
        odd = rng.integers(1, 2**62, (self.tables, self.width), dtype=np.int64) * 2 + 1
        return normals, shifts, odd

    def keys(self, unit: np.ndarray, drawn: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Bucket numbers, a column per table; the steps of a table are mixed into 64 bits."""
        normals, shifts, odd = drawn
        steps = np.floor((unit @ normals + shifts) / self.step).astype(np.int64)
        steps = steps.reshape(len(unit), self.tables, self.width)
        with np.errstate(over="ignore"):
            mixed = (steps * odd).sum(axis=2)
            mixed ^= mixed >> np.int64(29)
            return mixed * np.int64(0x1B873593CC9E2D51) + np.arange(self.tables)


def _matrix(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    """Unit vectors, in doubles, of a binary column of components in their table's precision."""
    joined = b"".join(column.to_pylist())
    single = len(joined) == 4 * dimension * len(column)
    vectors = np.frombuffer(joined, np.float32 if single else np.float64).reshape(-1, dimension).astype(np.float64)
    # A largest component of one first, so that neither tiny nor huge vectors lose their length.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id``, ``vector`` (array of double) of the vectors that can be near another one."""
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists(vector, lambda x: x != 0)
    return vectors.select(known_id(id_column).alias("id"), vector.alias("vector")).filter(finite & nonzero)


def _width(vectors: DataFrame, vector_column: str) -> int:
    """Bytes of a component: those of a float are enough where the table holds floats."""
    given = vectors.select(F.col(vector_column)).schema[0].dataType
    return 4 if isinstance(getattr(given, "elementType", None), FloatType) else 8


def _pack(rows: DataFrame, width: int) -> DataFrame:
    """The same rows with ``vector`` as bytes, grouped cheaply and sent to numpy as they are."""
    kind = np.float32 if width == 4 else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind) + kind(0)  # no negative zero
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            parts = np.split(flat, ends[:-1]) if len(ends) else []
            packed = pa.array([p.tobytes() for p in parts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], ["id", "vector"])

    return rows.mapInArrow(run, "id long, vector binary")


def _hash(batches: Iterator[pa.RecordBatch], sized: Tables) -> Iterator[pa.RecordBatch]:
    drawn = sized.projections()
    for whole in batches:
        for start in range(0, whole.num_rows, 500):
            batch = whole.slice(start, 500)
            keys = sized.keys(_matrix(batch.column(1), sized.dimension), drawn)
            for table in range(sized.tables):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[:, table]), pa.array(np.full(len(keys), table, np.int32)), batch.column(0)],
                    ["bucket", "hash_table", "node"],
                )


def _compare(batches: Iterator[pa.RecordBatch], sized: Tables, cosine: float) -> Iterator[pa.RecordBatch]:
    """Per cell: how many vectors each class links to (``a``, ``n``), and links that connect (``a``, ``b``).

    A pair that shares several buckets counts in the first table that holds both.
    """
    drawn = sized.projections()
    for table in whole_groups(batches, CELL):
        key = np.stack([table.column(k).to_numpy() for k in CELL], axis=1)
        nodes, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        side, number = table.column("side").to_numpy(), table.column("hash_table").to_numpy()
        edges = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1), True])
        unit = _matrix(table.column("vector"), sized.dimension)
        left, right = [], []
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            if hi - lo < 2:
                continue
            if key[lo, 1] == key[lo, 2]:
                i, j = np.nonzero(np.triu(unit[lo:hi] @ unit[lo:hi].T >= cosine, 1))
            else:
                first = np.flatnonzero(side[lo:hi] == key[lo, 1])
                second = np.flatnonzero(side[lo:hi] == key[lo, 2])
                i, j = np.nonzero(unit[lo + first] @ unit[lo + second].T >= cosine)
                i, j = first[i], second[j]
            if len(i):
                left.append(i + lo)
                right.append(j + lo)
        if not left:
            continue
        i, j = np.concatenate(left), np.concatenate(right)
        rows = np.unique(np.concatenate([i, j]))
        place = np.zeros(len(nodes), np.int64)
        place[rows] = np.arange(len(rows))
        keys = sized.keys(unit[rows], drawn)
        count = np.zeros(len(nodes), np.int64)
        step = max(1, 4_000_000 // sized.tables)
        for start in range(0, len(i), step):
            a, b = i[start : start + step], j[start : start + step]
            first_shared = (keys[place[a]] == keys[place[b]]).argmax(axis=1)
            a, b = a[first_shared == number[a]], b[first_shared == number[a]]
            np.add.at(count, a, copies[b])
            np.add.at(count, b, copies[a])
        counted = np.flatnonzero(count)
        u, v = spanning(i, j, len(nodes))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([nodes[counted], nodes[u]])),
                pa.array(np.concatenate([np.zeros(len(counted), np.int64), nodes[v]]), mask=np.arange(len(counted) + len(u)) < len(counted)),
                pa.array(np.concatenate([count[counted], np.zeros(len(u), np.int64)])),
            ],
            ["a", "b", "n"],
        )


def near_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    cosine: float = COSINE,
    recall: float = RECALL,
) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    ``n_links`` counts the other rows linked directly, copies included; ``component_id`` is the
    smallest id reachable. Equal vectors are one class: they are compared once and weighted by their
    number. Vectors that are null, empty, all zero, or hold a null or non-finite component link with
    nothing, and so do vectors of different length with each other. A missing id counts as the
    smallest and is returned as null; repeated rows count as copies. An empty table gives an empty
    result. Columns other than the two are not read.
    """
    width = _width(vectors, vector_column)
    packed = stored(_pack(usable(vectors, id_column, vector_column), width), "vectors")
    # A class has a number of its own, written once: ids may be missing or repeated.
    grouped = packed.groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    classes = stored(grouped.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    lengths = classes.groupBy((F.length("vector") / width).cast("int").alias("dimension")).agg(F.count(F.lit(1)).alias("n"))
    found = None
    for dimension, n in ((r["dimension"], r["n"]) for r in lengths.filter("n > 1").collect()):
        sized = Tables.sized(n, dimension, cosine, recall)
        same = classes.filter(F.length("vector") == width * dimension).select("node", "vector", "copies")
        part = _links(same, sized, cosine)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = classes.select(F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0).cast("long").alias("n")).limit(0)
    found = stored(found, "vector-links")
    linked = found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    groups = components(found.filter("b IS NOT NULL").select("a", "b"))
    firsts = groups.join(classes.select("node", "id"), "node")
    smallest = firsts.groupBy("component").agg(F.min("id").alias("component_id"))
    named = firsts.join(smallest, "component").select("node", "component_id")
    of_class = (
        classes.join(linked, "node", "left")
        .join(named, "node", "left")
        .select(
            "vector",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
    )
    # Written, so that both sides of the join come from a shuffle and a hot vector can be split.
    good = packed.join(stored(of_class, "vector-components"), "vector").select("id", "n_links", "component_id")
    usable_ids = vectors.select(known_id(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    alone = usable_ids.filter(~F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False)))
    return good.unionByName(
        alone.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    ).select(
        given_id(F.col("id")).alias("vec_id"),
        "n_links",
        given_id(F.col("component_id")).alias("component_id"),
        (F.col("id") == F.col("component_id")).alias("kept"),
    )


def _links(classes: DataFrame, sized: Tables, cosine: float) -> DataFrame:
    # Numbers alone are dealt; vectors join the rows that have something to compare.
    buckets = classes.select("node", "vector").mapInArrow(lambda b: _hash(b, sized), "bucket long, hash_table int, node long")
    cells = gathered(dealt(buckets, "node").join(classes, "node"))
    return cells.mapInArrow(lambda b: _compare(b, sized, cosine), "a long, b long, n long")
