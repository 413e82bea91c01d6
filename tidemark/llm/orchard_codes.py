"""Vector codes: each part of a vector is named by the nearest entry of its codebook, found by Orchard's search.

For every entry of a codebook its neighbours are listed, nearest first. A search holds the best
entry so far and goes along that entry's list. Whenever a neighbour is nearer to the query, it becomes the best one
and the search goes on at the start of its list; entries met before are marked and passed over. By the triangle
inequality it may stop as soon as the list's neighbours are more than twice as far from the
best entry as the query is, so the result is exact, ties included.
(Orchard, "A fast nearest-neighbor search algorithm", 1991.)

All numbers are whole. Tasks search many queries at once and return sums per entry; of the
vectors nothing else reaches the driver, which holds the codebooks alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tables import stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Whole numbers per unit of a component.
SCALE = 1024
#: Scaled components beyond this bound, or below its negative, count as the bound.
LARGEST = 1 << 50
#: Queries that are searched together, and neighbours that each looks at in one step.
TOGETHER = 2048
STEP = 16
#: Label totals are broadcast up to this number of labels.
BROADCAST_LABELS = 1_000_000
_MOST = (1 << 63) - 1

_BEYOND = {"d": np.inf, "l": np.iinfo(np.int64).max, "O": float("inf")}

Codebook = tuple[tuple[tuple[int, ...], ...], ...]


def whole(components: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)`` of finite components, exact; floats that hold whole numbers."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(components.astype(np.float64) * SCALE), -LARGEST, LARGEST)


def exact_kind(largest: int, width: int) -> type:
    """A type in which squared distances of vectors with such components are exact, the fastest first."""
    bound = 4 * largest * largest * max(width, 1)
    return np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 62 else object


class Neighbours:
    """The entries of one codebook and, for each, all entries by distance from it."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = entries[:, None, :] - entries[None, :, :]
        gaps = (apart * apart).sum(axis=2)
        order = np.argsort(gaps, axis=1, kind="stable")
        # Every list ends with a step of gaps that no distance reaches, so that a search stops there.
        self.width = -(-len(entries) // STEP) * STEP + STEP
        self.listed = np.zeros((len(entries), self.width), np.int64)
        self.listed[:, : len(entries)] = order
        self.apart = np.full((len(entries), self.width), _BEYOND[gaps.dtype.char], gaps.dtype)
        self.apart[:, : len(entries)] = np.take_along_axis(gaps, order, axis=1)
        self.start = int(np.argmin(gaps.sum(axis=1)))

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry of each query, the lowest of equally near ones, and the squared distance."""
        found = [self._search(queries[i : i + TOGETHER]) for i in range(0, len(queries), TOGETHER)]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count, entries = len(queries), len(self.entries)
        best = np.full(count, self.start)
        distance = self._squared(queries, best)
        visited = np.zeros((count, entries), bool)
        visited[:, self.start] = True
        place = np.zeros(count, int)  # in the list of the best entry
        active = np.arange(count)
        while len(active):
            ahead = best[active] * self.width + place[active]
            ahead = ahead[:, None] + np.arange(STEP)
            listed = self.listed.take(ahead)
            inside = self.apart.take(ahead) <= 4 * distance[active][:, None]
            fresh = np.flatnonzero((inside & ~visited.take(active[:, None] * entries + listed)).ravel())
            row, entry = fresh // STEP, listed.ravel()[fresh]
            query = active[row]
            visited.ravel()[query * entries + entry] = True
            near = self._squared(queries.take(query, axis=0), entry)
            # Per query the nearest entry met in this step, the lowest of equally near ones.
            begins = np.flatnonzero(np.diff(row, prepend=-1))
            if len(begins):
                query = query[begins]
                nearest = np.minimum.reduceat(near, begins)
                lengths = np.diff(begins, append=len(row))
                tied = np.where(near == np.repeat(nearest, lengths), entry, entries)
                entry = np.minimum.reduceat(tied, begins)
                better = (nearest < distance[query]) | ((nearest == distance[query]) & (entry < best[query]))
            place[active] += STEP
            if len(begins):
                moved = query[better]
                best[moved], distance[moved], place[moved] = entry[better], nearest[better], 0
            active = active[inside.all(axis=1) | (place[active] == 0)]
        return best, distance

    def _squared(self, queries: np.ndarray, entry: np.ndarray) -> np.ndarray:
        apart = queries - self.entries[entry]
        return (apart * apart).sum(axis=1)


@dataclass(frozen=True)
class Codebooks:
    """``parts`` lists, per part of a vector, the entries; ``bounds`` are the places where parts begin and end."""

    parts: Codebook
    bounds: tuple[int, ...]

    @property
    def sha256(self) -> str:
        numbers = (str(x) for part in self.parts for entry in part for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def assign(self, vectors: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Per part: its place in a vector, and entry and squared distance of each of some whole vectors."""
        largest = max(int(np.abs(vectors).max(initial=0)), self._largest)
        for part, (begin, end) in enumerate(zip(self.bounds, self.bounds[1:], strict=False)):
            kind = exact_kind(largest, end - begin)
            queries = vectors[:, begin:end].astype(np.int64).astype(kind)
            yield slice(begin, end), *_neighbours(self, part, kind).search(queries)

    @property
    def _largest(self) -> int:
        return max((abs(x) for part in self.parts for entry in part for x in entry), default=0)


@lru_cache(maxsize=2 * PARTS)
def _neighbours(books: Codebooks, part: int, kind: type) -> Neighbours:
    """Of a worker process, kept from batch to batch."""
    entries = books.parts[part]
    return Neighbours(np.array(entries, dtype=object).reshape(len(entries), -1).astype(kind))


def usable(vectors: DataFrame, id_column: str, vector_column: str, label_column: str | None = None) -> DataFrame:
    """``vec_id``, ``vector``, ``label`` of the rows whose vector and components are all there and finite."""
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.col(label_column) if label_column else F.lit(None).cast("int")
    return vectors.filter(F.coalesce(finite, F.lit(False))).select(
        F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector"), label.alias("label")
    )


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """Codebooks of the rows with the smallest ids; None where there is no row.

    Missing ids come last, equal ones are ordered by vector. The first row sets the length of vectors.
    """
    # The ids alone first, so that tasks pass on few bytes; the rows then come from below one bound.
    ids = rows.filter("vec_id IS NOT NULL").select("vec_id").orderBy("vec_id").limit(entries)
    bound = stored(ids, "first-ids").agg(F.max("vec_id").alias("last"), F.count(F.lit(1)).alias("n")).first()
    near = rows.filter(F.col("vec_id") <= bound["last"]) if bound["n"] == entries else rows
    in_order = (F.col("vec_id").asc_nulls_last(), F.col("vector"))
    first = stored(near.select("vec_id", "vector").orderBy(*in_order).limit(1), "first-vector").first()
    if first is None:
        return None
    length = len(first["vector"])
    if bound["n"] == entries and near.filter(F.size("vector") != length).isEmpty():
        chosen = near
    else:
        chosen = rows.filter(F.size("vector") == length)
    listed = stored(chosen.select("vec_id", "vector").orderBy(*in_order).limit(entries), "first-vectors")
    found = listed.orderBy(*in_order).collect()  # no more than ``entries``
    bounds = tuple(i * length // parts for i in range(parts + 1))
    numbers = [[int(x) for x in whole(np.array(r["vector"], float))] for r in found]
    return Codebooks(
        tuple(tuple(tuple(v[b:e]) for v in numbers) for b, e in zip(bounds, bounds[1:], strict=False)), bounds
    )


def _matrix(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole components of the vectors of that length, and which rows those are."""
    lengths = np.diff(column.offsets.to_numpy())
    fits = lengths == length
    flat = column.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False)
    return whole(flat.reshape(int(fits.sum()), length)), fits


def improved(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part goes to its nearest entry, and each entry becomes the floored mean of its parts."""
    length, width = books.bounds[-1], max(np.diff(books.bounds))
    parts, entries = len(books.parts), len(books.parts[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, entries, width), np.int64)
        carried = np.zeros((parts, entries, width), object)
        counts = np.zeros((parts, entries), np.int64)
        room = 0
        for batch in batches:
            vectors, _ = _matrix(batch.column(0), length)
            if not len(vectors):
                continue
            room += len(vectors) * int(np.abs(vectors).max(initial=0))
            if room > 1 << 62:  # before the sums of whole numbers could overflow
                carried, totals, room = carried + totals, np.zeros_like(totals), 0
            for part, (place, entry, _) in enumerate(books.assign(vectors)):
                np.add.at(totals[part, :, : place.stop - place.start], entry, vectors[:, place].astype(np.int64))
                counts[part] += np.bincount(entry, minlength=entries)
        totals = carried + totals
        part, entry = np.nonzero(counts)
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(part, width).astype(np.int32)),
                    pa.array(np.repeat(entry, width).astype(np.int32)),
                    pa.array(np.tile(np.arange(width, dtype=np.int32), len(part))),
                    pa.array([Decimal(int(x)) for x in totals[part, entry].ravel()], pa.decimal128(38, 0)),
                    pa.array(np.repeat(counts[part, entry], width)),
                ],
                ["part", "entry", "place", "total", "n"],
            )

    sums = (
        rows.select("vector")
        .mapInArrow(run, "part int, entry int, place int, total decimal(38,0), n long")
        .groupBy("part", "entry", "place")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    )
    means = {(r["part"], r["entry"], r["place"]): int(r["total"]) // r["n"] for r in stored(sums, "sums").collect()}
    return Codebooks(
        tuple(
            tuple(tuple(means.get((p, e, i), x) for i, x in enumerate(entry)) for e, entry in enumerate(part))
            for p, part in enumerate(books.parts)
        ),
        books.bounds,
    )


def coded(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id``, ``label``, ``code``, ``error`` per row; vectors of another length have no code and no error."""
    length = books.bounds[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, fits = _matrix(batch.column(2), length)
            codes, errors = np.full(batch.num_rows, None, object), np.full(batch.num_rows, None, object)
            if len(vectors):
                found = list(books.assign(vectors))
                names = np.stack([entry for _, entry, _ in found], axis=1)
                codes[fits] = ["".join(f"{e:02x}" for e in name) for name in names.tolist()]
                far = sum(distance.astype(object) for _, _, distance in found)
                errors[fits] = [min(int(d), _MOST) for d in far]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    kinds = {f.name: f.dataType for f in rows.schema}
    schema = T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("label", kinds["label"]),
            T.StructField("code", T.StringType()),
            T.StructField("error", T.LongType()),
        ]
    )
    return rows.select("vec_id", "label", "vector").mapInArrow(run, schema)


def compress(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> tuple[DataFrame, Codebooks | None]:
    """Codes of all usable vectors, and the codebooks (None without any).

    The DataFrame has ``vec_id``, ``code`` (two hex digits per part), ``error`` (squared distances
    summed over the parts) and ``label_error`` (``error`` summed over the rows of the label; rows
    without a label are together). Rows whose vector is null or has null or non-finite components are left out.
    Rows without an id are coded and come last where rows are ordered; repeated rows stay; vectors of
    another length than the first row's have null ``code`` and ``error``; sums beyond the largest
    long are that; an empty table gives an empty result. Other columns are not read.
    """
    if entries > 256:
        raise ValueError("a code names an entry by two hex digits")
    rows = usable(vectors, id_column, vector_column, label_column)
    books = first_books(rows, parts, entries)
    if books is None:
        return rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).withColumn(
            "label_error", F.col("error")
        ), None
    for _ in range(rounds):
        books = improved(rows, books)
    found = stored(coded(rows, books), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(Decimal(_MOST))).cast("long")
    sums = stored(found.groupBy(F.col("label").alias("of")).agg(total.alias("label_error")), "label-sums")
    if sums.count() <= BROADCAST_LABELS:
        sums = F.broadcast(sums)
    told = found.join(sums, F.col("label").eqNullSafe(F.col("of")), "left")
    return told.select("vec_id", "code", "error", "label_error"), books
