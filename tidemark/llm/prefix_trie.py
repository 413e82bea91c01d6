"""The trie of conversation prefixes, in balanced parentheses per shard.

A node stands for the first turns of some conversations, the root for none. Its key is a chain of
SHA-256 over the turns, so texts are read once and not moved. Conversations with equal turns are one
record, and records are sorted by their keys from the root on and cut into shards.

**Shard.** Sorted records visit the trie in depth-first order, so a shard writes its nodes as balanced
parentheses. A tree of block minima over the running excess (a range min-max tree) finds the
closing parenthesis of every node, and with it the node's subtree; leaves are ``()`` pairs counted by
rank, members and savings are differences of cumulative arrays.

**Spines.** Only nodes on the path of a shard's first or last record can go on in another shard. All others are
finished there. These two paths are passed on as records that carry, for each node, what is finished
below it, and the records of all shards make the next, far smaller round, until one shard holds them all.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

#: Turns (of records' paths) that make a shard, unless paths are so long that a few of them are more.
SHARD_TURNS = 20_000
#: Paths of the greatest length that a shard takes at least; it passes on two.
SHARD_PATHS = 8
#: Parentheses per block of the range min-max tree.
BLOCK = 64
#: Bytes of joined ids that are passed on as one row.
CHUNK = 1 << 16
#: Finished spine nodes are broadcast up to this number.
BROADCAST_NODES = 1_000_000

_PATH = "array<struct<a:bigint,b:bigint,w:bigint>>"
_VALUES = "array<struct<members:bigint,first_id:bigint,children:bigint,leaves:bigint,saved:bigint>>"
#: A record: the steps from the root on, and values for as many of the last steps as there are.
_RECORD = f"path {_PATH}, values {_VALUES}"
_NODE = (
    "depth long, a long, b long, up_a long, up_b long, conv_id long, up_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long"
)
ROOT = (0, 0, 0)
#: Values of a node without conversations of its own, or finished children.
_NO_ID = (1 << 63) - 1


class Parentheses:
    """A balanced sequence (True opens) with its excess and a range min-max tree over blocks of it."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1))
        blocks = max(1, -(-len(opens) // BLOCK))
        self.width = 1 << (blocks - 1).bit_length()
        padded = np.full(self.width * BLOCK, np.iinfo(np.int64).max)
        padded[: len(opens)] = self.excess
        self.padded = padded
        # As a heap: the root is 1, the blocks begin at ``width``.
        self.least = np.full(2 * self.width, np.iinfo(np.int64).max)
        self.least[self.width :] = padded.reshape(-1, BLOCK).min(axis=1)
        for level in range(self.width.bit_length() - 1, 0, -1):
            low, high = 1 << (level - 1), 1 << level
            self.least[low:high] = self.least[high : 2 * high].reshape(-1, 2).min(axis=1)

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """The closing places of some opening ones: where the excess first falls below its value there."""
        target = self.excess[at] - 1
        found = self._first(at + 1, (at // BLOCK + 1) * BLOCK, target)
        rest = np.flatnonzero(found < 0)
        target, node = target[rest], self.width + at[rest] // BLOCK
        climbing = np.ones(len(rest), bool)
        while climbing.any():  # up to a right sibling that falls low enough
            here = np.flatnonzero(climbing & (node & 1 == 0))
            here = here[self.least[node[here] + 1] <= target[here]]
            climbing[here] = False
            node[here] += 1
            node[climbing] >>= 1
        while len(inner := np.flatnonzero(node < self.width)):  # down to its first block that does
            left = node[inner] << 1
            node[inner] = left + (self.least[left] > target[inner])
        begin = (node - self.width) * BLOCK
        found[rest] = self._first(begin, begin + BLOCK, target)
        return found

    def _first(self, begin: np.ndarray, end: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place from ``begin`` up to ``end`` where the excess is ``target``; -1 without one."""
        found = np.full(len(begin), -1)
        place = begin.copy()
        waiting = np.flatnonzero(place < end)
        while len(waiting):
            hit = self.padded[place[waiting]] == target[waiting]
            found[waiting[hit]] = place[waiting[hit]]
            waiting = waiting[~hit]
            place[waiting] += 1
            waiting = waiting[place[waiting] < end[waiting]]
        return found

    def rank_open(self, at: np.ndarray) -> np.ndarray:
        """Opening parentheses up to and with each place."""
        return np.cumsum(self.opens)[at]

    def rank_leaf(self, at: np.ndarray) -> np.ndarray:
        """``()`` pairs that begin before each place."""
        pairs = np.zeros(len(self.opens), np.int64)
        pairs[1:] = np.cumsum(self.opens[:-1] & ~self.opens[1:])
        return pairs[at]


def _between(own: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums of values over ranges, from their cumulative array."""
    total = np.concatenate([[0], np.cumsum(own)])
    return total[end] - total[begin]


class Shard:
    """Takes sorted records; ``finish`` gives its nodes and, unless it holds all records, its spines."""

    def __init__(self) -> None:
        self.opens: list[bool] = []
        self.up: list[int] = []
        self.steps: list[tuple[int, int, int]] = []  # key and words of each node
        self.depth: list[int] = []
        self.trail: list[int] = []  # nodes of the path being visited
        self.first: list[int] = []  # nodes of the first record's path
        self.values: list[tuple] = []
        self.turns = 0

    def add(self, path: list[tuple[int, int, int]], values: list[tuple]) -> None:
        shared, most = 0, min(len(self.trail), len(path))
        while shared < most and self.steps[self.trail[shared]] == path[shared]:
            shared += 1
        self.opens += [False] * (len(self.trail) - shared)
        del self.trail[shared:]
        for step in path[shared:]:
            self.up.append(self.trail[-1] if self.trail else -1)
            self.depth.append(len(self.trail))
            self.trail.append(len(self.steps))
            self.steps.append(step)
            self.opens.append(True)
        self.values += [(node, *value) for node, value in zip(reversed(self.trail), reversed(values), strict=False)]
        self.first = self.first or list(self.trail)
        self.turns += len(path)

    def is_full(self, turns: int) -> bool:
        return self.turns >= max(turns, SHARD_PATHS // 2 * (len(self.first) + len(self.trail)))

    def finish(self, whole: bool) -> tuple[list[tuple], list[tuple]]:
        """Finished nodes and records of the spines; with ``whole``, all nodes are finished."""
        count = len(self.steps)
        nodes = Parentheses(np.array(self.opens + [False] * len(self.trail)))
        at = np.flatnonzero(nodes.opens)
        close = nodes.find_close(at)
        begin, end = np.arange(count), nodes.rank_open(close)
        up, depth = np.array(self.up), np.array(self.depth)
        key = np.array([step[:2] for step in self.steps], np.int64)
        words = np.array([step[2] for step in self.steps], np.int64)

        own = np.array(self.values, np.int64)
        members, below, leaves, saved = (np.zeros(count, np.int64) for _ in range(4))
        for values, column in ((members, 1), (below, 3), (leaves, 4), (saved, 5)):
            np.add.at(values, own[:, 0], own[:, column])
        smallest = np.full(count, np.iinfo(np.int64).max)
        np.minimum.at(smallest, own[:, 0], own[:, 2])

        spine = np.zeros(count, bool)
        if not whole:
            spine[self.first + self.trail] = True
        inner = np.flatnonzero(~spine)
        inner = inner[inner > 0]  # the root is nobody's child

        n_convs = _between(members, begin, end)
        n_children = below + np.bincount(up[1:], minlength=count)
        childless_here = end == begin + 1
        n_leaves = nodes.rank_leaf(close) - nodes.rank_leaf(at) + _between(
            leaves - (childless_here & (below > 0)), begin, end
        )
        own_saved = np.where(spine, 0, (n_convs - 1) * words) + saved
        saved_tokens = _between(own_saved, begin, end)
        by_depth = inner[np.argsort(-depth[inner], kind="stable")]
        cuts = np.flatnonzero(np.diff(depth[by_depth])) + 1
        for level in np.split(by_depth, cuts):  # from the deepest nodes up
            np.minimum.at(smallest, up[level], smallest[level])

        done = np.flatnonzero(~spine)
        finished = [
            (
                int(depth[n]), int(key[n, 0]), int(key[n, 1]),
                *((None, None) if n == 0 else map(int, key[up[n]])),
                int(smallest[n]),
                None if n == 0 or spine[up[n]] else int(smallest[up[n]]),
                int(n_convs[n]), int(n_children[n]), int(n_leaves[n]), int(saved_tokens[n]),
            )
            for n in done
        ]
        # Spines take up what is finished right below them.
        under = inner[spine[up[inner]]]
        for values, result in ((members, n_convs), (leaves, n_leaves), (saved, saved_tokens), (below, np.ones(count, int))):
            np.add.at(values, up[under], result[under])
        columns = (members, smallest, below, leaves, saved)
        own_values = dict(zip(np.flatnonzero(spine).tolist(), zip(*(c[spine].tolist() for c in columns), strict=True), strict=True))
        passed = []
        for path in (self.first, self.trail) if not whole else ():
            values = [own_values.pop(n, (0, _NO_ID, 0, 0, 0)) for n in path]  # each node's are told once
            if any(v != (0, _NO_ID, 0, 0, 0) for v in values):
                passed.append(([self.steps[n] for n in path], values))
        return finished, passed


def _listed(column: pa.Array) -> Iterator[list[tuple]]:
    """Lists of structs as lists of tuples."""
    flat = column.flatten()
    items = list(zip(*(flat.field(i).to_pylist() for i in range(flat.type.num_fields)), strict=True))
    begin = 0
    for length in np.diff(column.offsets.to_numpy()).tolist():
        yield items[begin : begin + length]
        begin += length


def _structs(lists: list[list[tuple] | None], names: tuple[str, ...]) -> pa.Array:
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in names]))
    return pa.array([None if row is None else [dict(zip(names, x, strict=True)) for x in row] for row in lists], kind)


def _round(records: DataFrame, turns: int, shard_turns: int) -> DataFrame:
    """Finished nodes (``done``) and the records of spines of one round."""
    shards = -(-turns // shard_turns)
    whole = shards == 1
    dealt = records.repartition(1) if whole else records.repartitionByRange(shards, "path")
    node_names = [part.split()[0] for part in _NODE.split(", ")]

    def table(nodes: list[tuple], passed: list[tuple]) -> pa.RecordBatch:
        rows = [*nodes, *[(None,) * len(node_names)] * len(passed)]
        done = [True] * len(nodes) + [False] * len(passed)
        paths, values = ([None] * len(nodes) + [p[i] for p in passed] for i in (0, 1))
        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(done),
                *columns,
                _structs(paths, ("a", "b", "w")),
                _structs(values, ("members", "first_id", "children", "leaves", "saved")),
            ],
            ["done", *node_names, "path", "values"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for batch in batches:
            for path, values in zip(_listed(batch.column(0)), _listed(batch.column(1)), strict=True):
                if not whole and shard.steps and shard.is_full(shard_turns):
                    yield table(*shard.finish(False))
                    shard = Shard()
                shard.add(path, values)
        if shard.steps:
            yield table(*shard.finish(whole))

    return dealt.sortWithinPartitions("path").mapInArrow(run, f"done boolean, {_NODE}, {_RECORD}")


def rebuilt(
    conversations: DataFrame, every: int = 20, most: int = 4, names: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text")
) -> DataFrame:
    """``conv_id``, ``turns`` (digest, w): conversations that begin with turns of another one.

    Conversation c takes its first ``crc32(c) % most`` turns from conversation ``c - c % every``, if
    that exists and has them, and goes on with its own turns after as many. Turns are ordered by number, a missing one
    first, equal ones by role and digest. ``w`` counts a turn's words. Rows without a conversation id
    belong to none.
    """
    conv_id, turn, role, text = (F.col(n) for n in names)
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.select(
        conv_id.cast("long").alias("conv_id"),
        F.struct(
            turn.cast("long").alias("turn"),
            role.alias("role"),
            F.unhex(F.sha2(told, 256)).alias("digest"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("w"),
        ).alias("t"),
    ).filter("conv_id IS NOT NULL")
    own = (
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("t"))
        .select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["w"].alias("w"))).alias("t"))
    )
    heads = own.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("from_id"), F.slice("t", 1, max(most - 1, 1)).alias("head")
    )
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    shaped = own.select("conv_id", "t", taken.cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("from_id"))
    none = F.array().cast("array<struct<digest:binary,w:bigint>>")
    first = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    rest = F.slice("t", F.col("h") + 1, F.greatest(F.size("t") - F.col("h"), F.lit(0)))
    return shaped.join(heads, "from_id", "left").select("conv_id", F.concat(first, rest).alias("turns"))


def _paths(conversations: DataFrame) -> DataFrame:
    """``conv_id``, key ``a``, ``b`` of the node a conversation ends at, and the ``path`` to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, paths = [], []
            for turns in batch.column(1).to_pylist():
                key, path = b"", [ROOT]
                for turn in turns:
                    key = hashlib.sha256(key + turn["digest"]).digest()[:16]
                    a, b = struct.unpack(">qq", key)
                    path.append((a, b, turn["w"]))
                ends.append(path[-1])
                paths.append(path)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([e[0] for e in ends], pa.int64()),
                    pa.array([e[1] for e in ends], pa.int64()),
                    _structs(paths, ("a", "b", "w")),
                ],
                ["conv_id", "a", "b", "path"],
            )

    return conversations.select("conv_id", "turns").mapInArrow(run, f"conv_id long, a long, b long, path {_PATH}")


def _end_digests(ends: DataFrame) -> DataFrame:
    """``a``, ``b``, ``ends_sha256``: SHA-256 of the ascending ids that end at a node, joined by commas.

    Ids are sorted over all tasks and joined to chunks first, so the task that hashes the ids of a
    node, in order, reads few rows, one at a time.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        node, ids, size = None, [], 0

        def close() -> None:
            if ids:
                held.append((*node, ids[0], ",".join(map(str, ids)).encode()))

        def table() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["a", "b", "first", "ids"])

        for batch in batches:
            for a, b, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if node != (a, b) or size >= CHUNK:
                    close()
                    node, ids, size = (a, b), [], 0
                ids.append(conv_id)
                size += 20
            if held:
                yield table()
                held = []
        close()
        if held:
            yield table()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, found = None, None, []

        def table() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string())
            columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["a", "b", "ends_sha256"])

        for batch in batches:
            for a, b, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if node == (a, b):
                    state.update(b",")
                else:
                    if node:
                        found.append((*node, state.hexdigest()))
                    node, state = (a, b), hashlib.sha256()
                state.update(ids)
            if found:
                yield table()
                found = []
        if node:
            found.append((*node, state.hexdigest()))
            yield table()

    sorted_ids = ends.select("a", "b", "conv_id").repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    joined = sorted_ids.mapInArrow(chunks, "a long, b long, first long, ids binary")
    by_node = joined.repartition("a", "b").sortWithinPartitions("a", "b", "first")
    return by_node.mapInArrow(digests, "a long, b long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per node of the trie of ``conversations`` (distinct ``conv_id``; ``turns``: digest, w).

    ``depth``, the node's key ``a`` and ``b``, ``conv_id`` (smallest member), ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` (words that need not be read again, over the
    subtree), ``ends_sha256``. A conversation without turns is a member of the root only. Without
    any conversation there is no node, nor a root.
    """
    paths = stored(_paths(conversations), "paths")
    zero = F.lit(0).cast("long")
    own = (F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("first_id"))
    others = (zero.alias(name) for name in ("children", "leaves", "saved"))
    records = stored(
        paths.groupBy("path").agg(*own).select("path", F.array(F.struct("members", "first_id", *others)).alias("values")),
        "records",
    )
    nodes, spines = None, None
    length = F.size("path").cast("long")
    while (held := records.agg(F.sum(length).alias("turns"), F.max(length).alias("longest")).first())["turns"]:
        result = stored(_round(records, held["turns"], max(shard_turns, SHARD_PATHS * held["longest"])), "nodes")
        done = result.filter("done").select([part.split()[0] for part in _NODE.split(", ")])
        if nodes is None:
            nodes = done
        else:
            nodes = nodes.unionByName(done)
            spines = done if spines is None else spines.unionByName(done)
        records = result.filter("NOT done").select("path", "values")
        shard_turns *= 2  # small tasks pass on more; one shard holds the rest some time
    if nodes is None:
        nodes = records.sparkSession.createDataFrame([], _NODE)
    if spines is not None:
        over = spines.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("spine_id"))
        over = F.broadcast(over) if over.count() <= BROADCAST_NODES else over
        nodes = nodes.join(over, ["up_a", "up_b"], "left").withColumn("up_id", F.coalesce("up_id", "spine_id"))
    empty = hashlib.sha256().hexdigest()
    return nodes.join(_end_digests(paths), ["a", "b"], "left").select(
        "conv_id",
        "depth",
        F.col("up_id").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
        "a",
        "b",
    )
