import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm.prefix_trie import Parentheses, prefix_trie, rebuilt
from tidemark.llm.queries import QUERIES
from tests.llm.tests_llm_rows import collected

ROWS = "conv_id long, turn long, role string, text string, path string, a long, h int, w string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2, "w") for r in rows], ROWS)


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def conversations(rows):
    """Rebuilt turns of each conversation."""
    told = {}
    for c, turn, role, text in rows:
        if c is not None:
            told.setdefault(c, []).append((turn is not None, turn or 0, role or "", digest(role or "", text or ""), text or ""))
    told = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in told.items()}
    out = {}
    for c, turns in told.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = told.get(c - (abs(c) % 20) * (1 if c > 0 else -1), [])[:h] + turns[h:]
    return out


def wanted(rows):
    built, members, ends = conversations(rows), {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for path, ids in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(ids) - 1) * words
            leaves[path[:d]] += path not in children
    return sorted(
        (
            (
                min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), len(children.get(path, [])),
                leaves[path], saved[path],
                hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest(),
            )
            for path, ids in members.items()
        ),
        key=repr,
    )


@pytest.fixture(scope="module")
def told():
    """Few texts, so that conversations share turns; a very common one; odd rows."""
    rng = random.Random(8)
    rows = []
    for c in [*range(0, 150), *range(-30, 0), 10**12]:
        common = c % 3 == 0
        for turn in range(rng.randint(1, 7) if not common else 3):
            text = "the same turn" if common else rng.choice(["yes", "no", "well  then\n", "", None])
            rows.append((c, turn, rng.choice(["user", "assistant"]) if not common else "user", text))
    rows += [(7, None, "user", "first of all"), (7, None, None, "first of all"), (8, 1, "user", "tie"), (8, 1, "user", "tie two")]
    rows += [(9, 1, "user", "twice"), (9, 1, "user", "twice"), (None, 1, "user", "of none"), (200, 5, "user", "word " * 20_000)]
    rows += [(300, turn, "user", f"turn {turn}") for turn in range(300)]
    return rows


@pytest.mark.parametrize("shard_turns", [10, 60, 100_000])
def test_nodes_are_those_of_brute_force(spark, told, shard_turns):
    found = prefix_trie(rebuilt(frame(spark, told)), shard_turns).drop("a", "b")
    assert collected(found) == wanted(told)


def test_nodes_have_keys_of_their_own(spark, told):
    found = prefix_trie(rebuilt(frame(spark, told)), 200)
    assert found.count() == found.select("a", "b").distinct().count()


def test_empty_and_turnless(spark):
    assert collected(prefix_trie(rebuilt(frame(spark, []))).drop("a", "b")) == []
    short = [(c, 0, "user", "only turn") for c in range(1, 12)]  # some lose it, and there is no conversation 0
    assert any(not turns for turns in conversations(short).values())
    assert collected(prefix_trie(rebuilt(frame(spark, short)), 3).drop("a", "b")) == wanted(short)


def test_query_gives_brute_force_rows(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(QUERIES["op12_prefix_trie"](spark, sf_dir)) == wanted(rows)


@pytest.mark.parametrize("count", [1, 2, 31, 32, 33, 500, 3000])
def test_closing_places(count):
    rng = random.Random(count)
    opens, depth, left = [], 0, count
    while left or depth:
        if left and (depth == 0 or rng.random() < 0.5 + 0.3 * (count % 2)):
            opens.append(True)
            depth, left = depth + 1, left - 1
        else:
            opens.append(False)
            depth -= 1
    stack, wanted_close = [], {}
    for place, is_open in enumerate(opens):
        if is_open:
            stack.append(place)
        else:
            wanted_close[stack.pop()] = place
    nodes = Parentheses(np.array(opens))
    at = np.flatnonzero(opens)
    assert nodes.find_close(at).tolist() == [wanted_close[i] for i in at.tolist()]
    assert nodes.rank_open(at).tolist() == list(range(1, count + 1))
    pairs = [i for i in range(len(opens) - 1) if opens[i] and not opens[i + 1]]
    places = np.arange(len(opens))
    assert nodes.rank_leaf(places).tolist() == [sum(p < i for p in pairs) for i in places.tolist()]
