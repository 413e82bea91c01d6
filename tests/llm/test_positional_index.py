import random
import re

import pytest

from tidemark.llm import positional_index
from tidemark.llm.positional_index import contaminated, item_windows, matches, positional_index as index_of, vocabulary
from tests.llm.tests_llm_rows import collected

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string, row long, phrase string, term long, w string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def windows(items, size):
    found = {}
    for item, text in items:
        w = words(text)
        for s in range(max(len(w) - size + 1, 1) if w else 0):
            found.setdefault(tuple(w[s : s + size]), set()).add("" if item is None else str(item))
    return found


def wanted(docs, items, size):
    found, out = windows(items, size), []
    for doc, text in docs:
        w, hit, named = words(text), set(), set()
        for n in {len(k) for k in found}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in found:
                    hit |= set(range(s, s + n))
                    named |= found[tuple(w[s : s + n])]
        out.append((doc, len(w), len(hit), sorted(named)))
    return out


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, 7, "p", 8, "w") for i, t in items], ITEMS)


@pytest.fixture(scope="module")
def planted(spark):
    """Few words, so that windows overlap, repeat inside a text and have equally rare terms."""
    rng = random.Random(3)
    some = ["a", "b", "c", "Ünï", "ÉTÉ", "日本", "x1"]
    items = [(i, " ".join(rng.choice(some) for _ in range(rng.randint(1, 9)))) for i in range(12)]
    items += [(3, "b c b c b"), (None, "c C c c"), (20, None), (21, ""), (22, " .,! "), (4, items[4][1]), (4, items[4][1])]
    docs = [(i, ", ".join(rng.choice(some).upper() for _ in range(rng.randint(0, 80)))) for i in range(40)]
    docs += [(None, "a b c a b c a"), (None, None), (1, ""), (2, "..."), (5, docs[5][1]), (5, docs[5][1])]
    docs += [(60, " ".join(rng.choice(some) for _ in range(20_000)) + " " + items[0][1])]
    return docs, items


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 1, "p", 2) for i, t in docs], "doc_id long, text string, row long, word string, at int")


@pytest.mark.parametrize("size", [2, 4])
def test_windows_are_found_as_by_brute_force(spark, planted, size):
    docs, items = planted
    rows = collected(contaminated(frame(spark, docs), benchmark(spark, items), size))
    assert rows == sorted(wanted(docs, items, size), key=repr)


def test_shuffled_joins_give_the_same(spark, planted, monkeypatch):
    docs, items = planted
    monkeypatch.setattr(positional_index, "BROADCAST_BYTES", 0)
    rows = collected(contaminated(frame(spark, docs), benchmark(spark, items), 3))
    assert rows == sorted(wanted(docs, items, 3), key=repr)


def test_empty_tables(spark, planted):
    docs, items = planted
    assert collected(contaminated(frame(spark, docs).limit(0), benchmark(spark, items))) == []
    rows = collected(contaminated(frame(spark, docs), benchmark(spark, items).limit(0)))
    assert rows == sorted(((i, len(words(t)), 0, []) for i, t in docs), key=repr)


def test_capital_letters_beyond_a_to_z_stay(spark):
    docs, items = [(1, "ÉTÉ été"), (2, "été")], [(9, "été")]
    rows = collected(contaminated(frame(spark, docs), benchmark(spark, items)))
    assert rows == [(1, 2, 1, ["9"]), (2, 1, 1, ["9"])]


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_places_of_phrase_and_proximity_matches(spark, planted, slop):
    docs = [(n, text) for n, (_, text) in enumerate(planted[0]) if len(text or "") < 1000]
    items, size = planted[1], 3
    table = item_windows(benchmark(spark, items), size)
    terms = vocabulary(table)
    index = index_of(frame(spark, docs), terms)
    found = matches(index, table, terms, slop).join(index.select("row", "doc_id"), "row")
    got = {(r.doc_id, r.phrase): sorted(r.starts) for r in found.collect()}
    assert all(len(set(starts)) == len(starts) for starts in got.values())

    counts = {}
    for _, text in docs:
        for w in words(text):
            counts[w] = counts.get(w, 0) + 1
    near = {}
    for doc, text in docs:
        at = {}
        for place, w in enumerate(words(text), 1):
            at.setdefault(w, []).append(place)
        for phrase in windows(items, size):
            rare = min(range(len(phrase)), key=lambda o: (counts.get(phrase[o], 0), o))
            starts = [
                p - rare
                for p in at.get(phrase[rare], [])
                if all(any(abs(q - o - p + rare) <= slop for q in at.get(w, [])) for o, w in enumerate(phrase) if o != rare)
            ]
            if starts:
                near[doc, " ".join(phrase)] = starts
    assert got == near


def test_index_is_positional(spark):
    docs = [(1, "b a b"), (2, None), (3, "z")]
    terms = vocabulary(item_windows(benchmark(spark, [(1, "a b")])))
    names = {r.term: r.word for r in terms.collect()}
    rows = index_of(frame(spark, docs), terms).collect()
    lists = {r.doc_id: {names[t]: at for t, at in r.postings.items()} for r in rows}
    assert lists == {1: {" ": [0], "a": [2], "b": [1, 3]}, 2: {" ": [0]}, 3: {" ": [0]}}


def test_no_python_on_the_main_path(spark, planted):
    docs, items = planted
    plan = contaminated(frame(spark, docs), benchmark(spark, items))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow|ExternalRDD", plan)
