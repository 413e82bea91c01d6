"""Benchmark decontamination with a positional inverted index of the training texts.

**Index.** A row per training text holds its posting lists: for each term the ascending positions at
which it stands. So the index is spread over the texts, and a very common term is spread with
them. Only terms of the test items are listed, as no other term can be part of a match.

**Matching.** A window is some consecutive words of a test item. In a text that has the window's
rarest term, that term's positions, less its place in the window, are the places where the window
may begin. They are intersected with the lists of the other terms, shifted likewise, from rare to common,
until none is left or all terms have been seen: what is left are exact phrase matches. With a
``slop``, a place stays when each other term stands at most so many words from where it should:
proximity matches.

All steps are column expressions. Positions count from 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

#: Consecutive words of a test item that make a window.
WINDOW = 10
#: What separates words: all of ASCII but digits and letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Stands before the first word of every text, so that each text has a row in the index; it is no word.
_HEAD = " "
#: Tables made from the test items are broadcast up to this size, and joined by a shuffle beyond it.
BROADCAST_BYTES = 64 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text as they are written; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BETWEEN), "")


def lowered(word: Column) -> Column:
    """A to Z in lower case, all else as it is."""
    ascii_only = F.octet_length(word) == F.length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, _UPPER, _LOWER))


def item_windows(
    items: DataFrame, window: int = WINDOW, id_column: str = "item_id", text_column: str = "text"
) -> DataFrame:
    """``phrase`` (words joined by spaces), ``item`` (the id as text, empty for null): windows of test items.

    An item of fewer than ``window`` words is one window, one without words has none. Equal windows
    of an item count once.
    """
    cut = items.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item"),
        F.transform(words(F.col(text_column).cast("string")), lowered).alias("w"),
    ).filter("size(w) > 0")
    last = F.greatest(F.size("w") - F.lit(window - 1), F.lit(1))
    begun = cut.select("item", "w", F.explode(F.sequence(F.lit(1), last)).alias("begin"))
    phrase = F.array_join(F.slice("w", F.col("begin"), F.lit(window)), " ")
    return begun.select(phrase.alias("phrase"), "item").distinct()


def vocabulary(windows: DataFrame) -> DataFrame:
    """``word``, ``term`` (a number of its own) of all words in ``windows``, and of the head of texts."""
    listed = windows.select("phrase").distinct().select(F.explode(F.split("phrase", " ")).alias("word"))
    head = windows.sparkSession.createDataFrame([(_HEAD,)], "word string")
    return stored(
        listed.distinct().unionByName(head).withColumn("term", F.monotonically_increasing_id()), "terms"
    )


def if_small(df: DataFrame, size: Column) -> DataFrame:
    """The table, marked for broadcasting if the measured ``size`` in bytes of all its rows is within the bound."""
    total = df.agg(F.sum(size + F.lit(64)).alias("total")).first()["total"] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def positional_index(
    docs: DataFrame, terms: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """A row per row of ``docs``: ``row`` (its number), ``doc_id``, ``n_words``, ``postings`` (term to positions).

    Texts are dealt out by row number first, so that a text's words meet again without another
    shuffle. The index is a written table.
    """
    dealt = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    ).repartition("row")
    cut = dealt.select("row", "doc_id", words(F.col("text")).alias("w"))
    placed = cut.select(
        "row", "doc_id", F.size("w").cast("long").alias("n_words"), F.posexplode(F.concat(F.array(F.lit(_HEAD)), "w"))
    )
    known = if_small(terms, F.octet_length("word"))
    found = placed.withColumn("word", lowered(F.col("col"))).join(known, "word")
    lists = found.groupBy("row", "doc_id", "n_words", "term").agg(F.sort_array(F.collect_list("pos")).alias("at"))
    index = lists.groupBy("row", "doc_id", "n_words").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "at"))).alias("postings")
    )
    return stored(index, "postings")


def by_rarity(index: DataFrame, windows: DataFrame, terms: DataFrame) -> DataFrame:
    """``phrase``, ``parts``: term, place in the window and number of postings, rare terms first.

    Windows with a term that no text has are left out.
    """
    counts = (
        index.select(F.explode("postings").alias("term", "at"))
        .groupBy("term")
        .agg(F.sum(F.size("at").cast("long")).alias("n"))
    )
    counted = if_small(terms.join(counts, "term"), F.octet_length("word"))
    placed = windows.select("phrase").distinct().select("phrase", F.posexplode(F.split("phrase", " ")).alias("o", "word"))
    return (
        placed.join(counted, "word", "left")
        .groupBy("phrase")
        .agg(F.array_sort(F.collect_list(F.struct("n", "o", "term"))).alias("parts"), F.min(F.col("n").isNotNull()).alias("all"))
        .filter("all")
        .drop("all")
    )


def matches(index: DataFrame, windows: DataFrame, terms: DataFrame, slop: int = 0) -> DataFrame:
    """``row``, ``phrase``, ``n`` (its words), ``starts``: where windows stand in the indexed texts.

    ``starts`` are places of the window's first word. With a ``slop``, they are reckoned from the
    window's rarest term, and each other term may stand up to ``slop`` words off its own place.
    """
    ordered = by_rarity(index, windows, terms)
    seeds = ordered.groupBy(F.col("parts")[0]["term"].alias("term")).agg(
        F.collect_list(F.struct("phrase", "parts")).alias("windows")
    )
    sought = if_small(
        stored(seeds, "seeds"), F.aggregate("windows", F.lit(0), lambda a, w: a + F.octet_length(w["phrase"]) + 32 * F.size(w["parts"]))
    )

    def shifted(part: Column) -> Column:
        return F.transform(F.coalesce(F.col("postings")[part["term"]], F.array().cast("array<int>")), lambda p: p - part["o"])

    def narrowed(starts: Column, part: Column) -> Column:
        if not slop:
            return F.array_intersect(starts, shifted(part))
        return F.filter(starts, lambda s: F.exists(shifted(part), lambda q: F.abs(q - s) <= slop))

    def starts(window: Column) -> Column:
        parts = window["parts"]
        return F.aggregate(
            F.slice(parts, F.lit(2), F.size(parts)),
            shifted(parts[0]),
            lambda left, part: F.when(F.size(left) == 0, left).otherwise(narrowed(left, part)),
        )

    candidates = index.select("row", "postings", F.explode(F.map_keys("postings")).alias("term")).join(sought, "term")
    found = candidates.select(
        "row",
        F.explode(
            F.filter(
                F.transform("windows", lambda w: F.struct(w["phrase"].alias("phrase"), F.size(w["parts"]).alias("n"), starts(w).alias("starts"))),
                lambda m: F.size(m["starts"]) > 0,
            )
        ).alias("m"),
    )
    return found.select("row", "m.*")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``items`` per row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of a window, ``items`` lists the ids, as
    text and sorted, of the items that have an occurring window. A null text has no words; a null id stays null;
    repeated rows stay, each with its own result; an empty table gives an empty result. Items that
    share an id count as one, those without id have the empty text as id; an empty benchmark hits
    nothing. Other columns of either table are not read.
    """
    windows = stored(item_windows(benchmark, window, item_column, item_text), "windows")
    terms = vocabulary(windows)
    index = positional_index(docs, terms, id_column, text_column)
    found = stored(matches(index, windows, terms), "matches")
    inside = F.flatten(F.transform("starts", lambda s: F.sequence(s, s + F.col("n") - 1)))
    hit = (
        found.select("row", F.explode(inside).alias("at")).distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    )
    named = if_small(windows, F.octet_length("phrase") + F.octet_length("item"))
    items = (
        found.select("row", "phrase")
        .join(named, "phrase")
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    return (
        index.select("row", "doc_id", "n_words")
        .join(hit, "row", "left")
        .join(items, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )
