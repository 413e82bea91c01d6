"""Document fingerprints by winnowing, in column expressions alone.

The hash of every ``GRAM`` bytes of a text (UTF-8) rolls over it: a byte has a random number, which is shifted
by one bit for every byte that follows it, and a gram is the exclusive or of its bytes. All places are
rolled at once by doubling: a gram of 2n bytes at a place is the one of n bytes there, shifted by
n bits, and the one of n bytes n places on. Bits that grams of unlike bytes would share fall away with those of the
position, so each bit of a hash depends on every byte. Of every ``WINDOW`` hashes in a row the smallest is
kept, of equal ones the rightmost, with its position. So two texts that share ``GRAM + WINDOW - 1``
bytes share a kept hash, and no match shorter than ``GRAM`` is seen. (Schleimer, Wilkerson and Aiken,
"Winnowing: Local Algorithms for Document Fingerprinting", 2003.)

Hash and position are packed into one number, whose minimum is the wanted one; the minimum over a
window is taken in doubling steps. Long texts are worked on in spans, so that intermediate arrays
stay small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.ranges import begins, place_bounds, place_of, range_of
from tidemark.llm.tables import NO_ID, given_id, known_id

GRAM = 16
#: Hashes in a window: a power of two.
WINDOW = 16
#: Windows worked on at once.
SPAN = 1 << 14
_PLACE_BITS = 16
_PLACES = (1 << _PLACE_BITS) - 1


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def winnow(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """Kept (``hash``, ``position``) of a text, in order of position; positions count bytes.

    A text shorter than a gram is hashed whole; one with fewer grams than a window has one window.
    An empty text keeps nothing, a null one counts as empty.
    """
    if window & (window - 1) or SPAN + window > 1 << _PLACE_BITS:
        raise ValueError("the window must be a power of two that fits a span")
    if gram & (gram - 1) or not 0 < gram <= _PLACE_BITS:
        raise ValueError(f"the gram must be a power of two up to {_PLACE_BITS}")
    data = F.coalesce(text.cast("binary"), F.lit("").cast("binary"))

    def of_bytes(data: Column) -> Column:
        grams = F.greatest(F.octet_length(data) - gram + 1, F.lit(1))
        last_span = F.floor(F.greatest(grams - window, F.lit(0)) / SPAN).cast("int")

        def of_span(span: Column) -> Column:
            first = span * SPAN
            end = F.least(grams, first + SPAN + window - 1)

            # Low bits fall along the span, so that of equal hashes the rightmost is the smallest number.
            def packed_from(rolled: Column) -> Column:
                return F.transform(
                    F.slice(rolled, 1, end - first),
                    lambda h, i: h.bitwiseAND(F.lit(~_PLACES)).bitwiseOR((_PLACES - i).cast("long")),
                )

            last_byte = F.least(end + (gram - 1), F.octet_length(data))
            packed = _let(_rolled(data, first + 1, last_byte, gram), packed_from)
            step, least = 1, packed
            while step < window:
                least = F.transform(F.array(least), _halving(step))[0]
                step *= 2
            # Windows at the end that reach beyond the grams are no windows, unless there is no other.
            full = F.slice(least, 1, F.greatest(end - first - window + 1, F.lit(1)))
            return F.transform(
                F.array_distinct(full),
                lambda p: F.struct(
                    F.shiftright(p, _PLACE_BITS).alias("hash"),
                    (first + _PLACES - p.bitwiseAND(F.lit(_PLACES))).cast("int").alias("position"),
                ),
            )

        spans = F.transform(F.sequence(F.lit(0), last_span), of_span)
        # Kept places never fall, so a gram kept on both sides of a span's end stands there twice in a row.
        joined = F.transform(
            F.array(F.flatten(spans)),
            lambda kept: F.filter(
                kept, lambda k, i: (i == 0) | (F.get(kept, i - 1)["position"] != k["position"])
            ),
        )[0]
        return F.when(last_span > 0, joined).otherwise(F.get(spans, F.lit(0)))

    empty = F.array().cast("array<struct<hash:bigint,position:int>>")
    return F.when(F.octet_length(data) > 0, _let(data, of_bytes)).otherwise(empty)


def _rolled(data: Column, first: Column, last: Column, gram: int) -> Column:
    """Hash of the ``gram`` bytes from each place on, ``first`` to ``last``, null where fewer follow.

    The bytes that a short text lacks count as zero, so that its first place has a hash.
    """
    numbers = F.transform(F.sequence(first, last), lambda i: F.xxhash64(F.substr(data, i, F.lit(1))))
    lacking = F.lit(gram - 1) - (last - first)
    zeros = F.array_repeat(F.lit(0).cast("long"), lacking)
    values = F.when(lacking > 0, F.concat(numbers, zeros)).otherwise(numbers)
    bytes_done = 1
    while bytes_done < gram:
        values = F.transform(F.array(values), _doubling(bytes_done))[0]
        bytes_done *= 2
    return values


def _doubling(done: int):
    def twice(values: Column) -> Column:
        following = F.slice(values, done + 1, F.greatest(F.size(values) - done, F.lit(0)))
        return F.zip_with(values, following, lambda a, b: F.shiftleft(a, done).bitwiseXOR(b))

    return twice


def _halving(step: int):
    def smaller(values: Column) -> Column:
        # Beyond the end there is nothing to compare with; least() leaves nulls out.
        return F.zip_with(values, F.slice(values, step + 1, F.greatest(F.size(values) - step, F.lit(0))), lambda a, b: F.least(a, b))

    return smaller


def hashes(kept: Column) -> Column:
    return F.array_distinct(F.transform(kept, lambda k: k["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two sets, from 0 to 1; two empty sets are alike."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        _let(shared, lambda n: n / (F.size(a) + F.size(b) - n))
    )


def digest(kept: Column) -> Column:
    """32 hex digits that tell fingerprints apart, positions included."""
    return F.lower(F.concat(*(F.lpad(F.hex(F.xxhash64(F.lit(seed), kept)), 16, "0") for seed in (1, 2))))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``next_text``, that of the next document in ascending id, after the last the first.

    Documents are dealt by ranges of ids, and of a frequent id by ranges of a hash of the text. The
    first document of a range is copied to the range before, so that every row finds its next one in
    its own range, after one shuffle of the texts. Equal ids are ordered by that hash and their texts;
    a missing id comes first; null texts count as empty.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(known_id("doc_id").alias("doc_id"), text.alias("text")).withColumn("content", F.xxhash64("text"))
    bounds = place_bounds(rows, "doc_id", "content")
    smallest = rows.agg(F.min("doc_id").alias("doc_id")).first()["doc_id"]
    # Asked of the column as it is, so that the scan can leave out other rows.
    leading = F.col("doc_id") == F.lit(smallest).cast("long")
    leading = leading | F.col("doc_id").isNull() if smallest == NO_ID else leading
    first = docs.filter(leading).agg(F.min(F.xxhash64(text)).alias("content")).first()["content"]
    placed = rows.withColumn("at", place_of(F.col("doc_id"), F.col("content"))).withColumn("own", range_of(F.col("at"), bounds))
    copies = [F.struct(F.col("own").alias("range"), F.lit(0).alias("copy"))]
    if bounds:
        bound = F.get(F.lit(bounds) if len(bounds) > 1 else F.array(F.lit(bounds[0])), F.col("own") - 1)
        opens = (F.col("own") > 0) & begins(F.col("at"), bound)
        copies.append(F.when(opens, F.struct((F.col("own") - 1).alias("range"), F.lit(1).alias("copy"))))
    wraps = (F.col("doc_id") == F.lit(smallest).cast("long")) & (F.col("content") == F.lit(first).cast("long"))
    copies.append(F.when(wraps, F.struct(F.lit(len(bounds)).alias("range"), F.lit(1).alias("copy"))))
    dealt = placed.select(
        "doc_id", "content", "text", F.explode(F.filter(F.array(*copies), lambda c: c.isNotNull())).alias("place")
    )
    flat = dealt.select("doc_id", "content", "text", "place.range", "place.copy")
    return flat.withColumn("next_text", F.lead("text").over(_in_order()))


def _in_order() -> Window:
    """Within a range; the copy of the next range's first document comes last."""
    return Window.partitionBy("range").orderBy("copy", "doc_id", "content", "text")


def _kept(value: Column, position: Column) -> Column:
    return F.struct(value.alias("hash"), position.cast("int").alias("position"))


def spliced(
    kept: Column, next_kept: Column, text: Column, head: Column, tail: Column, gram: int, window: int
) -> Column:
    """What winnowing keeps of ``text``, which is ``head`` and ``tail``, the first parts of two texts.

    ``kept`` and ``next_kept`` belong to those two. Away from the seam and the end, every window of the
    text is one of theirs, so only the bytes near both are hashed anew. Short parts are done whole.
    """
    reach = gram + window - 1
    data = text.cast("binary")
    seam = F.octet_length(head)
    end = F.octet_length(head) + F.octet_length(tail)

    def near(first: Column, last: Column, low: Column, high: Column) -> Column:
        """Kept at places from ``low`` to ``high``, found from the bytes ``first`` to ``last``."""
        found = winnow(F.substr(data, first + 1, last - first), gram, window)
        moved = F.transform(found, lambda k: _kept(k["hash"], k["position"] + first))
        return F.filter(moved, lambda k: (k["position"] >= low) & (k["position"] <= high))

    moved = F.transform(next_kept, lambda k: _kept(k["hash"], k["position"] + seam))
    joined = F.concat(
        F.filter(kept, lambda k: k["position"] <= seam - reach),
        near(seam - 2 * reach, seam + 2 * reach, seam - reach + 1, seam + window - 2),
        F.filter(moved, lambda k: (k["position"] >= seam + window - 1) & (k["position"] <= end - reach)),
        near(end - 3 * reach, end, end - reach + 1, end),
    )
    long_enough = (F.octet_length(head) >= 4 * reach) & (F.octet_length(tail) >= 4 * reach)
    return F.when(long_enough, joined).otherwise(winnow(text, gram, window))


def compare_edited(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of each text, of the text with its end replaced, and how alike they are.

    Per row of ``docs`` (doc_id, text): ``doc_id``, ``n_chars``, ``edited_text``, ``kept``,
    ``edited_kept``, ``near_edited``, ``near_next``. The edited text has its last half replaced by as
    many first characters of the next document, or all it has. An only document is its own next.
    Null texts count as empty, whose fingerprints keep nothing; a missing id comes before all others
    and is returned as null; rows that share an id are ordered by their texts' hashes, repeated rows
    have equal fingerprints. An empty table gives an empty result. Other columns are not read.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    return (
        with_next(docs)
        .withColumn("kept", winnow(F.col("text"), gram, window))
        .withColumn("next_kept", F.lead("kept").over(_in_order()))
        .filter("copy = 0")
        .withColumn("head", F.substring(F.col("text"), F.lit(1), F.length("text") - half))
        .withColumn("tail", F.substring(F.col("next_text"), F.lit(1), half))
        .withColumn("edited_text", F.concat("head", "tail"))
        .withColumn(
            "edited_kept",
            spliced(
                F.col("kept"), F.col("next_kept"), F.col("edited_text"), F.col("head"), F.col("tail"), gram, window
            ),
        )
        .withColumn("hashes", hashes(F.col("kept")))
        .select(
            given_id(F.col("doc_id")).alias("doc_id"),
            F.length("text").cast("long").alias("n_chars"),
            "edited_text",
            "kept",
            "edited_kept",
            likeness(F.col("hashes"), hashes(F.col("edited_kept"))).alias("near_edited"),
            likeness(F.col("hashes"), hashes(F.col("next_kept"))).alias("near_next"),
        )
    )
