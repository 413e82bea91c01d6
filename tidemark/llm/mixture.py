"""Mixing documents to target weights through a tree of domains, languages and sources.

The budget of tokens is handed down the tree. At a node it is shared among the children by weight; a
child that cannot use its share, because its documents are used up, leaves the rest to its
siblings, again by weight. As a child can use what all leaves below it can, a shortage is made up
among siblings first and reaches an ancestor only when its whole branch is used up. A leaf may use
its documents up to ``epochs`` times. Each epoch has its own order, by a hash of seed, epoch and
document; all but the last are used whole, and of the last the documents whose tokens begin within
what is left of the leaf's budget.

A level is filled for all nodes at once: siblings are sorted by the level at which they are used up,
and running sums give the level that spends the budget. Only leaves, not documents, meet in one
window. Of the documents, sums over buckets of the order's hash are formed first, and only the one
bucket of a leaf where its budget ends is put in order row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import given_id, known_id, packed, stored

LEVELS = ("domain", "lang", "source")
BUCKETS = 4096


@dataclass(frozen=True)
class Mixture:
    """Weights by name for each level of :data:`LEVELS`; names that are not listed weigh ``other``.

    ``share`` is the budget as a part of all tokens there are, ``epochs`` how often a document may be used.
    """

    domain: dict[str, int]
    lang: dict[str, int]
    source: dict[str, int]
    share: float = 0.5
    epochs: int = 2
    other: int = 1
    seed: int = 17


#: The mixture of the driver's tables: sources with an even number are taken as the domain "web".
DEFAULT = Mixture(
    domain={"web": 6, "books": 4},
    lang={"en": 5, "de": 2, "fr": 2, "es": 1},
    source={"src0": 1, "src1": 3, "src2": 3, "src3": 2},
    share=0.5,
)


def domain_of(source: Column) -> Column:
    return F.when(F.regexp_extract(source, "([0-9])$", 1).isin("0", "2", "4", "6", "8"), "web").otherwise("books")


def tokens_of(text: Column) -> Column:
    """Words between white space: what budgets count, at least one per document."""
    return F.greatest(F.size(F.split(F.trim(text), "[ \\t-\\r]+")), F.lit(1)).cast("long")


def order_of(seed: int, epoch: Column, doc_id: Column) -> Column:
    """A document's place in an epoch: 40 bits of a hash that other systems have too."""
    name = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), doc_id.cast("string"))
    return F.conv(F.substring(F.md5(name), 1, 10), 16, 10).cast("long")


def _weight(name: str, weights: dict[str, int], other: int) -> Column:
    found = F.lit(other)
    for key, weight in weights.items():
        found = F.when(F.col(name) == key, F.lit(weight)).otherwise(found)
    return found.cast("double")


def _fill(nodes: DataFrame, parent: tuple[str, ...]) -> DataFrame:
    """``given`` per node: the parent's budget ``budget`` by ``weight``, no more than ``room``."""
    full_at = F.when(F.col("weight") > 0, F.col("room") / F.col("weight")).otherwise(F.lit(float("inf")))
    order = Window.partitionBy(*parent).orderBy("full_at", *LEVELS[: len(parent) + 1])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # Siblings that are used up before this one leave ``left`` to it and those after it.
    left = F.col("budget") - F.coalesce(F.sum("room").over(before), F.lit(0))
    level = F.when(F.sum("weight").over(rest) > 0, left / F.sum("weight").over(rest)).otherwise(F.lit(0.0))
    sized = nodes.withColumn("full_at", full_at).withColumn("level", level).withColumn("nth", F.row_number().over(order))
    # The first sibling that is not used up tells the level of it and all after it.
    first_open = F.min(F.when(F.col("level") < F.col("full_at"), F.struct("nth", "level")))
    return (
        sized.withColumn("open_at", first_open.over(Window.partitionBy(*parent)))
        .withColumn(
            "given",
            F.when(F.col("open_at").isNull() | (F.col("nth") < F.col("open_at.nth")), F.col("room"))
            .otherwise(F.floor(F.col("open_at.level") * F.col("weight")).cast("long")),
        )
        .drop("full_at", "level", "open_at", "nth")
    )


def budgets(leaves: DataFrame, mixture: Mixture) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens) with ``given``, the tokens of each.

    Null names are names of their own and weigh ``other``. Weights of zero give nothing: a leaf with
    one on its path has no room, so no budget is handed down to it or kept for it further up.
    """
    used = F.lit(True)
    for name in LEVELS:
        used = used & (_weight(name, getattr(mixture, name), mixture.other) > 0)
    supply = leaves.withColumn("room", F.when(used, F.col("tokens") * mixture.epochs).otherwise(F.lit(0)))
    total = leaves.agg(F.floor(F.sum("tokens") * mixture.share).cast("long").alias("budget"))
    above = total
    for depth, name in enumerate(LEVELS):
        path = LEVELS[: depth + 1]
        weight = _weight(name, getattr(mixture, name), mixture.other)
        nodes = supply.groupBy(*path).agg(F.sum("room").alias("room")).withColumn("weight", weight)
        if depth == 0:
            nodes = nodes.crossJoin(F.broadcast(above))  # one row
        else:
            on = [nodes[p].eqNullSafe(above[f"_{p}"]) for p in LEVELS[:depth]]
            condition = on[0]
            for more in on[1:]:
                condition = condition & more
            nodes = nodes.join(above, condition).drop(*(f"_{p}" for p in LEVELS[:depth]))
        filled = _fill(nodes, LEVELS[:depth])
        above = filled.select(*(F.col(p).alias(f"_{p}") for p in path), F.col("given").alias("budget"))
    return filled.select(*LEVELS, "given")


def mix(docs: DataFrame, mixture: Mixture = DEFAULT) -> DataFrame:
    """Which documents are used in which epoch: ``doc_id``, ``domain``, ``lang``, ``source``, ``n_tokens``, ``epoch``, ``used_tokens``.

    A row per use. The tokens used of a leaf are its budget exactly: of the last document of its last
    epoch only the first ``used_tokens`` count. A null text counts as empty and weighs one token; null languages and sources are
    leaves of their own; a missing id counts as the smallest; repeated rows are used like others,
    and equal ids are ordered by their tokens. An empty table gives an empty result.
    """
    names = docs.select(
        known_id("doc_id").alias("doc_id"),
        domain_of(F.col("source")).alias("domain"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        tokens_of(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("n_tokens"),
    )
    rows = stored(names, "mixture-documents")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    given = budgets(leaves, mixture).filter("given > 0")
    plan = stored(
        leaves.select(*(F.col(p).alias(f"_{p}") for p in LEVELS), "tokens")
        .join(given, [F.col(f"_{p}").eqNullSafe(given[p]) for p in LEVELS])
        .select(*(f"_{p}" for p in LEVELS), F.expr("given div tokens").alias("whole"), F.expr("given % tokens").alias("part")),
        "mixture-plan",
    )
    on = [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in LEVELS]
    used = rows.join(plan, on).drop(*(f"_{p}" for p in LEVELS))
    columns = ("doc_id", *LEVELS, "n_tokens")
    whole = used.filter("whole > 0").withColumn("epoch", F.explode(F.expr("sequence(0, cast(whole as int) - 1)")))
    begun = _begun(used.filter("part > 0").withColumn("epoch", F.col("whole").cast("int")), mixture)
    return (
        whole.select(*columns, "epoch", F.col("n_tokens").alias("used_tokens"))
        .unionByName(begun.select(*columns, "epoch", "used_tokens"))
        .withColumn("doc_id", given_id(F.col("doc_id")))
    )


def _begun(rows: DataFrame, mixture: Mixture) -> DataFrame:
    """Of each leaf the documents whose tokens, in the epoch's order, begin before ``part``."""
    placed = rows.withColumn("place", order_of(mixture.seed, F.col("epoch"), F.col("doc_id"))).withColumn(
        "bucket", F.shiftright("place", 40 - BUCKETS.bit_length() + 1).cast("int")
    )
    order = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        placed.groupBy(*LEVELS, "bucket")
        .agg(F.sum("n_tokens").alias("tokens"), F.max("part").alias("limit"))
        .withColumn("before", F.coalesce(F.sum("tokens").over(order), F.lit(0)))
        .filter("before < limit")
        .select(
            *(F.col(p).alias(f"_{p}") for p in LEVELS),
            F.col("bucket").alias("_bucket"),
            "before",
            (F.col("before") + F.col("tokens") > F.col("limit")).alias("last"),
        )
    )
    on = [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in LEVELS] + [F.col("bucket") == F.col("_bucket")]
    inside = placed.join(stored(buckets, "mixture-buckets"), on)
    rank = Window.partitionBy(*LEVELS, "bucket").orderBy("place", "doc_id", "n_tokens")
    cut = (
        inside.filter("last")
        .withColumn("own", F.coalesce(F.sum("n_tokens").over(rank.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .filter("before + own < part")
        .withColumn("used_tokens", F.least(F.col("n_tokens"), F.expr("part - before - own")))
    )
    whole = inside.filter("NOT last").withColumn("used_tokens", F.col("n_tokens"))
    return whole.select(*rows.columns, "used_tokens").unionByName(cut.select(*rows.columns, "used_tokens"))


def mixed(docs: DataFrame, mixture: Mixture = DEFAULT) -> DataFrame:
    """The documents that a mixture uses, whole and once for every use, with the columns of ``docs``.

    The last document of a leaf's last epoch is returned whole, so a leaf may go beyond its budget by
    less than one document. Null texts, names and ids count as in :func:`mix`; repeated rows are separate uses; other
    columns are kept whatever their names. An empty table gives an empty result.
    """
    uses = mix(docs, mixture).select(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("_used_id"),
        F.col("n_tokens").alias("_used_tokens"),
        F.col("lang").alias("_used_lang"),
        F.col("source").alias("_used_source"),
        F.col("epoch").alias("_epoch"),
    )
    # Repeated rows have been counted as separate uses; a use takes one of them.
    uses = uses.groupBy("_used_id", "_used_tokens", "_used_lang", "_used_source", "_epoch").agg(F.count(F.lit(1)).alias("_times"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = packed(
        docs,
        known_id("doc_id").alias("_own_id"),
        tokens_of(text).alias("_own_tokens"),
        F.col("lang").cast("string").alias("_own_lang"),
        F.col("source").cast("string").alias("_own_source"),
    )
    joined = rows.join(
        uses,
        (F.col("_own_id") == F.col("_used_id"))
        & (F.col("_own_tokens") == F.col("_used_tokens"))
        & F.col("_own_lang").eqNullSafe(F.col("_used_lang"))
        & F.col("_own_source").eqNullSafe(F.col("_used_source")),
    )
    number = Window.partitionBy("_own_id", "_own_tokens", "_used_lang", "_used_source", "_epoch").orderBy(F.xxhash64("_row.text"))
    return joined.withColumn("_number", F.row_number().over(number)).filter("_number <= _times").select("_row.*")
