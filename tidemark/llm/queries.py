"""One query per training-data operator over the given tables; their SQL, where it exists, is in ``sql``.

Each query applies its operator to a whole table and derives the columns that are compared.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Rows that Spark hands to a Python worker at once: small, as a single text may be long.
BATCH_ROWS = "1000"


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on: small Arrow batches, and workers that find this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))
    return spark


def _query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepared(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


@_query
def op2_embedding_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.embedding_lsh import near_vectors

    return near_vectors(read(spark, sf_dir, "embeddings"))


@_query
def op6_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.simhash_anchors import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"))


@_query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.bpe_transducer import round_trip

    return round_trip(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "utf-8"), 256).alias("decoded_sha256"),
    )


@_query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.token_files import read_token_files, write_token_files

    files = write_token_files(read(spark, sf_dir, "documents"))
    return read_token_files(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.warc import read_archives, write_archives

    return read_archives(write_archives(read(spark, sf_dir, "pages")), payloads=False).drop("payload")


@_query
def op9_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.secret_ledger import BASE, scan

    base = [rule.kind for rule in BASE]

    def told(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scan(read(spark, sf_dir, "documents")).select(
        "doc_id",
        *map(count, base),
        F.sha2(told(F.filter("found", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        told(F.col("found")).alias("spans"),
    )


@_query
def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.winnowing import compare_edited, digest

    return compare_edited(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited_text", "utf-8"), 256).alias("edited_sha256"),
        digest(F.col("kept")).alias("fingerprint"),
        digest(F.col("edited_kept")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@_query
def op3_quality_rff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.quality_rff import score_quality

    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@_query
def op8_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.toxicity_ftrl import score_toxicity

    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@_query
def op10_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.mixture import mix

    return mix(read(spark, sf_dir, "documents"))


@_query
def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.positional_index import contaminated

    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@_query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.orchard_codes import compress

    codes, books = compress(read(spark, sf_dir, "embeddings"))
    return codes.withColumn("codebooks_sha256", F.lit(books.sha256 if books else None))


@_query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.prefix_trie import prefix_trie, rebuilt

    return prefix_trie(rebuilt(read(spark, sf_dir, "conversations"))).drop("a", "b")
