"""Secrets in documents, scanned once per content and rule.

Every version of a document is addressed by the hash of its text. The ledger, a table in a shared
folder, records which rules, each with its version, have read which content, and what they found.
A run scans the pairs of content and rule the ledger lacks, one copy of each content, appends them,
and joins the findings back to every document. All of it is column expressions.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.tables import given_id, known_id, packed, stored
from tidemark.session import shared_folder


@dataclass(frozen=True)
class Rule:
    """Leftmost, non-overlapping matches of ``pattern``, without those whose ``group`` is shorter than ``least``.

    A text without any of the strings ``needs`` is not searched.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    needs: tuple[str, ...] = ()

    @property
    def version(self) -> str:
        told = "\0".join((self.kind, self.pattern, str(self.group), str(self.least), *self.needs))
        return f"{self.kind}@{hashlib.sha256(told.encode()).hexdigest()[:16]}"


# A run of one set of characters is matched whole, so a least length within the pattern keeps the
# same matches as dropping short ones afterwards; an assignment may swallow another one, so it is not.
BASE = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    Rule("access", "AKIA[A-Z0-9]{12,}", needs=("AKIA",)),
    Rule("hex", "[0-9a-f]{32,}"),
)
# A key's block goes from BEGIN to the END of the same label, over anything without a row of five
# dashes. If there is no such END, header lines and base64 follow for as long as they go on: whole
# lines of any length, or runs of 16 and more. Line ends may be escaped. Nothing here backtracks
# into what it has passed, so the work grows with the text only.
_BODY = r"[^-]*+(?:-(?!----)[^-]*+)*+"
_GAP = r"(?:\s|\\[nr])"
_LINE_END = r"(?:[\r\n]|\\[nr])"
_RUN = rf"=?[A-Za-z0-9+/]{{16,}}+={{0,2}}+|=?[A-Za-z0-9+/]++={{0,2}}+(?=[\t\x20]*+(?:{_LINE_END}|\z))"
_CUT_SHORT = rf"(?:{_GAP}*+[A-Za-z][A-Za-z0-9-]*+:\x20[^\r\n]*+)*+(?:{_GAP}++(?:{_RUN}))++"
PRIVATE_KEY = (
    r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?)-----"
    rf"(?:{_BODY}-----END \1-----|{_CUT_SHORT})?"
)
ADDED = (
    Rule("private_key", PRIVATE_KEY, needs=("PRIVATE KEY-----", "PRIVATE KEY BLOCK-----")),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", needs=("eyJ",)),
    Rule("forge_token", "gh[opsur]_[A-Za-z0-9]{36,}", needs=("gho_", "ghp_", "ghs_", "ghu_", "ghr_")),
)
RULES = BASE + ADDED

LEDGER = T.StructType(
    [
        T.StructField("blob", T.BinaryType()),
        T.StructField("scanned", T.ArrayType(T.StringType())),
        T.StructField(
            "found",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("rule", T.StringType()),
                        T.StructField("start", T.IntegerType()),
                        T.StructField("end", T.IntegerType()),
                    ]
                )
            ),
        ),
    ]
)
PLACEHOLDER = "[redacted]"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _running_sum(values: Column) -> Column:
    """Sums up to each element, by doubling steps: the work is n log n, and no array is grown."""
    steps = F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)).cast("double"))).cast("int")

    def add(sums: Column, step: Column) -> Column:
        reach = F.call_function("shiftleft", F.lit(1), step)
        return F.transform(sums, lambda x, i: x + F.when(i >= reach, F.get(sums, i - reach)).otherwise(F.lit(0)))

    return F.when(
        F.size(values) > 1,
        F.aggregate(F.sequence(F.lit(0), F.greatest(steps - 1, F.lit(0))), values, add),
    ).otherwise(values)


def _searched(text: Column, rule: Rule) -> Column:
    hit = text.rlike(rule.pattern)
    for n, needed in enumerate(rule.needs):
        some = text.contains(needed) if n == 0 else some | text.contains(needed)  # noqa: F821
    return (some & hit) if rule.needs else hit


def _parts(text: Column, rule: Rule) -> tuple[Column, Column, Column]:
    """What lies between the matches (one more than they are), the matches, and what decides on each."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    decides = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    return F.split(text, rule.pattern, -1), matches, decides


def spans(text: Column, rule: Rule) -> Column:
    """Array of (rule version, start, end) in code points, end exclusive; empty where nothing is found."""
    gaps, matches, decides = _parts(text, rule)
    empty = F.array().cast(LEDGER["found"].dataType)

    def placed(cut: Column) -> Column:
        ends = _running_sum(
            F.zip_with(cut["gaps"], cut["matches"], lambda g, m: F.length(g) + F.coalesce(F.length(m), F.lit(0)))
        )

        def named(ended: Column) -> Column:
            every = F.transform(
                cut["matches"],
                lambda m, i: F.struct(
                    F.lit(rule.version).alias("rule"),
                    (F.get(ended, i) - F.length(m)).alias("start"),
                    F.get(ended, i).alias("end"),
                    F.length(F.get(cut["decides"], i)).alias("size"),
                ),
            )
            kept = F.filter(every, lambda s: s["size"] >= rule.least)
            return F.transform(kept, lambda s: F.struct(s["rule"].alias("rule"), s["start"].alias("start"), s["end"].alias("end")))

        return _let(ends, named)

    cut = F.struct(gaps.alias("gaps"), matches.alias("matches"), decides.alias("decides"))
    return F.when(_searched(text, rule), _let(cut, placed)).otherwise(empty)


def redacted(text: Column, rule: Rule) -> Column:
    """The text with a placeholder for each kept match of a rule."""
    gaps, matches, decides = _parts(text, rule)

    def joined(cut: Column) -> Column:
        shown = F.transform(
            cut["matches"],
            lambda m, i: F.when(F.length(F.get(cut["decides"], i)) >= rule.least, F.lit(PLACEHOLDER)).otherwise(m),
        )
        return F.array_join(F.zip_with(cut["gaps"], shown, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")

    cut = F.struct(gaps.alias("gaps"), matches.alias("matches"), decides.alias("decides"))
    return F.when(_searched(text, rule), _let(cut, joined)).otherwise(text)


def blob_of(text: Column) -> Column:
    """The address of a content."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """All entries; none where the folder holds no ledger yet."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(folder)


def scan(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings per row of ``docs``: ``doc_id``, ``blob``, ``found`` (array of kind, start, end).

    ``ledger`` is the folder of the ledger, a new one if not given. Spans are ordered by start, then
    by the order of ``rules``, and count code points. A null text counts as empty; a null id stays
    null; repeated rows stay. Columns other than ``doc_id`` and ``text`` are not read.
    """
    spark = docs.sparkSession
    ledger = ledger or shared_folder(spark, "ledger")
    texts = docs.select(
        known_id("doc_id").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("blob", blob_of(F.col("text")))
    paths = stored(texts.select("doc_id", "blob"), "paths")
    wanted = F.array(*(F.lit(r.version) for r in rules))
    known = read_ledger(spark, ledger).groupBy("blob").agg(F.flatten(F.collect_list("scanned")).alias("scanned"))
    lacking = F.when(F.col("scanned").isNull(), wanted).otherwise(F.array_except(wanted, F.col("scanned")))
    unseen = (
        paths.select("blob")
        .distinct()
        .join(known, "blob", "left")
        .select("blob", lacking.alias("lacking"))
        .filter(F.size("lacking") > 0)
    )
    # Copies become one in the map tasks, whatever their ids: an entry per content and set of rules.
    once = texts.groupBy("blob").agg(F.first("text").alias("text"))
    found = F.concat(
        *(
            F.when(F.array_contains("lacking", rule.version), spans(F.col("text"), rule)).otherwise(
                F.array().cast(LEDGER["found"].dataType)
            )
            for rule in rules
        )
    )
    entries = once.join(unseen, "blob").select("blob", F.col("lacking").alias("scanned"), found.alias("found"))
    entries.write.mode("append").parquet(ledger)

    order = F.create_map(*(x for i, r in enumerate(rules) for x in (F.lit(r.version), F.lit(i))))
    kinds = F.create_map(*(x for r in rules for x in (F.lit(r.version), F.lit(r.kind))))
    current = F.filter("found", lambda s: F.array_contains(wanted, s["rule"]))
    ranked = F.transform(
        current, lambda s: F.struct(s["start"].alias("start"), order[s["rule"]].alias("n"), s["end"].alias("end"), kinds[s["rule"]].alias("kind"))
    )
    view = stored(
        read_ledger(spark, ledger)
        .select("blob", ranked.alias("found"))
        .filter(F.size("found") > 0)
        .groupBy("blob")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).alias("found")),
        "findings",
    )
    shaped = F.transform("found", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return paths.join(view, "blob", "left").select(
        given_id(F.col("doc_id")).alias("doc_id"),
        "blob",
        F.coalesce(shaped, F.array().cast("array<struct<kind:string,start:int,end:int>>")).alias("found"),
    )


def clean(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All documents, with a placeholder for every secret, and ``n_chars`` counted anew where one was found.

    A null text stays null; rows without an id, repeated rows and rows that share an id are all kept;
    other columns are kept whatever their names. An empty table gives an empty result.
    """
    found = scan(docs, ledger, rules).filter(F.size("found") > 0).select(F.col("blob").alias("_blob")).distinct()
    marked = stored(found, "with-secrets").withColumn("_secret", F.lit(True))
    rows = packed(docs, blob_of(F.col("text")).alias("_blob")).join(marked, "_blob", "left")
    rows = rows.select("_row", "_secret", F.col("_row.text").cast("string").alias("_clean"))
    # Keys first: the other rules would break up their blocks.
    for rule in sorted(rules, key=lambda r: r.kind != "private_key"):  # a step each: one expression of all would hold the text's many times over
        rows = rows.withColumn("_clean", F.when(F.col("_secret"), redacted(F.col("_clean"), rule)).otherwise(F.col("_clean")))
    columns = {"text": F.col("_clean")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col("_secret"), F.length("_clean").cast("long")).otherwise(F.col("_row.n_chars"))
    return rows.select(*(columns.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))
