"""Secret scans over a ledger of content-addressed blobs."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthlens.session import shared_dir

# Fixed rules: kind, pattern, the group whose length counts, its least length.
RULES = (
    (
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),  # the same as 20 or more characters of AKIA[A-Z0-9]+
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
RULE_VERSION = "base-1"
_SPANS = "array<struct<start:int,kind:int,end:int>>"
LEDGER_SCHEMA = f"blob string, rule_version string, spans {_SPANS}"
MASK = "[SECRET]"


def spans_of(text: Column, kind: int) -> Column:
    """Spans (start, kind, end; code points, end exclusive) of one rule, leftmost and non-overlapping.

    The pieces between the matches and the matches alternate, so running sums of
    their lengths are the places; matches below the least length are dropped afterwards.
    """
    _, pattern, group, least = RULES[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    between = F.split(text, pattern, -1)
    steps = F.zip_with(
        F.slice(between, F.lit(1), F.size(found)),
        F.arrays_zip(found.alias("whole"), values.alias("value")),
        lambda gap, match: F.struct(
            F.length(gap).alias("gap"),
            F.length(match["whole"]).alias("size"),
            (F.length(match["value"]) >= least).alias("good"),
        ),
    )
    kept = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {_SPANS})").alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + s["size"]).alias("at"),
            F.when(
                s["good"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + s["gap"]).alias("start"),
                            F.lit(kind).alias("kind"),
                            (acc["at"] + s["gap"] + s["size"]).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return F.when(text.rlike(pattern), kept).otherwise(F.expr(f"cast(array() as {_SPANS})"))


def all_spans(text: Column) -> Column:
    """Spans of all rules, by start and then by rule order."""
    return F.array_sort(F.concat(*[spans_of(text, k) for k in range(len(RULES))]))


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


@dataclass
class BlobLedger:
    """Findings by (blob, rule_version), a Parquet folder that only grows.

    A run appends its rows in one committed write; rows of a failed run do not
    appear, and its blobs count as unseen the next time.
    """

    spark: SparkSession
    path: str

    @classmethod
    def fresh(cls, spark: SparkSession) -> BlobLedger:
        """A new, empty ledger in the shared folder."""
        return cls(spark, f"{shared_dir(spark)}/llm/ledger-{uuid.uuid4().hex}")

    def __post_init__(self) -> None:
        self.spark.createDataFrame([], LEDGER_SCHEMA).write.mode("append").parquet(self.path)

    def rows(self, rule_version: str) -> DataFrame:
        """blob, rule_version and spans, one row a blob, also where two writers scanned it at the same time."""
        stored = self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path).where(F.col("rule_version") == rule_version)
        return stored.groupBy("blob", "rule_version").agg(F.first("spans").alias("spans"))

    def scan(self, versions: DataFrame, rule_version: str = RULE_VERSION) -> None:
        """Scans the unseen blobs of ``versions`` (text): each content once under each rule version.

        Equal texts are one row before they are shuffled, by their blob ids; those
        that the ledger does not know under the rule version are scanned.
        """
        texts = versions.groupBy(blob_id(F.col("text")).alias("blob")).agg(F.first("text").alias("text"))
        known = self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path).where(F.col("rule_version") == rule_version)
        unseen = texts.join(known.select("blob"), "blob", "left_anti")
        found = unseen.select("blob", F.lit(rule_version).alias("rule_version"), all_spans(F.coalesce("text", F.lit(""))).alias("spans"))
        found.write.mode("append").parquet(self.path)


def scan_documents(docs: DataFrame, ledger: BlobLedger, rule_version: str = RULE_VERSION) -> DataFrame:
    """doc_id, blob and spans of every row of ``docs``, after bringing ``ledger`` up to date.

    Null texts are the empty blob; rows with equal ids count each; null ids are
    kept; an empty table gives no rows; other columns are not read.
    """
    ledger.scan(docs, rule_version)
    paths = docs.select("doc_id", blob_id(F.col("text")).alias("blob"))
    return paths.join(ledger.rows(rule_version).select("blob", "spans"), "blob").select("doc_id", "blob", "spans")


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    kinds = F.array(*[F.lit(r[0]) for r in RULES])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ","
    )


def masked(text: Column, spans: Column, mask: str = MASK) -> Column:
    """``text`` with every stretch covered by ``spans`` (sorted; they may overlap) replaced by ``mask``."""
    done = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(
            F.when(
                s["start"] >= acc["at"],
                F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)),
            )
            .otherwise(acc["out"])
            .alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)
