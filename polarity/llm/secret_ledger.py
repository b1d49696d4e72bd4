"""Incremental secret scans over a blob ledger (operator 4).

Every version of every path is addressed by the SHA-256 of its content.  The
ledger holds one row for each (blob, rule, rule version) that has been
scanned, with the spans found.  An update scans only pairs that the ledger
lacks, appends them, and joins findings back to all paths of a blob.
DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from polarity.llm.tables import packed, unpacked


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds leftmost non-overlapping matches; a match counts when
    its ``group`` (0: all of it) has at least ``least`` characters."""
    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules, in the order that breaks ties of position.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
# Shorter runs can't count, and a dropped run holds no later start of a longer
# one, so the lengths of the last two stand in their patterns.

SPANS = "array<struct<start:int,end:int>>"
LEDGER = f"blob string, rule string, spans {SPANS}"


def spans_of(text: Column, rule: Rule) -> Column:
    """Spans of ``rule`` in ``text``: code points, end exclusive.

    The pieces between matches (split) and the matches themselves alternate,
    so running lengths give each position.  Texts without a match skip it.
    """
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    pieces = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), matches.alias("hit"))
    none = F.expr(f"cast(array() as {SPANS})")
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def step(acc: Column, piece: Column) -> Column:
        begin = acc["at"] + F.length(piece["gap"])
        end = begin + F.coalesce(F.length(piece["hit"]), F.lit(0))
        counted = F.length(F.regexp_extract(piece["hit"], rule.pattern, rule.group)) >= rule.least
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"),
                        F.when(counted, F.concat(acc["found"], span)).otherwise(acc["found"]).alias("found"))

    return F.when(F.regexp_like(text, F.lit(rule.pattern)),
                  F.aggregate(pieces, start, step)["found"]).otherwise(none)


class BlobLedger:
    """The Parquet ledger under ``path``; ``create`` starts an empty one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def create(cls, spark: SparkSession, path: str) -> BlobLedger:
        spark.createDataFrame([], LEDGER).write.parquet(path)
        return cls(spark, path)

    def table(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def unseen(self, versions: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
        """(blob, text, todo): each new blob once, with the rules to apply.

        Copies of a blob collapse before the shuffle, so a blob that makes up
        a third of all versions costs one row per map task.
        """
        text = F.coalesce(versions[text_col].cast("string"), F.lit(""))
        blobs = (versions.select(F.sha2(text, 256).alias("blob"), text.alias("text"))
                 .groupBy("blob").agg(F.first("text").alias("text")))
        seen = self.table().groupBy(F.col("blob").alias("old")).agg(F.collect_set("rule").alias("seen"))
        names = F.array(*[F.lit(r.name) for r in rules])
        todo = F.array_except(names, F.coalesce(F.col("seen"), F.expr("cast(array() as array<string>)")))
        return (blobs.join(seen, F.col("blob") == F.col("old"), "left")
                .select("blob", "text", todo.alias("todo")).filter(F.size("todo") > 0))

    def update(self, versions: DataFrame, rules=RULES, text_col: str = "text") -> None:
        """Scan what is new and append it; one write, so a failed run leaves
        no half of it, and a repeated one finds nothing left to scan."""
        unseen = self.unseen(versions, rules, text_col)
        found = F.array(*[
            F.struct(F.lit(r.name).alias("rule"),
                     F.when(F.array_contains("todo", r.name), spans_of(F.col("text"), r)).alias("spans"))
            for r in rules])
        (unseen.select("blob", F.explode(found).alias("f"))
         .select("blob", "f.rule", "f.spans").filter("spans is not null")
         .write.mode("append").parquet(self.path))

    def findings(self, versions: DataFrame, rules=RULES, text_col: str = "text") -> DataFrame:
        """``versions`` plus one span column per rule kind (never null).

        A version whose blob was not scanned with a rule has null there, so
        it can't be taken for clean.  Span columns replace same-named ones.
        """
        text = F.coalesce(versions[text_col].cast("string"), F.lit(""))
        rows = packed(versions, versions.columns, blob=F.sha2(text, 256))
        per_blob = self.table().groupBy(F.col("blob").alias("of")).agg(*[
            F.first(F.when(F.col("rule") == r.name, F.col("spans")), ignorenulls=True).alias(f"_{r.kind}")
            for r in rules])
        return unpacked(rows.join(per_blob, F.col("blob") == F.col("of"), "left"), versions.columns,
                        **{f"{r.kind}_spans": F.col(f"_{r.kind}") for r in rules})


def joined_spans(rules=RULES) -> Column:
    """``kind:start:end`` of all spans by start, then rule order, comma-joined."""
    def tagged(place: int, kind: str) -> Column:
        return F.transform(f"{kind}_spans", lambda s: F.struct(
            s["start"].alias("start"), F.lit(place).alias("place"),
            F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")).alias("said")))

    every = F.concat(*[tagged(i, r.kind) for i, r in enumerate(rules)])
    return F.array_join(F.transform(F.array_sort(every), lambda s: s["said"]), ",")
