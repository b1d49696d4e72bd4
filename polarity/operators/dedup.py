"""Duplicate and label-conflict removal.

Plan shape
----------
Keep-first needs an order, so every row carries ``row_id``; "first" is the
smallest id.  The whole bundle is three partial aggregations and no window:

1. ``groupBy(text, label)``    - exact duplicates; survivor = min id.
2. ``groupBy(duplicate_key)``  - label conflicts and same-label copies on the
   normalised key, computed once per *distinct* text.
3. ``groupBy(clean_text)``     - blank rows, conflicts and copies after cleaning.

Each grouping keeps ``min/max(label)``, counts and ``min_by(struct, row_id)``,
all of which combine map-side, so a key holding a third of the table costs one
partial row per map task instead of a hot reducer.  Every counter of the
reports is a sum over the grouped rows, so no step is re-run to count it.

Aggregations that carry the survivor's text (``min_by`` over a struct with a
string) run as sort-based aggregation: a local sort per map task, still with
map-side combining and no extra shuffle.  Filters on grouping keys are kept
as aggregate outputs so the optimizer cannot push them below the grouping
and re-run the cleaning chain.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polarity.functions.text import CleaningFlags, clean_text, duplicate_key
from polarity.session import materialize


@dataclass(frozen=True)
class Columns:
    text: str = "text"
    label: str = "sentiment"
    row_id: str = "row_id"


DEFAULT = Columns()


def _conflict(lo: str = "_lo", hi: str = "_hi", nulls: str = "_nulls", rows: str = "_rows") -> Column:
    """More than one label value in the group; null counts as a value."""
    differ = F.coalesce(F.col(lo) != F.col(hi), F.lit(False))
    mixed_null = (F.col(nulls) > 0) & (F.col(nulls) < F.col(rows))
    return differ | mixed_null


# Names of the columns that the groupings add.
HELPERS = frozenset({"_lo", "_hi", "_nulls", "_rows", "_n", "_raw", "_f", "_first", "_blank", "_conflict", "_bad"})


def _refuse_clash(df: DataFrame) -> None:
    clash = sorted(HELPERS.intersection(df.columns))
    if clash:
        raise ValueError(f"rename column(s) {clash}: deduplication uses these names itself")


def _carry(df: DataFrame, cols: Columns, drop: tuple[str, ...] = ()) -> list[str]:
    first = [cols.row_id, cols.label, cols.text]
    return first + [c for c in df.columns if c not in first and c not in drop]


# --- single steps (reference API surface) ------------------------------------

def remove_exact_duplicates(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """one row per (text, label), the first by ``row_id``."""
    _refuse_clash(df)
    carry = _carry(df, cols)
    return (df.groupBy(cols.text, cols.label)
              .agg(F.min_by(F.struct(*carry), F.col(cols.row_id)).alias("_first"))
              .select("_first.*"))


def find_conflicting_duplicate_texts(df: DataFrame, key: str, cols: Columns = DEFAULT) -> DataFrame:
    """Rows whose ``key`` appears with more than one label (semi join).

    The key side is grouped (partial aggregation); the row side is matched with
    a left-semi join, which AQE splits when one key is hot.
    """
    _refuse_clash(df)
    return df.join(_conflicting_keys(df, key, cols), on=key, how="left_semi")


def _conflicting_keys(df: DataFrame, key: str, cols: Columns) -> DataFrame:
    label = F.col(cols.label)
    return (df.groupBy(key)
              .agg(F.min(label).alias("_lo"), F.max(label).alias("_hi"),
                   F.count_if(label.isNull()).alias("_nulls"), F.count(F.lit(1)).alias("_rows"))
              .where(_conflict())
              .select(key))


def remove_conflicting_duplicate_texts(df: DataFrame, key: str, cols: Columns = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(rows without conflicting keys, the conflicting rows).

    One join marks the rows; they are written once and read as two tables.
    Rows without a key conflict with none."""
    _refuse_clash(df)
    bad = _conflicting_keys(df, key, cols).withColumn("_bad", F.lit(True))
    marked = materialize(df.join(bad, on=key, how="left"))
    return marked.where("_bad is null").drop("_bad"), marked.where("_bad").drop("_bad")


def remove_duplicate_texts_same_label(df: DataFrame, key: str, cols: Columns = DEFAULT) -> DataFrame:
    """one row per (key, label), the first by ``row_id``."""
    _refuse_clash(df)
    carry = _carry(df, cols, drop=(key,))
    return (df.groupBy(key, cols.label)
              .agg(F.min_by(F.struct(*carry), F.col(cols.row_id)).alias("_first"))
              .select("_first.*", key))


# --- fused bundles -------------------------------------------------------------

def exact_groups(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Aggregation 1: distinct (text, label) with first id, row count and key."""
    _refuse_clash(df)
    carry = [c for c in _carry(df, cols) if c not in (cols.text, cols.label)]
    # only the id to carry: a plain min keeps the aggregation hash-based
    first = (F.struct(F.min(cols.row_id).alias(cols.row_id)) if carry == [cols.row_id]
             else F.min_by(F.struct(*carry), F.col(cols.row_id)))
    return (df.groupBy(cols.text, cols.label)
              .agg(first.alias("_f"), F.count(F.lit(1)).alias("_n"))
              .select("_f.*", cols.label, cols.text, "_n")
              .withColumn("duplicate_key", duplicate_key(cols.text)))


def key_groups(exact: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Aggregation 2: per duplicate key, conflicts and the first survivor."""
    carry = _carry(exact, cols, drop=("_n", "duplicate_key"))
    label = F.col(cols.label)
    return (exact.groupBy("duplicate_key").agg(
                F.min(label).alias("_lo"), F.max(label).alias("_hi"),
                F.count_if(label.isNull()).alias("_nulls"),
                F.count(F.lit(1)).alias("_rows"),
                F.sum("_n").alias("_raw"),
                F.min_by(F.struct(*carry), F.col(cols.row_id)).alias("_first"))
            .withColumn("_conflict", _conflict()))


def dedup_survivors(keyed: DataFrame) -> DataFrame:
    """F4 output: first row of every key without a label conflict."""
    return keyed.where(~F.col("_conflict")).select("_first.*", "duplicate_key")


def dedup_report(keyed: DataFrame) -> DataFrame:
    """E5: the six counters of the duplicate bundle, one row."""
    c = F.col("_conflict")
    return keyed.agg(*_key_counters(c, F.lit(True)))


def _key_counters(conflict: Column, in_stage: Column) -> list[Column]:
    def total(value: Column, cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(in_stage & cond, value)), F.lit(0)).cast("long")
    yes = F.lit(True)
    return [
        total(F.col("_raw"), yes).alias("rows_before"),
        total(F.col("_raw") - F.col("_rows"), yes).alias("exact_duplicate_rows_removed"),
        total(F.lit(1), conflict).alias("conflicting_duplicate_text_groups"),
        total(F.col("_rows"), conflict).alias("conflicting_duplicate_rows_removed"),
        total(F.col("_rows") - 1, ~conflict).alias("same_label_duplicate_rows_removed"),
        total(F.lit(1), ~conflict).alias("rows_after"),
    ]


def handle_duplicates(df: DataFrame, cols: Columns = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(survivors with ``duplicate_key``, one-row E5 report)."""
    keyed = key_groups(exact_groups(df, cols), cols)
    return dedup_survivors(keyed), dedup_report(keyed)


def label_conflicts(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """D1 inside the bundle: exact-dedup survivors whose key has two labels."""
    exact = materialize(exact_groups(df, cols))  # read twice, computed once
    return conflicting_rows(exact, key_groups(exact, cols))


def conflicting_rows(exact: DataFrame, keyed: DataFrame) -> DataFrame:
    """Rows of the exact-dedup table whose key is in conflict (D1 output)."""
    bad = keyed.where(F.col("_conflict")).select(F.col("duplicate_key").alias("_bad"))
    # keys are unique after grouping, so an inner join keeps the same rows.  A
    # semi join, or the "key is not null" filter an equi-join infers, would be
    # pushed below the aggregation and re-run the key (a Python UDF) on raw rows;
    # the null-safe comparison infers no such filter.
    left = exact.drop("_n")
    return left.join(bad, left["duplicate_key"].eqNullSafe(bad["_bad"]), "inner").drop("_bad")


def clean_groups(survivors: DataFrame, cols: Columns = DEFAULT,
                 flags: CleaningFlags = CleaningFlags()) -> DataFrame:
    """Aggregation 3: clean the key survivors and group by ``clean_text``."""
    cleaned = survivors.drop("duplicate_key").withColumn("clean_text", clean_text(cols.text, flags))
    carry = _carry(cleaned, cols, drop=("clean_text",))
    label = F.col(cols.label)
    # "_blank" is an aggregate on purpose: a filter on the grouping key would be
    # pushed below the aggregation and re-run the whole cleaning chain
    return cleaned.groupBy("clean_text").agg(
        F.min(label).alias("_lo"),
        F.max(label).alias("_hi"),
        F.count_if(label.isNull()).alias("_nulls"),
        F.count(F.lit(1)).alias("_rows"),
        F.min_by(F.struct(*carry), F.col(cols.row_id)).alias("_first"),
        F.max(F.col("clean_text") == F.lit("")).alias("_blank"),
    ).withColumn("_conflict", _conflict())


def clean_survivors(cleaned: DataFrame) -> DataFrame:
    """F5 output rows: non-blank clean texts with one label, first row each."""
    return (cleaned.where(~F.col("_blank") & ~F.col("_conflict"))
                   .select("_first.*", "clean_text"))


def cleaning_report(keyed: DataFrame, cleaned: DataFrame) -> DataFrame:
    """E6 + E5 counters in one aggregation over both grouped tables."""
    stage1 = keyed.select(F.lit(1).alias("_stage"), "_raw", "_rows", "_conflict",
                          F.lit(False).alias("_blank"))
    stage2 = cleaned.select(F.lit(2).alias("_stage"), F.lit(0).cast("long").alias("_raw"),
                            "_rows", "_conflict", "_blank")
    both = stage1.unionByName(stage2)
    s1, s2 = F.col("_stage") == 1, F.col("_stage") == 2
    conflict, blank = F.col("_conflict"), F.col("_blank")

    def total(value: Column, cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("long")

    kept2 = s2 & ~blank
    conflict_rows = total(F.col("_rows"), kept2 & conflict)
    same_label = total(F.col("_rows") - 1, kept2 & ~conflict)
    return both.agg(
        total(F.col("_raw"), s1).alias("rows_before"),
        total(F.lit(1), kept2 & ~conflict).alias("rows_after"),
        total(F.col("_rows"), s2 & blank).alias("empty_clean_text_rows_removed"),
        total(F.lit(1), kept2 & conflict).alias("conflicting_clean_text_groups"),
        conflict_rows.alias("conflicting_clean_text_rows_removed"),
        same_label.alias("same_label_clean_text_duplicates_removed"),
        (conflict_rows + same_label).alias("total_clean_text_duplicates_removed"),
        total(F.col("_raw") - F.col("_rows"), s1).alias("exact_duplicate_rows_removed"),
        total(F.lit(1), s1 & conflict).alias("conflicting_duplicate_text_groups"),
        total(F.col("_rows"), s1 & conflict).alias("conflicting_duplicate_rows_removed"),
        total(F.col("_rows") - 1, s1 & ~conflict).alias("same_label_duplicate_rows_removed"),
        total(F.lit(1), s1 & ~conflict).alias("rows_after_key_dedup"),
    )


@dataclass
class PreprocessResult:
    clean: DataFrame          # row_id, label, text, clean_text (+ passthrough)
    report: DataFrame         # one row, cleaning_report columns
    keyed: DataFrame
    grouped: DataFrame


def preprocess_plan(df: DataFrame, cols: Columns = DEFAULT,
                    flags: CleaningFlags = CleaningFlags()) -> PreprocessResult:
    """F5 as lazy plans (no validation, no materialisation)."""
    keyed = key_groups(exact_groups(df, cols), cols)
    grouped = clean_groups(dedup_survivors(keyed), cols, flags)
    return PreprocessResult(clean_survivors(grouped), cleaning_report(keyed, grouped), keyed, grouped)
