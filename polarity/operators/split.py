"""Exact, seeded, stratified train/validation/test split.

Quotas follow the reference's two-stage rule: ``floor(train * n)`` rows for
train, then ``floor(val / (val + test) * rest)`` for validation; per class the
counts are proportional with largest-remainder rounding (ties: lower label).

Rows are ordered inside their class by ``md5("<seed>:<row_id>")``, ``row_id``.
A global ``row_number() OVER (PARTITION BY label)`` would put each class in
one task, so only the rows at the cuts are looked up:

1. count rows per (class, 16-bit hash prefix) - at most 65,536 rows per class,
   whatever the table size - and find the prefix that holds each cut;
2. count the rows of those prefixes alone by longer ones until few rows share
   one, and read the exact (hash, row_id) of the cut from them.

The assignment is then one ``when`` over one scan of the table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polarity.operators.dedup import DEFAULT, Columns
from polarity.session import materialize

BUCKET_HEX = 4          # 16-bit buckets: <= 65,536 rows per class in the bucket table
CUT_ROWS = 1000         # a cut is read from at most so many rows of one prefix
SPLITS = ("train", "validation", "test")


@dataclass(frozen=True)
class SplitConfig:
    train_size: float = 0.8
    validation_size: float = 0.1
    test_size: float = 0.1
    seed: int = 42
    stratify: bool = True

    def check(self) -> None:
        """The three fractions must sum to one."""
        if abs((self.train_size + self.validation_size + self.test_size) - 1.0) > 1e-8:
            raise ValueError("train, validation and test fractions do not sum to 1")


def shares(sizes: list[int], wanted: int) -> list[int]:
    """``wanted`` rows dealt to classes in proportion to their sizes: whole
    parts first, the rest one by one to the largest fractions (ties: first)."""
    whole = sum(sizes)
    exact = [wanted * size / whole for size in sizes]
    given = [math.floor(x) for x in exact]
    by_fraction = sorted(range(len(sizes)), key=lambda c: given[c] - exact[c])
    for c in by_fraction[:max(0, wanted - sum(given))]:
        given[c] += 1
    return given


def quotas(class_counts: dict, cfg: SplitConfig) -> dict:
    """{class: (train, validation, test)} for the given class sizes."""
    cfg.check()
    labels = sorted(class_counts, key=lambda v: (v is None, v))
    counts = [int(class_counts[k]) for k in labels]
    n = sum(counts)
    n_train = math.floor(cfg.train_size * n)
    if n_train == 0 or n_train == n:
        raise ValueError(f"Cannot split: {n} rows leave a part empty")
    if cfg.stratify:
        if min(counts) < 2:
            raise ValueError("Cannot split: a class has a single row")
        if n_train < len(counts) or n - n_train < len(counts):
            raise ValueError("Cannot split: a part has fewer rows than there are classes")
        train = shares(counts, n_train)
    else:
        train = [n_train]
    rest = [c - t for c, t in zip(counts, train)] if cfg.stratify else [n - n_train]
    m = sum(rest)
    frac = cfg.validation_size / (cfg.validation_size + cfg.test_size)
    n_val = math.floor(frac * m)
    if n_val == 0 or n_val == m:
        raise ValueError("Cannot split: the validation or test part is empty")
    if cfg.stratify:
        if min(rest) < 2 or n_val < len(rest) or m - n_val < len(rest):
            raise ValueError("Cannot split: a class is too small for validation and test")
        val = shares(rest, n_val)
    else:
        val = [n_val]
    keys = labels if cfg.stratify else ["__all__"]
    return {k: (t, v, r - v) for k, t, v, r in zip(keys, train, val, rest)}


def _hash(cols: Columns, cfg: SplitConfig) -> Column:
    """Place of a row in its class; a null ``row_id`` has none and raises."""
    row_id = F.col(cols.row_id)
    missing = F.raise_error(F.lit(f"{cols.row_id} is null: every row of a split needs an id"))
    return F.when(row_id.isNull(), missing.cast("string")).otherwise(
        F.md5(F.concat(F.lit(f"{cfg.seed}:"), row_id.cast("string"))))


def _class(cols: Columns, cfg: SplitConfig) -> Column:
    return F.col(cols.label) if cfg.stratify else F.lit("__all__")


def class_counts(df: DataFrame, cols: Columns = DEFAULT, stratify: bool = True) -> dict:
    """Rows per class (k rows to the driver; k = number of labels)."""
    if not stratify:
        return {"__all__": df.count()}
    return {r[0]: r[1] for r in df.groupBy(cols.label).count().collect()}


def _hashed(df: DataFrame, cols: Columns, cfg: SplitConfig) -> DataFrame:
    """(class, hash, id) of every row, written once: the narrow table that the
    counts and the cuts are read from."""
    return materialize(df.select(_class(cols, cfg).alias("class"), _hash(cols, cfg).alias("hash"),
                                 F.col(cols.row_id).alias("id")))


def _prefix_totals(rows: DataFrame, start: int, width: int) -> DataFrame:
    """Rows before and in each prefix of ``width`` hash digits, within the
    class and the first ``start`` digits: at most 65,536 prefixes of each."""
    counted = rows.groupBy("class", F.substring("hash", 1, start).alias("within"),
                           F.substring("hash", 1, width).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("class", "within").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("lo", F.coalesce(F.sum("n").over(before), F.lit(0)))


def cut_rows(rows: DataFrame, places: dict) -> dict:
    """{(class, place): (hash, id) of that row of the class}; places count from 1.

    The prefix of each place is narrowed four digits at a time until it holds
    few rows, which are then read: at most CUT_ROWS for each place, or the
    copies of one id, which is an error.
    """
    spark = rows.sparkSession
    kind = rows.schema["class"].dataType.simpleString()
    asked = [(k, int(at), int(at), "") for k, ats in places.items() for at in ats]
    width, found = 0, {}
    while asked:
        wanted = spark.createDataFrame(asked, f"of {kind}, at long, rest long, start string")
        here = rows.join(F.broadcast(wanted.select("of", "start").distinct()),
                         F.col("class").eqNullSafe(F.col("of")) & (F.substring("hash", 1, width) == F.col("start"))).drop("of")
        totals = _prefix_totals(here, width, width + BUCKET_HEX)
        width += BUCKET_HEX
        hit = (totals.join(F.broadcast(wanted), F.col("class").eqNullSafe(F.col("of")) & (F.col("within") == F.col("start")))
               .filter((F.col("lo") < F.col("rest")) & (F.col("rest") <= F.col("lo") + F.col("n")))
               .select("of", "at", (F.col("rest") - F.col("lo")).alias("rest"), "prefix", "n").collect())
        small = [r for r in hit if r.n <= CUT_ROWS]
        asked = [(r["of"], r.at, r.rest, r.prefix) for r in hit if r.n > CUT_ROWS]
        if asked and width >= 32:
            raise ValueError("an id is shared by too many rows: ids of a split must be unique")
        if small:
            keys = spark.createDataFrame([(r["of"], r.prefix) for r in small], f"of {kind}, prefix string").distinct()
            own = here.join(F.broadcast(keys), F.col("class").eqNullSafe(F.col("of"))
                            & (F.substring("hash", 1, width) == F.col("prefix"))).select("class", "prefix", "hash", "id")
            by_prefix: dict = {}
            for r in own.collect():
                by_prefix.setdefault((r["class"], r.prefix), []).append((r.hash, r.id))
            for r in small:
                ordered = sorted(by_prefix[r["of"], r.prefix])
                found[r["of"], r.at] = ordered[r.rest - 1]
                if ordered.count(ordered[r.rest - 1]) > 1:
                    raise ValueError(f"id {ordered[r.rest - 1][1]!r} occurs more than once: ids of a split must be unique")
    return found


def assign_splits(df: DataFrame, q: dict, cols: Columns = DEFAULT, cfg: SplitConfig = SplitConfig(),
                  hashed: DataFrame | None = None) -> DataFrame:
    """Add ``split`` to every row for the given per-class quotas.

    One expression over one scan: each class compares its rows with the two
    cut rows.  A null label is a class like any other.
    """
    hashed = _hashed(df, cols, cfg) if hashed is None else hashed
    places = {k: sorted({p for p in (t, t + v) if p > 0}) for k, (t, v, _) in q.items()}
    cuts = cut_rows(hashed, places)
    place, klass = F.struct(_hash(cols, cfg).alias("hash"), F.col(cols.row_id).alias("id")), _class(cols, cfg)

    def upto(k, at: int) -> Column:
        if at == 0:
            return F.lit(False)
        digest, row_id = cuts[k, at]
        kind = df.schema[cols.row_id].dataType
        return place <= F.struct(F.lit(digest).alias("hash"), F.lit(row_id).cast(kind).alias("id"))

    split = None
    for k, (t, v, _) in q.items():
        part = F.when(upto(k, t), "train").when(upto(k, t + v), "validation").otherwise("test")
        own = klass.eqNullSafe(F.lit(k))
        split = F.when(own, part) if split is None else split.when(own, part)
    return df.withColumn("split", split)


def stratified_split(df: DataFrame, cols: Columns = DEFAULT, cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """I1 as a DataFrame with a ``split`` column; every row gets one.

    One pass over ``df`` writes (class, hash, id); the class totals (k rows to
    the driver) and the cuts come from it.  A null label is a class of its
    own; a null ``row_id`` raises, and so does one that is repeated at a cut.
    """
    cfg.check()
    hashed = _hashed(df, cols, cfg)
    totals = {r[0]: r[1] for r in hashed.groupBy("class").count().collect()}
    return assign_splits(df, quotas(totals, cfg), cols, cfg, hashed)


def split_report(split_df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Rows per (split, label)."""
    return split_df.groupBy("split", cols.label).agg(F.count(F.lit(1)).alias("rows"))


def split_leakage(split_df: DataFrame, text_col: str = "clean_text") -> DataFrame:
    """H1: number of clean texts found in more than one split (must be 0).

    One shuffle on the text instead of three pairwise intersections.
    """
    per_text = split_df.groupBy(text_col).agg((F.min("split") != F.max("split")).alias("_shared"))
    return per_text.agg(F.count_if(F.col("_shared")).cast("long").alias("overlapping_clean_texts"))


def assert_no_leakage(split_df: DataFrame, text_col: str = "clean_text") -> None:
    if split_leakage(split_df, text_col).first()[0]:
        raise ValueError(f"{text_col}: some texts lie in more than one part of the split")


def class_weights(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Balanced weights n / (k * n_c) per label."""
    everything = Window.partitionBy()
    counts = df.groupBy(cols.label).agg(F.count(F.lit(1)).alias("count"))
    n = F.sum("count").over(everything)
    k = F.count(F.lit(1)).over(everything)
    return counts.select(cols.label, "count", (n / (k * F.col("count"))).alias("weight"))
