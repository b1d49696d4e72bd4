"""Validation and profiling.

All row-level checks fuse into one aggregation; the driver only receives one
row of counters and raises in the reference's order.  The profile is computed
from the ``(label, text)`` groups - the same groups exact deduplication needs -
so duplicate count, length mean, exact median (``percentile`` with a
frequency column) and maximum come out of a single shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polarity.functions.text import char_length, is_blank
from polarity.operators.dedup import DEFAULT, Columns

N_BINS = 50


def require_columns(df: DataFrame, columns: list[str], what: str | None = None) -> None:
    """Driver-side schema check."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what or 'The table'} lacks column(s) {missing}")


def validation_counts(df: DataFrame, cols: Columns = DEFAULT, allowed=(0, 1)) -> DataFrame:
    """C2-C4 as one aggregation: null text/label, rows with a label outside
    ``allowed``, blank text."""
    text, label = F.col(cols.text), F.col(cols.label)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(text.isNull()).alias("missing_text"),
        F.count_if(label.isNull()).alias("missing_label"),
        F.count_if(label.isNotNull() & ~label.isin(*allowed)).alias("invalid_label_rows"),
        F.count_if(is_blank(text)).alias("empty_text_rows"),
    )


def invalid_labels(df: DataFrame, cols: Columns = DEFAULT, allowed=(0, 1)) -> DataFrame:
    """The distinct offending label values, sorted (label set minus allowed)."""
    label = F.col(cols.label)
    return (df.where(label.isNotNull() & ~label.isin(*allowed))
              .select(label).distinct().orderBy(cols.label))


def label_distribution(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Rows per label, nulls kept as their own group."""
    return df.groupBy(cols.label).agg(F.count(F.lit(1)).alias("count"))


def _groups(df: DataFrame, cols: Columns) -> DataFrame:
    """Rows per distinct value of all non-id columns (E3's grouping)."""
    keys = [c for c in df.columns if c != cols.row_id]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def profile(df: DataFrame, cols: Columns = DEFAULT, approx: bool = False) -> DataFrame:
    """E1 (scalar part) + E3 as one row.

    ``total_columns`` counts the data columns (the id column is ours).  The
    median is exact and interpolated; ``approx=True`` uses ``percentile_approx``
    over the rows instead (bounded memory for any number of distinct lengths).
    """
    data_cols = [c for c in df.columns if c != cols.row_id]
    median = None
    if approx:
        median = F.lit(df.agg(F.percentile_approx(char_length(cols.text), 0.5).alias("m")).first()["m"])
    return profile_from_groups(_groups(df, cols), len(data_cols), cols, median)


def profile_from_groups(g: DataFrame, n_columns: int, cols: Columns = DEFAULT, median=None) -> DataFrame:
    """The profile from rows grouped by all data columns with their count ``_n``
    (exact deduplication produces exactly this table, so it can be reused)."""
    text = F.col(cols.text)
    n = F.col("_n")
    length = char_length(text)
    median = F.percentile(length, F.lit(0.5), n) if median is None else median
    return g.agg(
        F.sum(n).cast("long").alias("total_rows"),
        F.lit(n_columns).cast("long").alias("total_columns"),
        F.coalesce(F.sum(F.when(text.isNull(), n)), F.lit(0)).cast("long").alias("missing_text"),
        F.coalesce(F.sum(F.when(F.col(cols.label).isNull(), n)), F.lit(0)).cast("long").alias("missing_label"),
        F.coalesce(F.sum(n - 1), F.lit(0)).cast("long").alias("duplicate_exact_rows"),
        F.coalesce(F.sum(F.when(is_blank(text), n)), F.lit(0)).cast("long").alias("empty_text_rows"),
        F.coalesce(F.try_divide(F.sum(length * n), F.sum(F.when(text.isNotNull(), n))), F.lit(0.0))
         .alias("average_text_length"),
        F.coalesce(median, F.lit(0.0)).cast("double").alias("median_text_length"),
        F.coalesce(F.max(length), F.lit(0)).cast("long").alias("max_text_length"),
    )


def check_dataset(df: DataFrame, cols: Columns = DEFAULT, allowed=(0, 1)) -> None:
    """C1 -> C2 -> C3 -> C4: one fused aggregation, first failure raises."""
    require_columns(df, [cols.text, cols.label])
    checks = validation_counts(df, cols, allowed).first().asDict()
    missing = {c: checks[k] for c, k in ((cols.text, "missing_text"), (cols.label, "missing_label")) if checks[k]}
    if missing:
        raise ValueError(f"Required columns hold nulls: {missing}")
    if checks["invalid_label_rows"]:
        kinds = invalid_labels(df, cols, allowed).count()
        raise ValueError(f"{checks['invalid_label_rows']} row(s) of {cols.label} hold {kinds} label(s) outside "
                         f"{sorted(allowed)}; quality.invalid_labels lists all of them")
    if checks["empty_text_rows"]:
        raise ValueError(f"{checks['empty_text_rows']} row(s) of {cols.text} are blank")


def validate_dataset(df: DataFrame, cols: Columns = DEFAULT, allowed=(0, 1)) -> dict:
    """C1 -> C2 -> C3 -> C4 (first failure raises), then the E1 profile."""
    check_dataset(df, cols, allowed)
    return profile_dict(df, cols)


def profile_dict(df: DataFrame, cols: Columns = DEFAULT, groups: DataFrame | None = None) -> dict:
    """E1 as the reference's JSON-friendly dict (label counts sorted).

    ``groups``: rows already grouped by all data columns with ``_n`` (reused
    from exact deduplication instead of grouping the table again)."""
    data_cols = [c for c in df.columns if c != cols.row_id]
    g = _groups(df, cols) if groups is None else groups
    row = profile_from_groups(g, len(data_cols), cols).first().asDict()
    dist = (g.groupBy(cols.label).agg(F.sum("_n").alias("count"))
             .orderBy(F.col(cols.label).asc_nulls_last()).collect())
    grouped = [c for c in data_cols if c in g.columns]
    nulls = g.agg(*[F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("_n"))), F.lit(0)).alias(c)
                    for c in grouped]).first().asDict() if grouped else {}
    return {
        "total_rows": row["total_rows"],
        "total_columns": row["total_columns"],
        "column_names": data_cols,
        "missing_values": {c: int(nulls.get(c, 0)) for c in data_cols},
        "label_distribution": {str(r[0]): r[1] for r in dist},
        "duplicate_exact_rows": row["duplicate_exact_rows"],
        "empty_text_rows": row["empty_text_rows"],
        "average_text_length": row["average_text_length"],
        "median_text_length": row["median_text_length"],
        "max_text_length": row["max_text_length"],
    }


def length_histogram(df: DataFrame, cols: Columns = DEFAULT, bins: int = N_BINS) -> DataFrame:
    """Equal-width histogram of text length over [min, max] (numpy rules).

    Lengths are first reduced to (length, rows) - bounded by the longest text,
    not by the row count - so the min/max window runs over a small table.
    """
    lengths = (df.where(F.col(cols.text).isNotNull())
                 .groupBy(char_length(cols.text).alias("len"))
                 .agg(F.count(F.lit(1)).alias("n")))
    everything = Window.partitionBy()
    mn = F.min("len").over(everything).cast("double")
    mx = F.max("len").over(everything).cast("double")
    with_range = lengths.select(
        "len", "n",
        F.when(mn == mx, mn - 0.5).otherwise(mn).alias("first"),
        F.when(mn == mx, mx + 0.5).otherwise(mx).alias("last"))
    x = F.col("len").cast("double")
    first, last = F.col("first"), F.col("last")

    def edge(i: Column) -> Column:
        return F.when(i >= bins, last).otherwise(i * ((last - first) / bins) + first)

    raw = F.floor(((x - first) / (last - first)) * bins).cast("int")
    idx0 = F.when(raw == bins, bins - 1).otherwise(raw)
    binned = with_range.select("n", "first", "last", "len", idx0.alias("i0"))
    i0 = F.col("i0")
    idx1 = F.when(x < edge(i0), i0 - 1).otherwise(i0)
    binned = binned.select("n", "first", "last", "len", idx1.alias("i1"))
    i1 = F.col("i1")
    idx = F.when((x >= edge(i1 + 1)) & (i1 != bins - 1), i1 + 1).otherwise(i1)
    counts = binned.groupBy(idx.alias("bin")).agg(
        F.sum("n").alias("count"), F.first("first").alias("first"), F.first("last").alias("last"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    # the grid has `bins` rows and the counts at most `bins`: both sides are tiny
    joined = grid.join(F.broadcast(counts), on="bin", how="left")
    lo = F.max("first").over(everything)
    hi = F.max("last").over(everything)
    b = F.col("bin")
    return joined.select(
        b,
        F.when(b >= bins, hi).otherwise(b * ((hi - lo) / bins) + lo).alias("bin_start"),
        F.when(b + 1 >= bins, hi).otherwise((b + 1) * ((hi - lo) / bins) + lo).alias("bin_end"),
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"),
    )


def quality_gate(metrics: DataFrame, minimum: float = 0.75) -> DataFrame:
    """Flag a metrics row whose accuracy or macro-F1 is below ``minimum``."""
    return metrics.withColumn(
        "below_quality_gate", (F.col("accuracy") < minimum) | (F.col("macro_f1") < minimum))
