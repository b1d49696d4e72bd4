"""Classification metrics, threshold sweep, error analysis.

Everything reduces to confusion counts, so each evaluation is one aggregation
with four ``count_if`` and the metrics are arithmetic on that one row.  Division
by zero yields 0 (``try_divide`` + ``coalesce``), as the reference's
``zero_division=0``.  Macro averages use the labels present in truth or
prediction; per-class figures always use both labels 0 and 1.

The sweep is one pass too: each row is put in the bucket "number of grid
thresholds <= p", buckets are counted per label (at most 2 x (grid+1) rows),
and a running sum over that tiny table gives every threshold's counts - no
per-threshold copy of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polarity.operators.quality import require_columns

NEG, POS = "negative", "positive"


def default_grid() -> list[float]:
    """0.30 ... 0.70 step 0.01, rounded to 2 places (41 values)."""
    return [round(0.30 + 0.01 * i, 2) for i in range(41)]


def _div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def decide(p: Column, threshold: float) -> Column:
    """``p >= t`` -> 1; NaN/null probabilities never reach the threshold."""
    return F.when(p.isNotNull() & ~F.isnan(p) & (p >= F.lit(float(threshold))), 1).otherwise(0)


def default_decision(p_neg: Column, p_pos: Column) -> Column:
    """The model's own decision: arg-max of the two probabilities, ties -> 0."""
    return F.when(p_pos > p_neg, 1).otherwise(0)


def confusion_counts(df: DataFrame, actual: str = "sentiment", predicted: str = "prediction") -> DataFrame:
    """E8 as one row: tn, fp, fn, tp (labels fixed to [0, 1])."""
    y, yhat = F.col(actual), F.col(predicted)
    return df.agg(
        F.count_if((y == 0) & (yhat == 0)).alias("tn"),
        F.count_if((y == 0) & (yhat == 1)).alias("fp"),
        F.count_if((y == 1) & (yhat == 0)).alias("fn"),
        F.count_if((y == 1) & (yhat == 1)).alias("tp"),
    )


def metric_columns(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """E9 from confusion counts (sklearn conventions, zero division -> 0)."""
    sup0, sup1 = tn + fp, fn + tp
    pred0, pred1 = tn + fn, fp + tp
    n = sup0 + sup1
    p0, p1 = _div(tn, pred0), _div(tp, pred1)
    r0, r1 = _div(tn, sup0), _div(tp, sup1)
    f0, f1 = _div(2 * tn, sup0 + pred0), _div(2 * tp, sup1 + pred1)
    present0 = ((sup0 > 0) | (pred0 > 0)).cast("int")
    present1 = ((sup1 > 0) | (pred1 > 0)).cast("int")
    k = present0 + present1

    def macro(a: Column, b: Column) -> Column:
        return _div(a * present0 + b * present1, k)

    def weighted(a: Column, b: Column) -> Column:
        return _div(a * sup0 + b * sup1, n)

    return {
        "accuracy": _div(tn + tp, n),
        "macro_precision": macro(p0, p1),
        "macro_recall": macro(r0, r1),
        "macro_f1": macro(f0, f1),
        "weighted_precision": weighted(p0, p1),
        "weighted_recall": weighted(r0, r1),
        "weighted_f1": weighted(f0, f1),
        "negative_precision": p0,
        "negative_recall": r0,
        "negative_f1": f0,
        "positive_precision": p1,
        "positive_recall": r1,
        "positive_f1": f1,
    }


def evaluate(df: DataFrame, actual: str = "sentiment", predicted: str = "prediction",
             threshold: float | None = None) -> DataFrame:
    """One row of metrics plus the confusion counts."""
    counts = confusion_counts(df, actual, predicted)
    m = metric_columns(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))
    return counts.select(
        F.lit(None if threshold is None else float(threshold)).cast("double").alias("decision_threshold"),
        *[c.alias(name) for name, c in m.items()],
        *[F.col(c).cast("long").alias(c) for c in ("tn", "fp", "fn", "tp")])


def confusion_matrix(metrics_row: DataFrame, actual: str = "actual_sentiment",
                     predicted: str = "predicted_sentiment") -> DataFrame:
    """E8 long form: (actual, predicted, count), rows = actual, labels [0, 1]."""
    return metrics_row.selectExpr(
        f"stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS ({actual}, {predicted}, count)")


def classification_report(metrics_row: DataFrame) -> DataFrame:
    """Per class, accuracy, macro and weighted average with support.

    The report always averages over both labels (it is given ``labels=[0,1]``),
    unlike the macro_* metrics, which use the labels present.
    """
    sup0 = F.col("tn") + F.col("fp")
    sup1 = F.col("fn") + F.col("tp")
    n = sup0 + sup1
    row = metrics_row.select(
        "*", sup0.alias("_s0"), sup1.alias("_s1"), n.alias("_n"))

    def entry(label: str, p, r, f, s) -> Column:
        return F.struct(F.lit(label).alias("label"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1_score"),
                        s.cast("long").alias("support"))

    c = F.col
    entries = F.array(
        entry(NEG, c("negative_precision"), c("negative_recall"), c("negative_f1"), c("_s0")),
        entry(POS, c("positive_precision"), c("positive_recall"), c("positive_f1"), c("_s1")),
        entry("accuracy", F.lit(None), F.lit(None), c("accuracy"), c("_n")),
        entry("macro avg", (c("negative_precision") + c("positive_precision")) / 2,
              (c("negative_recall") + c("positive_recall")) / 2,
              (c("negative_f1") + c("positive_f1")) / 2, c("_n")),
        entry("weighted avg",
              _div(c("negative_precision") * c("_s0") + c("positive_precision") * c("_s1"), c("_n")),
              _div(c("negative_recall") * c("_s0") + c("positive_recall") * c("_s1"), c("_n")),
              _div(c("negative_f1") * c("_s0") + c("positive_f1") * c("_s1"), c("_n")), c("_n")),
    )
    return row.select(F.inline(entries))


def threshold_sweep(df: DataFrame, thresholds: list[float] | None = None, actual: str = "sentiment",
                    proba: str = "positive_probability") -> DataFrame:
    """Metrics for every candidate threshold in one pass over ``df``.

    ``thresholds=None`` is the default grid; an empty list raises, and so does
    a row without a probability (when the result is computed)."""
    require_columns(df, [actual, proba], "The sweep's input")
    grid = sorted(float(t) for t in (default_grid() if thresholds is None else thresholds))
    if not grid:
        raise ValueError("at least one threshold is required")
    p = F.col(proba)
    lits = F.array(*[F.lit(t) for t in grid])
    # number of thresholds <= p as a flat sum of comparisons (codegen, no lambda)
    at_or_below = sum((p >= F.lit(t)).cast("int") for t in grid)
    # a model without probabilities leaves nulls: no threshold applies to them
    refused = F.raise_error(F.lit(f"{proba} is null: a sweep needs a model with probabilities")).cast("int")
    bucket = F.when(p.isNull(), refused).when(F.isnan(p), 0).otherwise(at_or_below)
    y = F.col(actual)
    counts = df.groupBy(bucket.alias("j")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    spark = df.sparkSession
    # grid row 0 stands for "below every threshold"; it only feeds the totals
    steps = spark.range(len(grid) + 1).select(
        F.col("id").cast("int").alias("j"),
        F.when(F.col("id") == 0, F.lit(None).cast("double"))
         .otherwise(F.element_at(lits, F.col("id").cast("int"))).alias("threshold"))
    # both sides have at most len(grid) + 1 rows
    table = steps.join(F.broadcast(counts), on="j", how="left").fillna(0, ["pos", "neg"])
    everything = Window.partitionBy()
    at_or_above = Window.orderBy(F.col("j").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    table = table.select(
        "j", "threshold",
        F.sum("pos").over(at_or_above).alias("tp"), F.sum("neg").over(at_or_above).alias("fp"),
        F.sum("pos").over(everything).alias("P"), F.sum("neg").over(everything).alias("N"))
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("P") - tp, F.col("N") - fp
    m = metric_columns(tn, fp, fn, tp)
    return table.where(F.col("j") > 0).select(
        "threshold", m["accuracy"].alias("accuracy"), m["macro_precision"].alias("macro_precision"),
        m["macro_recall"].alias("macro_recall"), m["macro_f1"].alias("macro_f1"),
        m["weighted_f1"].alias("weighted_f1"), m["negative_f1"].alias("negative_f1"),
        m["positive_f1"].alias("positive_f1"), fp.cast("long").alias("false_positives"),
        fn.cast("long").alias("false_negatives"))


def best_row(results: DataFrame, metric: str = "macro_f1", tie_break: str = "threshold") -> DataFrame:
    """The row with the highest ``metric`` (ties: smallest tie_break)."""
    if metric not in results.columns:
        raise ValueError(f"the results have no column {metric}")
    return results.orderBy(F.col(metric).desc(), F.col(tie_break).asc()).limit(1)


def threshold_row(results: DataFrame, value: float = 0.5) -> DataFrame:
    """The sweep row of one threshold (0.50 by default)."""
    return results.where(F.round("threshold", 2) == F.lit(value))


def error_table(df: DataFrame, actual: str = "sentiment", predicted: str = "prediction",
                p_neg: str | None = "negative_probability", p_pos: str | None = "positive_probability",
                keep: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Misclassified rows with type, confidence, length, words."""
    from polarity.functions.text import char_length, word_count
    from polarity.operators.quality import require_columns
    require_columns(df, [c for c in (actual, predicted, p_neg, p_pos, "text", "clean_text") if c], "The table of predictions")
    y, yhat = F.col(actual).cast("int"), F.col(predicted).cast("int")
    neg = F.col(p_neg).cast("double") if p_neg else F.lit(None).cast("double")
    pos = F.col(p_pos).cast("double") if p_pos else F.lit(None).cast("double")
    errors = df.where(y != yhat)
    return errors.select(
        *[F.col(k) for k in keep if k in df.columns],
        F.col("text").cast("string").alias("text"),
        F.col("clean_text").cast("string").alias("clean_text"),
        y.alias("actual_sentiment"),
        yhat.alias("predicted_sentiment"),
        F.when((y == 0) & (yhat == 1), "false_positive").otherwise("false_negative").alias("error_type"),
        F.greatest(neg, pos).alias("confidence"),
        neg.alias("negative_probability"),
        pos.alias("positive_probability"),
        char_length("clean_text").cast("long").alias("text_length"),
        word_count("clean_text").cast("long").alias("word_count"),
    )


def top_errors(errors: DataFrame, n: int = 100, order_key: str = "row_id") -> DataFrame:
    """The n most confident errors (top-k, not a full sort)."""
    return errors.orderBy(F.col("confidence").desc_nulls_last(), F.col(order_key).asc()).limit(n)


def error_summary(df: DataFrame, actual: str = "sentiment", predicted: str = "prediction") -> DataFrame:
    """Rows evaluated, errors, FP, FN and error rate in one aggregation."""
    y, yhat = F.col(actual), F.col(predicted)
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(y != yhat).alias("total_errors"),
        F.count_if((y == 0) & (yhat == 1)).alias("false_positives"),
        F.count_if((y != yhat) & ~((y == 0) & (yhat == 1))).alias("false_negatives"))
    return counts.select(
        F.col("total_rows").cast("long"), F.col("total_errors").cast("long"),
        F.col("false_positives").cast("long"), F.col("false_negatives").cast("long"),
        _div(F.col("total_errors"), F.col("total_rows")).alias("error_rate"))


def regression_gate(candidate: DataFrame, baseline: DataFrame, metric: str = "macro_f1") -> DataFrame:
    """C11: compare a candidate's metric with a baseline's (one row each)."""
    both = (candidate.select(F.lit("candidate").alias("_who"), F.col(metric).alias("_v"))
            .unionByName(baseline.select(F.lit("baseline").alias("_who"), F.col(metric).alias("_v"))))
    out = both.agg(F.max(F.when(F.col("_who") == "candidate", F.col("_v"))).alias("candidate_" + metric),
                   F.max(F.when(F.col("_who") == "baseline", F.col("_v"))).alias("baseline_" + metric))
    return out.withColumn("below_baseline",
                          F.coalesce(F.col("candidate_" + metric) < F.col("baseline_" + metric), F.lit(False)))


def variant_comparison(leaderboard: DataFrame, a: str = "real_word_char_hybrid",
                       b: str = "unigram_bigram", metric: str = "macro_f1") -> DataFrame:
    """Best score per feature variant and the difference a - b."""
    best = leaderboard.groupBy("tfidf_variant").agg(F.max(metric).alias("best_" + metric))
    w = Window.partitionBy()
    score_a = F.max(F.when(F.col("tfidf_variant") == a, F.col("best_" + metric))).over(w)
    score_b = F.max(F.when(F.col("tfidf_variant") == b, F.col("best_" + metric))).over(w)
    return best.withColumn(f"{a}_minus_{b}", score_a - score_b)
