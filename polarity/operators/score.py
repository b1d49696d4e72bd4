"""Batch scoring, evaluation predictions and input guards.

Scoring is one plan: clean (Column expressions) -> the fitted pipeline's
``transform`` -> probabilities from ``vector_to_array`` -> the tuned decision
``p >= t`` (or the model's own) -> a fixed projection.  The model is shipped
to executors once per job; nothing is scored row by row on the driver.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polarity.functions.text import CleaningFlags, char_length, clean_text, is_blank
from polarity.operators import metrics as mx
from polarity.operators.models import check_threshold, has_probability, predict
from polarity.operators.quality import require_columns
from polarity.session import spread

# The scoring output columns, in order, and the input limits.
PREDICTION_COLUMNS = ["text", "cleaned_text", "predicted_label", "predicted_sentiment",
                      "decision_threshold", "negative_probability", "positive_probability"]
MAX_TEXT_LENGTH = 1000


def label_name(label) -> F.Column:
    """1 -> positive, anything else -> negative."""
    return F.when(label == 1, "positive").otherwise("negative")


def score(df: DataFrame, model: PipelineModel, threshold: float | None = None, text_col: str = "text",
          keep: tuple[str, ...] = (), flags: CleaningFlags = CleaningFlags()) -> DataFrame:
    """K1/K2: score every row; output = ``keep`` + the seven prediction columns.

    Null text scores as ''.  With a threshold and probabilities the label is
    ``p_positive >= threshold``; otherwise the model's own decision.
    """
    if text_col not in df.columns:
        raise ValueError(f"the rows to score have no column {text_col}")
    if threshold is not None:
        check_threshold(threshold)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    if not df.isStreaming:  # per-row model work: at least one task per core
        df = spread(df)
    prepared = df.select(*keep, text.alias("_text")).withColumn("clean_text", clean_text("_text", flags))
    out = predict(model, prepared)
    use_threshold = threshold is not None and has_probability(model)
    label = mx.decide(F.col("positive_probability"), threshold) if use_threshold else F.col("prediction")
    return out.select(
        *keep,
        F.col("_text").alias("text"),
        F.col("clean_text").alias("cleaned_text"),
        label.cast("int").alias("predicted_label"),
        label_name(label).alias("predicted_sentiment"),
        F.lit(None if threshold is None else float(threshold)).cast("double").alias("decision_threshold"),
        "negative_probability",
        "positive_probability",
    )


def evaluation_predictions(preds: DataFrame, label: str = "sentiment", keep: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """K4: the evaluation prediction table (integer predicted label)."""
    return preds.select(
        *[k for k in keep if k in preds.columns],
        F.col("text").cast("string").alias("text"),
        F.col("clean_text").cast("string").alias("clean_text"),
        F.col(label).cast("int").alias("actual_sentiment"),
        F.col("prediction").cast("int").alias("predicted_sentiment"),
        "negative_probability", "positive_probability")


def guard_inputs(df: DataFrame, text_col: str = "text", max_length: int = MAX_TEXT_LENGTH) -> DataFrame:
    """Accepted flag and rejection reason per row (blank, too long).

    The online service rejected a whole request; on tables each row is
    routed instead, and the batch-size cap becomes source rate control.
    """
    require_columns(df, [text_col], "The rows to score")
    text = F.col(text_col)
    reason = (F.when(text.isNull() | is_blank(text), "empty_text")
               .when(char_length(text) > max_length, "text_too_long"))
    return df.withColumn("rejection_reason", reason).withColumn("accepted", reason.isNull())


def request_of(row_id: str) -> F.Column:
    """The request id of a row: a digest of its id."""
    return F.md5(F.concat(F.lit("request:"), F.col(row_id).cast("string")))


def prediction_log(scored: DataFrame, event_time: str | None = None, request_id: str | None = None) -> DataFrame:
    """Metadata only - never the text; length of the cleaned text.

    Without a ``request_id`` column it is derived from ``row_id`` when there
    is one, so that the log and the predictions match and reruns agree."""
    ts = F.col(event_time) if event_time else F.current_timestamp()
    own = request_of("row_id") if "row_id" in scored.columns else F.expr("uuid()")
    rid = F.col(request_id) if request_id else own
    return scored.select(
        ts.alias("timestamp"),
        rid.alias("request_id"),
        "predicted_label", "predicted_sentiment", "positive_probability", "negative_probability",
        F.col("decision_threshold").alias("threshold"),
        char_length("cleaned_text").cast("long").alias("text_length"),
    )


def score_guarded(df: DataFrame, model: PipelineModel, threshold: float | None = None,
                  text_col: str = "text", keep: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """K7: guard every row (C7), score the accepted ones; rejected rows keep
    their reason and carry null predictions.  One output, no row dropped."""
    said = F.col(text_col).cast("string")
    guarded = guard_inputs(df, text_col).select(
        *keep, "accepted", "rejection_reason", said.alias("_said"), F.when(F.col("accepted"), said).alias("_scored"))
    # one pass: rejected rows go through the model as empty texts
    scored = score(guarded, model, threshold, "_scored", keep=(*keep, "accepted", "rejection_reason", "_said"))
    own = [c for c in PREDICTION_COLUMNS if c not in ("text", "decision_threshold")]
    return scored.select(*keep, "accepted", "rejection_reason", *[
        F.col("_said").alias(c) if c == "text" else F.when(F.col("accepted"), F.col(c)).alias(c) if c in own else F.col(c)
        for c in PREDICTION_COLUMNS])


def score_csv(spark, input_path: str, output_path: str, model: PipelineModel,
              threshold: float | None = None, text_col: str = "text", multi_line: bool = False) -> DataFrame:
    """K3: CSV in -> the seven prediction columns -> CSV out (header, quoted).

    ``text_col`` is looked up in the header; other columns are left out."""
    from polarity.sources import io
    wanted = T.StructType([T.StructField(text_col, T.StringType())])
    df = io.read_csv(spark, input_path, schema=wanted, with_row_id=False, multi_line=multi_line)
    out = score(df, model, threshold, text_col)
    io.write_table(out, output_path, fmt="csv")
    return out


def score_texts(spark, texts: list[str], model: PipelineModel, threshold: float | None = None) -> list[dict]:
    """K1 for a handful of strings (the old one-text / many-texts entry points):
    the same plan as ``score``, returned as dicts in input order."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "_i long, text string")
    rows = score(df, model, threshold, keep=("_i",)).orderBy("_i").collect()
    return [{k: r[k] for k in PREDICTION_COLUMNS} for r in rows]
