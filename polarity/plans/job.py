"""The end-to-end job (N1) and its stages as DataFrame -> DataFrame functions.

Order: profile -> clean/dedup -> split -> grid (whose LR / 1-2-gram cell is the
baseline: validation and test metrics) -> errors -> threshold -> final test.  One session; each stage's result that is
read again is written once to the checkpoint folder, so a lost executor
recomputes at most one stage.  Model selection and the threshold use
validation only; test is touched by the baseline test and the final test.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polarity.functions.text import CleaningFlags
from polarity.operators import dedup, features as feat, metrics as mx, models, quality, score, split
from polarity.operators.dedup import DEFAULT, Columns
from polarity.plans import stages
from polarity.session import materialize
from polarity.sources import fixtures as fx


@dataclass
class JobConfig:
    cols: Columns = DEFAULT
    allowed_labels: tuple = (0, 1)
    flags: CleaningFlags = field(default_factory=CleaningFlags)
    split: split.SplitConfig = field(default_factory=split.SplitConfig)
    thresholds: list[float] = field(default_factory=mx.default_grid)
    top_errors: int = 100
    models: dict = field(default_factory=lambda: dict(models.MODEL_CONFIGS))
    variants: dict = field(default_factory=lambda: dict(feat.VARIANTS))


def preprocess(df: DataFrame, cfg: JobConfig = JobConfig(), validate: bool = True) -> tuple[DataFrame, dict]:
    """F5 with C12 first: (materialised clean table, nested cleaning report)."""
    if validate:
        quality.check_dataset(df, cfg.cols, cfg.allowed_labels)
    exact = materialize(dedup.exact_groups(df, cfg.cols))
    summary = None
    if validate:
        data_cols = {c for c in df.columns if c != cfg.cols.row_id}
        # exact groups are the profile's groups when the data is (label, text):
        # one shuffle of the text serves both
        reuse = exact if data_cols == {cfg.cols.text, cfg.cols.label} else None
        summary = quality.profile_dict(df, cfg.cols, reuse)
    keyed = materialize(dedup.key_groups(exact, cfg.cols))
    grouped = materialize(dedup.clean_groups(dedup.dedup_survivors(keyed), cfg.cols, cfg.flags))
    report = dedup.cleaning_report(keyed, grouped).first().asDict()
    clean = dedup.clean_survivors(grouped)
    nested = {k: report[k] for k in ("rows_before", "rows_after", "empty_clean_text_rows_removed",
                                     "conflicting_clean_text_groups", "conflicting_clean_text_rows_removed",
                                     "same_label_clean_text_duplicates_removed",
                                     "total_clean_text_duplicates_removed")}
    nested["validation_summary"] = summary
    nested["duplicate_report"] = {
        "rows_before": report["rows_before"],
        "exact_duplicate_rows_removed": report["exact_duplicate_rows_removed"],
        "conflicting_duplicate_text_groups": report["conflicting_duplicate_text_groups"],
        "conflicting_duplicate_rows_removed": report["conflicting_duplicate_rows_removed"],
        "same_label_duplicate_rows_removed": report["same_label_duplicate_rows_removed"],
        "rows_after": report["rows_after_key_dedup"],
        # a frame, as in the reference's report: written as a table, not JSON
        "conflicting_duplicate_rows": dedup.conflicting_rows(exact, keyed),
    }
    return clean, nested


def split_dataset(clean: DataFrame, cfg: JobConfig = JobConfig()) -> tuple[DataFrame, dict]:
    """I1 + H1 + E7: (materialised table with ``split``, split report)."""
    if "clean_text" not in clean.columns:
        raise ValueError("split_dataset takes a cleaned table: there is no clean_text")
    table = materialize(split.stratified_split(clean, cfg.cols, cfg.split))
    split.assert_no_leakage(table)
    rows = split.split_report(table, cfg.cols).collect()
    report = {f"{s}_rows": sum(r["rows"] for r in rows if r["split"] == s) for s in split.SPLITS}
    for s in split.SPLITS:
        report[f"{s}_label_distribution"] = {
            str(r[cfg.cols.label]): r["rows"]
            for r in sorted(rows, key=lambda r: (r[cfg.cols.label] is None, r[cfg.cols.label])) if r["split"] == s}
    return table, report


def part(table: DataFrame, name: str) -> DataFrame:
    return table.where(F.col("split") == name).drop("split")


def run_job(spark: SparkSession, raw: DataFrame, cfg: JobConfig = JobConfig(),
            out_dir: str | None = None, resume_dir: str | None = None) -> dict:
    """Every stage in the reference's order; returns reports and frames.

    With ``resume_dir`` the clean table, the split and the fitted grid are
    committed there, and a rerun on the same input and settings reads what is
    there (``plans.stages``); ``result["stages_run"]`` names what was not.

    ``cfg.cols`` names the input's columns; from cleaning on they are called
    ``row_id``, ``sentiment`` and ``text``, as in every output."""
    named = {cfg.cols.row_id: DEFAULT.row_id, cfg.cols.label: DEFAULT.label, cfg.cols.text: DEFAULT.text}
    quality.require_columns(raw, list(named), "The job's input")
    raw, cfg = raw.withColumnsRenamed({k: v for k, v in named.items() if k != v}), replace(cfg, cols=DEFAULT)
    timings = {}
    done = stages.Stages(spark, resume_dir, stages.input_key(raw, repr(cfg)) if resume_dir else "")
    t = time.perf_counter()
    if not done.has("clean", "conflicting_rows", "cleaning_report"):
        clean, cleaning = preprocess(raw, cfg)
        conflicting = cleaning["duplicate_report"].pop("conflicting_duplicate_rows")
    clean = done.table("clean", lambda: clean)
    conflicting = done.table("conflicting_rows", lambda: conflicting)
    cleaning = done.report("cleaning_report", lambda: cleaning)
    cleaning["duplicate_report"]["conflicting_duplicate_rows"] = conflicting
    timings["preprocess"] = time.perf_counter() - t
    t = time.perf_counter()
    if not done.has("split", "split_report"):
        table, split_report = split_dataset(clean, cfg)
    table = done.table("split", lambda: table)
    split_report = done.report("split_report", lambda: split_report)
    train, val, test = part(table, "train"), part(table, "validation"), part(table, "test")
    timings["split"] = time.perf_counter() - t

    t = time.perf_counter()
    if not done.has("leaderboard", "grid"):
        board, fitted = models.run_experiments(train, val, cfg.models, cfg.variants)
    board = models.leaderboard(done.table("leaderboard", lambda: board))
    fitted = done.models("grid", lambda: fitted)
    best = models.select_best(board)
    best_model = fitted[best["experiment_name"]]
    timings["grid"] = time.perf_counter() - t

    t = time.perf_counter()
    # the baseline is TF-IDF (1-2 grams) + LR: the same fit as that grid cell
    same = (cfg.models.get("logistic_regression") == models.MODEL_CONFIGS["logistic_regression"]
            and cfg.variants.get("unigram_bigram") == feat.VARIANTS["unigram_bigram"])
    baseline = fitted.get("logistic_regression__unigram_bigram") if same else None
    if baseline is None:
        baseline = models.train_baseline(train, val)[0]
    baseline_val = models.evaluate_model(baseline, val)[0]
    baseline_test = models.evaluate_model(baseline, test)[0]
    baseline_gate = quality.quality_gate(baseline_val)
    timings["baseline"] = time.perf_counter() - t

    t = time.perf_counter()
    _, val_preds = models.evaluate_model(best_model, val)
    val_preds = materialize(val_preds.select("row_id", "sentiment", "text", "clean_text", "prediction",
                                             "negative_probability", "positive_probability"))
    errors = mx.error_table(val_preds)
    top = mx.top_errors(errors, cfg.top_errors)
    summary = mx.error_summary(val_preds)
    timings["errors"] = time.perf_counter() - t

    t = time.perf_counter()
    threshold = None
    sweep = None
    if models.has_probability(best_model):
        sweep = mx.threshold_sweep(val_preds, cfg.thresholds)
        threshold = mx.best_row(sweep).first()["threshold"]
    final_test, final_preds = models.evaluate_model(best_model, test, threshold)
    gate = mx.regression_gate(final_test, baseline_test)
    timings["threshold_and_final"] = time.perf_counter() - t

    result = {
        "cleaning_report": cleaning, "split_report": split_report, "clean": clean, "split": table,
        "baseline_model": baseline, "baseline_validation": baseline_val, "baseline_test": baseline_test,
        "leaderboard": board, "best": best, "best_model": best_model, "errors": errors, "top_errors": top,
        "error_summary": summary, "threshold_sweep": sweep, "threshold": threshold,
        "final_test": final_test, "final_test_predictions": score.evaluation_predictions(final_preds),
        "regression_gate": gate, "quality_gate": baseline_gate, "timings": timings, "stages_run": done.run,
        "confusion_matrix": mx.confusion_matrix(final_test),
        "classification_report": mx.classification_report(final_test),
        "length_histogram": quality.length_histogram(raw),
        "variant_comparison": mx.variant_comparison(board) if len(cfg.variants) > 1 else None,
    }
    if out_dir:
        write_outputs(spark, result, out_dir)
    return result


def write_outputs(spark: SparkSession, result: dict, out_dir: str) -> None:
    """Tables as Parquet, reports as JSON, models via ML persistence."""
    from polarity.sources import io
    report = dict(result["cleaning_report"])
    report["duplicate_report"] = dict(report["duplicate_report"])
    conflicts = report["duplicate_report"].pop("conflicting_duplicate_rows")
    io.write_report(spark, report, f"{out_dir}/cleaning_report")
    summary = report.get("validation_summary") or {}
    if summary.get("label_distribution"):
        dist = [(int(k) if k.lstrip("-").isdigit() else None, int(v))
                for k, v in summary["label_distribution"].items()]
        io.write_table(spark.createDataFrame(dist, "sentiment int, count long"), f"{out_dir}/class_distribution")
    io.write_table(conflicts, f"{out_dir}/conflicting_duplicates")
    io.write_report(spark, result["split_report"], f"{out_dir}/split_report")
    io.write_table(result["split"], f"{out_dir}/splits", partition_by=["split"])
    io.write_table(result["leaderboard"], f"{out_dir}/model_comparison")
    io.write_table(result["errors"], f"{out_dir}/error_analysis")
    io.write_table(result["top_errors"], f"{out_dir}/top_misclassified_examples")
    io.write_table(result["error_summary"], f"{out_dir}/error_summary")
    best = result["best"]
    io.write_report(spark, {
        "selected_by": "validation_macro_f1",
        "best_model_path": f"{out_dir}/models/best_model",
        "training_data": "train_only",
        "best_config": {k: best[k] for k in ("experiment_name", "model_name", "tfidf_variant")},
        "validation_metrics": {k: float(best[k]) for k in ("accuracy", "macro_precision", "macro_recall",
                                                           "macro_f1", "weighted_f1", "negative_f1", "positive_f1")},
    }, f"{out_dir}/best_model_metrics")
    for name, table in (("baseline_validation_metrics", "baseline_validation"), ("baseline_test_metrics", "baseline_test"),
                        ("baseline_quality_gate", "quality_gate"), ("regression_gate", "regression_gate"),
                        ("confusion_matrix", "confusion_matrix"), ("classification_report", "classification_report"),
                        ("text_length_histogram", "length_histogram"), ("variant_comparison", "variant_comparison")):
        if result[table] is not None:
            io.write_table(result[table], f"{out_dir}/{name}")
    io.write_table(result["final_test"], f"{out_dir}/final_best_model_test_metrics")
    io.write_table(result["final_test_predictions"], f"{out_dir}/final_best_model_test_predictions")
    models.save_model(result["baseline_model"], f"{out_dir}/models/baseline")
    models.save_model(result["best_model"], f"{out_dir}/models/best_model")
    if result["threshold_sweep"] is not None:
        io.write_table(result["threshold_sweep"], f"{out_dir}/threshold_tuning")
        best = mx.best_row(result["threshold_sweep"]).first().asDict()
        io.save_threshold_config(spark, best, f"{out_dir}/models/decision_threshold")


# --- inputs of the registered queries: posts, split and fitted ----------------------

def posts_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean, _ = preprocess(fx.posts(spark, sf_dir))
    return split_dataset(clean)[0]


def posts_baseline(spark: SparkSession, sf_dir: str, table: DataFrame | None = None):
    """(fitted baseline, its validation metrics); ``table``: posts already split."""
    table = posts_splits(spark, sf_dir) if table is None else table
    return models.train_baseline(part(table, "train"), part(table, "validation"))


def posts_grid(spark: SparkSession, sf_dir: str, table: DataFrame | None = None):
    """(leaderboard, fitted pipelines); ``table``: posts already split."""
    table = posts_splits(spark, sf_dir) if table is None else table
    board, fitted = models.run_experiments(part(table, "train"), part(table, "validation"))
    return materialize(board), fitted


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entry(): clean/dedup -> exact split -> TF-IDF + LR -> test metrics."""
    table = posts_splits(spark, sf_dir)
    model, _ = posts_baseline(spark, sf_dir, table)
    metrics_row = models.evaluate_model(model, part(table, "test"))[0]
    return metrics_row.select(F.lit("test").alias("split"), "*")


def score_unlabelled(spark: SparkSession, sf_dir: str, threshold: float | None = 0.47, model=None) -> DataFrame:
    model = posts_baseline(spark, sf_dir)[0] if model is None else model
    return score.score(fx.unlabelled(spark, sf_dir), model, threshold, keep=("row_id",))
