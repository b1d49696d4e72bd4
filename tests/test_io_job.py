"""Sources/sinks (A1-A7) and the end-to-end job."""

import os

import pytest

from polarity.operators import metrics as mx
from polarity.plans import job
from polarity.sources import fixtures as fx
from polarity.sources import io


def test_csv_quotes_commas_newlines(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('sentiment,text\n1,"hello, world"\n0,"she said ""hi"""\n1,"two\nlines"\n', encoding="utf-8")
    df = io.read_csv(spark, str(path), multi_line=True)
    rows = sorted(df.collect(), key=lambda r: r.row_id)
    assert [r.text for r in rows] == ["hello, world", 'she said "hi"', "two\nlines"]
    assert [r.sentiment for r in rows] == [1, 0, 1]
    with pytest.raises(FileNotFoundError):
        io.read_csv(spark, str(tmp_path / "missing.csv"))


def test_threshold_file_round_trip_and_range(spark, tmp_path):
    best = {"threshold": 0.47, "accuracy": 0.8, "macro_f1": 0.75, "weighted_f1": 0.78,
            "false_positives": 2, "false_negatives": 3}
    io.save_threshold_config(spark, best, str(tmp_path / "t"))
    loaded = io.load_threshold_config(spark, str(tmp_path / "t"))
    assert loaded["threshold"] == 0.47 and loaded["selected_metric_value"] == 0.75
    bad = dict(best, threshold=1.5)
    io.save_threshold_config(spark, bad, str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="is a probability"):
        io.load_threshold_config(spark, str(tmp_path / "bad"))
    with pytest.raises(FileNotFoundError):
        io.load_threshold_config(spark, str(tmp_path / "none"))


def test_report_round_trip(spark, tmp_path):
    report = {"rows_before": 3, "duplicate_report": {"rows_after": 2}, "label_distribution": {"0": 1, "1": 2}}
    io.write_report(spark, report, str(tmp_path / "r"))
    back = io.read_report(spark, str(tmp_path / "r"))
    assert back["rows_before"] == 3 and back["duplicate_report"]["rows_after"] == 2


def test_full_job_writes_every_output(spark, sf_small, tmp_path):
    out = str(tmp_path / "run")
    small = job.JobConfig(
        models={"logistic_regression": dict(job.models.MODEL_CONFIGS["logistic_regression"]),
                "complement_nb": dict(job.models.MODEL_CONFIGS["complement_nb"])},
        variants={"unigram_bigram": job.feat.VARIANTS["unigram_bigram"]})
    small.cols = job.Columns(text="body", label="y", row_id="n")
    named = fx.posts(spark, sf_small).withColumnsRenamed({"text": "body", "sentiment": "y", "row_id": "n"})
    result = job.run_job(spark, named, small, out)
    rep = result["cleaning_report"]
    assert rep["rows_before"] == 1000 and rep["validation_summary"]["total_rows"] == 1000
    sr = result["split_report"]
    assert sr["train_rows"] + sr["validation_rows"] + sr["test_rows"] == rep["rows_after"]
    assert result["leaderboard"].count() == 2
    assert result["threshold"] in mx.default_grid()
    assert result["final_test"].first().decision_threshold == result["threshold"]
    assert result["top_errors"].count() <= 100
    for name in ["cleaning_report", "split_report", "splits", "model_comparison", "error_analysis",
                 "top_misclassified_examples", "final_best_model_test_metrics", "threshold_tuning",
                 "models/baseline", "models/best_model", "models/decision_threshold", "error_summary",
                 "best_model_metrics", "final_best_model_test_predictions", "conflicting_duplicates",
                 "class_distribution", "baseline_validation_metrics", "baseline_test_metrics", "baseline_quality_gate",
                 "regression_gate", "confusion_matrix", "classification_report", "text_length_histogram"]:
        assert os.path.exists(os.path.join(out, name)), name
    best = io.read_report(spark, os.path.join(out, "best_model_metrics"))
    assert best["training_data"] == "train_only" and best["best_config"]["experiment_name"] == result["best"]["experiment_name"]
    parts = {d for d in os.listdir(os.path.join(out, "splits")) if d.startswith("split=")}
    assert parts == {"split=train", "split=validation", "split=test"}


def test_unreadable_csv_is_a_value_error(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("sentiment,text\nnot-a-number,hello\n", encoding="utf-8")
    with pytest.raises(ValueError, match="no readable CSV"):
        io.read_csv(spark, str(path))


def test_parquet_scan_and_missing_paths(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(0, 1, "a")], "row_id long, sentiment int, text string").write.parquet(path)
    assert io.read_table(spark, path).count() == 1
    with pytest.raises(FileNotFoundError):
        io.read_table(spark, str(tmp_path / "nope"))
    with pytest.raises(FileNotFoundError):
        io.read_report(spark, str(tmp_path / "nope"))


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "swapped.csv"
    path.write_text("text,extra,sentiment\n5,x,1\n", encoding="utf-8")
    row = io.read_csv(spark, str(path)).first()
    assert (row.text, row.sentiment, row.row_id) == ("5", 1, 0)
    path = tmp_path / "lacking.csv"
    path.write_text("message,sentiment\nhello,1\n", encoding="utf-8")
    with pytest.raises(ValueError, match="no column"):
        io.read_csv(spark, str(path))


def test_csv_files_keep_path_order(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.csv").write_text("sentiment,text\n1,first\n", encoding="utf-8")
    (folder / "b.csv").write_text("sentiment,text\n" + "".join(f"0,b{i}\n" for i in range(50)), encoding="utf-8")
    rows = {r.row_id: r.text for r in io.read_csv(spark, str(folder)).collect()}
    assert rows[0] == "first" and [rows[i + 1] for i in range(50)] == [f"b{i}" for i in range(50)]
    (folder / "c.csv").write_text("text,sentiment\nother header,1\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)header|readable"):
        io.read_csv(spark, str(folder)).collect()


def test_a_csv_file_is_split_into_tasks(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("sentiment,text\n" + "".join(f"{i % 2},row number {i}\n" for i in range(40000)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        df = io.read_csv(spark, str(path))
        assert io.read_csv(spark, str(path), with_row_id=False).rdd.getNumPartitions() > 4
        assert [r.text for r in df.orderBy("row_id").limit(3).collect()] == ["row number 0", "row number 1", "row number 2"]
        assert df.selectExpr("min(row_id)", "max(row_id)", "count(DISTINCT row_id)").first()[0:3] == (0, 39999, 40000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
