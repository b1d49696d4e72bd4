"""What survives a failure: split CSV records, paired sinks, committed stages."""

import csv
import random

import pytest

from polarity.operators import features as feat, models
from polarity.plans import job, stages
from polarity.sources import fixtures as fx, io
from polarity.streaming import scoring


@pytest.fixture(scope="module")
def bayes(spark, sf_small):
    table = job.posts_splits(spark, sf_small)
    fv = models.prepare_variant("basic", feat.VARIANTS["basic_unigram"], job.part(table, "train"), job.part(table, "validation"))
    return models.fit_classifier(fv, "complement_nb", models.MODEL_CONFIGS["complement_nb"])[0]


@pytest.fixture
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "9000", "spark.sql.files.openCostInBytes": "100"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write(path, rows, ending, header=("text", "lang", "sentiment")):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=ending)
        w.writerow(header)
        w.writerows([t, "en", s] for s, t in rows)


def test_quoted_line_breaks_are_read_by_many_tasks(spark, tmp_path, small_blocks):
    rng = random.Random(1)
    bits = ["a", "b c", '"', "\n", ",", "é", '""', 'x"y', "\n\n", " ", "long " * 30]
    rows = [(rng.randint(0, 1), "".join(rng.choice(bits) for _ in range(rng.randint(1, 9)))) for _ in range(1500)]
    rows[700] = (1, "\n".join(f'line "{i}", still the same text' for i in range(2000)))       # longer than several blocks
    write(tmp_path / "a.csv", rows[:1000], "\n")
    write(tmp_path / "b.csv", rows[1000:], "\n")
    read = io.read_quoted_csv(spark, str(tmp_path))
    assert [(r.sentiment, r.text) for r in read.orderBy("row_id").collect()] == rows
    assert io.csv_records(spark, str(tmp_path)).select("path", "block").distinct().count() > 6
    whole = io.read_csv(spark, str(tmp_path), multi_line=True)
    assert sorted(map(tuple, whole.select("sentiment", "text").collect())) == sorted(rows)


def test_windows_line_ends_and_errors(spark, tmp_path, small_blocks):
    rows = [(i % 2, f"row {i}\r\nof \"two\" lines") for i in range(400)]
    write(tmp_path / "w.csv", rows, "\r\n")
    read = io.read_quoted_csv(spark, str(tmp_path / "w.csv"))
    assert [(r.sentiment, r.text) for r in read.orderBy("row_id").collect()] == rows
    with pytest.raises(FileNotFoundError):
        io.read_quoted_csv(spark, str(tmp_path / "none.csv"))
    write(tmp_path / "x.csv", [], "\n", header=("body", "sentiment"))
    with pytest.raises(ValueError, match="no column"):
        io.read_quoted_csv(spark, str(tmp_path / "x.csv"))
    with pytest.raises(ValueError, match="different headers"):
        io.read_quoted_csv(spark, str(tmp_path))
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.csv").write_text("")
    with pytest.raises(ValueError, match="no record"):
        io.read_quoted_csv(spark, str(tmp_path / "empty"))
    write(tmp_path / "empty" / "e.csv", [], "\n")
    assert io.read_quoted_csv(spark, str(tmp_path / "empty")).count() == 0


def test_a_stream_killed_between_its_sinks_pairs_every_row_once(spark, tmp_path, bayes, monkeypatch):
    rows = [(i, f"@user{i} view number {i}" if i % 9 else "  ") for i in range(60)]
    spark.createDataFrame(rows, "row_id long, text string").repartition(3).write.parquet(str(tmp_path / "in"))

    def start():
        return scoring.start_paired_scoring(spark, str(tmp_path / "in"), bayes, str(tmp_path / "out"), str(tmp_path / "ck"), 0.47,
                                            max_files_per_trigger=1)

    log, calls = scoring.prediction_log, []

    def fails_once(*args, **kw):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost between the sinks")
        return log(*args, **kw)

    monkeypatch.setattr(scoring, "prediction_log", fails_once)
    with pytest.raises(Exception, match="lost between the sinks"):
        scoring.run_to_completion([start()])
    ids = lambda name: [r.request_id for r in scoring.read_paired(spark, str(tmp_path / "out"), name).collect()]
    assert (tmp_path / "out" / "scored" / "batch=1").exists() and 0 < len(ids("scored")) < 53      # batch 1 isn't shown
    assert sorted(ids("scored")) == sorted(ids("prediction_log"))
    scoring.run_to_completion([start()])
    scored = scoring.read_paired(spark, str(tmp_path / "out"), "scored")
    assert scored.select("batch").distinct().count() == 3                                          # one file a batch
    assert sorted(ids("scored")) == sorted(ids("prediction_log")) == sorted(set(ids("scored")))
    assert sorted(r.row_id for r in scored.collect()) == [i for i in range(60) if i % 9]
    assert scoring.read_paired(spark, str(tmp_path / "out"), "rejected").count() == 7
    scoring.run_to_completion([start()])                                                           # nothing new
    assert len(ids("scored")) == 53
    with pytest.raises(ValueError):
        scoring.read_paired(spark, str(tmp_path / "out"), "commits")


def test_a_rerun_starts_at_the_missing_stage(spark, tmp_path, sf_small, monkeypatch):
    cfg = job.JobConfig(models={"complement_nb": models.MODEL_CONFIGS["complement_nb"]},
                        variants={"basic_unigram": feat.VARIANTS["basic_unigram"]})
    root = str(tmp_path / "stages")

    def run(c=cfg):
        return job.run_job(spark, fx.posts(spark, sf_small), c, resume_dir=root)

    real = models.run_experiments

    def lost(*args, **kw):
        raise RuntimeError("lost in the grid")

    monkeypatch.setattr(models, "run_experiments", lost)
    with pytest.raises(RuntimeError, match="lost in the grid"):
        run()
    monkeypatch.setattr(models, "run_experiments", real)
    never = lambda *a, **k: pytest.fail("an earlier stage was run again")
    monkeypatch.setattr(job, "preprocess", never)
    monkeypatch.setattr(job, "split_dataset", never)
    second = run()
    assert second["stages_run"] == ["leaderboard", "grid"]
    monkeypatch.setattr(models, "run_experiments", never)
    third = run()
    assert third["stages_run"] == [] and third["threshold"] == second["threshold"]
    assert third["final_test"].collect() == second["final_test"].collect()
    assert third["cleaning_report"]["rows_after"] == second["cleaning_report"]["rows_after"]
    monkeypatch.undo()
    other = job.JobConfig(models=cfg.models, variants=cfg.variants, thresholds=[0.4, 0.5])
    assert run(other)["stages_run"][0] == "clean"                                 # other settings, other stages
    plain = job.run_job(spark, fx.posts(spark, sf_small), cfg)
    assert plain["final_test"].collect() == second["final_test"].collect() and plain["stages_run"] == []


def test_a_half_written_stage_counts_as_missing(spark, tmp_path):
    done = stages.Stages(spark, str(tmp_path), "k")
    done.table("t", lambda: spark.range(3))
    (tmp_path / "k" / "t" / "_SUCCESS").unlink()
    again = stages.Stages(spark, str(tmp_path), "k")
    assert again.table("t", lambda: spark.range(5)).count() == 5 and again.run == ["t"]
    assert again.report("r", lambda: {"a": 1}) == {"a": 1} == stages.Stages(spark, str(tmp_path), "k").report("r", lambda: 1 / 0)
