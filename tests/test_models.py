"""Classifier factory, long form = vector form, persistence, scoring, stream = batch."""

import math

import pytest
from pyspark.ml.functions import vector_to_array

from polarity.operators import features as feat
from polarity.operators import linear, models, score
from polarity.plans import job
from polarity.sources import fixtures as fx


@pytest.fixture(scope="module")
def splits(spark):
    return job.posts_splits(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def baseline(spark, splits):
    return job.posts_baseline(spark, "/root/testdata/sf0.001", splits)[0]


def test_factory_objectives_and_unknown_name(spark):
    counts = {0: 30, 1: 10}
    of = lambda name, **cfg: models.linear_objective(name, {**models.MODEL_CONFIGS.get(name, {}), **cfg}, counts)
    balanced = {"negative": 40 / 60, "positive": 2.0}
    assert of("logistic_regression", C=0.5) == linear.Objective("logistic", 1.0, 0.5, **balanced)
    assert of("linear_svc") == linear.Objective("squared_hinge", 1.0, 1.0, **balanced)
    assert of("sgd_classifier", class_weight=None) == linear.Objective("logistic", 1e-4, 1 / 40, free_intercept=True)
    assert models.bayes_classifier({"alpha": 0.5}).getModelType() == "complement"
    for bad in ({"loss": "hinge"}, {"penalty": "l1"}):
        with pytest.raises(ValueError, match="log_loss"):
            of("sgd_classifier", **bad)
    for fn in (lambda: of("xgboost"), lambda: models.fit_classifiers(None, {"xgboost": {}}),
               lambda: linear.Objective("hinge", 1.0, 1.0), lambda: linear.Objective("logistic", 0.0, 1.0)):
        with pytest.raises(ValueError):
            fn()


def test_feature_spec_choices():
    assert feat.FeatureSpec.from_dict({"feature_type": "word", "ngram_range": [1, 2]}).parts[0].ngram_range == (1, 2)
    with pytest.raises(ValueError, match="no such feature_type"):
        feat.FeatureSpec.from_dict({"feature_type": "bert"})
    with pytest.raises(ValueError, match="two numbers"):
        feat.TfidfConfig(ngram_range=[1])


def test_vector_form_equals_long_form(spark, sf_small):
    docs = fx.reviews(spark, sf_small).withColumnRenamed("text", "clean_text")
    cfg = feat.BASELINE_TFIDF
    fm = feat.fit_features(docs, feat.FeatureSpec("word", (cfg,)))
    vocab = fm.stages[1].vocabulary
    vec = fm.transform(docs).select("row_id", vector_to_array("features").alias("v")).collect()
    dense = {(r.row_id, vocab[i]): x for r in vec for i, x in enumerate(r.v) if x != 0.0}
    long = {(r.row_id, r.term): r.tfidf for r in feat.tfidf_long(docs, cfg).collect()}
    assert dense.keys() == long.keys()
    assert all(math.isclose(dense[k], long[k], rel_tol=1e-9) for k in long)


def test_hybrid_structure_and_persistence(spark, sf_small, tmp_path, baseline, splits):
    table = splits
    train = job.part(table, "train")
    fm = feat.fit_features(train, feat.VARIANTS["real_word_char_hybrid"])
    assert type(fm.stages[-1]).__name__ == "VectorAssembler"
    model = baseline
    path = str(tmp_path / "model")
    models.save_model(model, path)
    loaded = models.load_model(path)
    test = job.part(table, "test")
    a = models.predict(model, test).select("row_id", "positive_probability").collect()
    b = models.predict(loaded, test).select("row_id", "positive_probability").collect()
    assert sorted(a) == sorted(b)
    with pytest.raises(FileNotFoundError):
        models.load_model(str(tmp_path / "missing"))


def test_scoring_columns_and_threshold(spark, sf_small, baseline):
    model = baseline
    df = spark.createDataFrame([(1, "bees hum at noon"), (2, None)], "row_id long, text string")
    out = score.score(df, model, threshold=0.47, keep=("row_id",))
    assert out.columns == ["row_id"] + score.PREDICTION_COLUMNS
    rows = out.orderBy("row_id").collect()
    assert rows[1].text == "" and rows[1].cleaned_text == ""
    for r in rows:
        assert r.predicted_label == (1 if r.positive_probability >= 0.47 else 0)
        assert r.predicted_sentiment == ("positive" if r.predicted_label == 1 else "negative")
    with pytest.raises(ValueError, match="have no column text"):
        score.score(spark.createDataFrame([("x",)], "message string"), model)


def test_guard_reasons(spark):
    df = spark.createDataFrame([("ok",), ("  ",), ("x" * 1001,), (None,)], "text string")
    got = [(r.accepted, r.rejection_reason) for r in score.guard_inputs(df).collect()]
    assert got == [(True, None), (False, "empty_text"), (False, "text_too_long"), (False, "empty_text")]


def test_stream_equals_batch(spark, sf_small):
    from polarity.streaming.replay import replay_unlabelled
    streamed, _ = replay_unlabelled(spark, sf_small, threshold=0.47)
    batch = job.score_unlabelled(spark, sf_small, 0.47)     # a fit of its own on the same rows
    cols = ["row_id", "cleaned_text", "predicted_label", "positive_probability"]
    assert sorted(streamed.select(cols).collect()) == sorted(batch.select(cols).collect())


def test_score_csv_and_guarded(spark, sf_small, tmp_path, baseline):
    model = baseline
    src = tmp_path / "in.csv"
    src.write_text('id,text\n7,a quiet harbour\n8,"wind, then rain"\n', encoding="utf-8")
    out = score.score_csv(spark, str(src), str(tmp_path / "out"), model, 0.47)
    assert out.columns == score.PREDICTION_COLUMNS and out.count() == 2
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "out"))
    assert sorted(r.text for r in back.collect()) == ["a quiet harbour", "wind, then rain"]
    df = spark.createDataFrame([(1, "fine"), (2, " "), (3, "x" * 1001)], "row_id long, text string")
    g = {r.row_id: r for r in score.score_guarded(df, model, 0.47).collect()}
    assert g[1].accepted and g[1].predicted_label in (0, 1)
    assert g[2].rejection_reason == "empty_text" and g[2].predicted_label is None
    assert g[3].rejection_reason == "text_too_long"


def test_stream_sinks_route_rejected_rows_and_log_metadata_only(spark, sf_small, tmp_path, baseline):
    from polarity.streaming.scoring import run_to_completion, start_scoring
    model = baseline
    src = str(tmp_path / "in")
    rows = [(1, "plain words"), (2, "   "), (3, "y" * 1001), (4, "meh @bob")]
    spark.createDataFrame(rows, "row_id long, text string").repartition(2).write.parquet(src)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    run_to_completion(start_scoring(spark, src, model, out, ckpt, threshold=0.47))
    scored = spark.read.parquet(f"{out}/scored")
    rejected = {r.row_id: r.rejection_reason for r in spark.read.parquet(f"{out}/rejected").collect()}
    log = spark.read.json(f"{out}/prediction_log")
    assert sorted(r.row_id for r in scored.collect()) == [1, 4]
    assert rejected == {2: "empty_text", 3: "text_too_long"}
    assert log.count() == 2 and "text" not in log.columns and "request_id" in log.columns
    sent = {r.request_id: r for r in scored.collect()}
    assert {r.request_id: (r.text_length, r.positive_probability) for r in log.collect()} \
        == {k: (len(r.cleaned_text), r.positive_probability) for k, r in sent.items()}
    assert {r.request_id for r in score.prediction_log(scored.drop("request_id")).collect()} == set(sent)
    # a rerun over the same checkpoint adds nothing (exactly-once file sink)
    run_to_completion(start_scoring(spark, src, model, out, ckpt, threshold=0.47))
    assert spark.read.parquet(f"{out}/scored").count() == 2


def test_threshold_range_and_positive_class(spark, sf_small, baseline):
    model = baseline
    df = spark.createDataFrame([(1, "x")], "row_id long, text string")
    with pytest.raises(ValueError, match="is a probability"):
        score.score(df, model, threshold=1.2)
    only_neg = spark.createDataFrame([(i, 0, f"t{i}") for i in range(4)], "row_id long, sentiment int, clean_text string")
    with pytest.raises(ValueError, match="no positive class"):
        models.class_counts(only_neg)


def test_model_without_probabilities(spark, sf_small, splits):
    table = splits
    train, val = job.part(table, "train"), job.part(table, "validation")
    fv = models.prepare_variant("basic", feat.VARIANTS["basic_unigram"], train, val)
    svc, _ = models.fit_classifier(fv, "linear_svc", models.MODEL_CONFIGS["linear_svc"])
    assert not models.has_probability(svc)
    metrics_row, preds = models.evaluate_model(svc, val)
    assert preds.where("positive_probability IS NOT NULL").count() == 0
    assert 0.0 <= metrics_row.first().accuracy <= 1.0
    with pytest.raises(ValueError, match="needs a model with probabilities"):
        models.evaluate_model(svc, val, threshold=0.5)
    out = score.score(val.select("row_id", "text"), svc, threshold=0.47, keep=("row_id",))
    own = {r.row_id: r.prediction for r in preds.select("row_id", "prediction").collect()}
    assert all(r.predicted_label == own[r.row_id] for r in out.collect())


def test_score_texts_keeps_order(spark, sf_small, baseline):
    model = baseline
    out = score.score_texts(spark, ["late trains again", "soup was cold", "  @bob  www.x.io "], model, 0.47)
    assert [o["text"] for o in out] == ["late trains again", "soup was cold", "  @bob  www.x.io "]
    assert out[2]["cleaned_text"] == "<USER> <URL>" and out[0]["decision_threshold"] == 0.47


def test_stream_log_uses_event_time(spark, sf_small, tmp_path, baseline):
    import datetime
    from pyspark.sql import types as T
    from polarity.streaming.scoring import run_to_completion, start_scoring
    model = baseline
    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("ts", T.TimestampType())])
    when = datetime.datetime(2024, 1, 2, 3, 4, 5)
    spark.createDataFrame([(1, "good", when)], schema).write.parquet(str(tmp_path / "in"))
    run_to_completion(start_scoring(spark, str(tmp_path / "in"), model, str(tmp_path / "out"),
                                    str(tmp_path / "ck"), 0.47, schema=schema, event_time="ts"))
    log = spark.read.json(str(tmp_path / "out" / "prediction_log")).first()
    assert log.timestamp.startswith("2024-01-02T03:04:05")
    assert spark.read.parquet(str(tmp_path / "out" / "scored")).first().ts == when


def test_stream_from_csv_files(spark, sf_small, tmp_path, baseline):
    from polarity.streaming.scoring import run_to_completion, start_scoring
    model = baseline
    src = tmp_path / "csv"
    src.mkdir()
    (src / "a.csv").write_text('row_id,text\n1,"great, really"\n2,"  "\n', encoding="utf-8")
    run_to_completion(start_scoring(spark, str(src), model, str(tmp_path / "out"), str(tmp_path / "ck"),
                                    0.47, fmt="csv"))
    assert [r.row_id for r in spark.read.parquet(str(tmp_path / "out" / "scored")).collect()] == [1]
    assert spark.read.parquet(str(tmp_path / "out" / "rejected")).first().rejection_reason == "empty_text"


def test_csv_streams_find_columns_by_name(spark, tmp_path, baseline):
    from polarity.streaming.scoring import read_stream, run_to_completion, start_scoring
    src = tmp_path / "csv"
    src.mkdir()
    (src / "a.csv").write_text("text,lang,row_id\nhello,en,3\n", encoding="utf-8")
    run_to_completion(start_scoring(spark, str(src), baseline, str(tmp_path / "out"), str(tmp_path / "ck"), 0.47, fmt="csv"))
    assert [(r.row_id, r.text) for r in spark.read.parquet(str(tmp_path / "out" / "scored")).collect()] == [(3, "hello")]
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "a.csv").write_text("message,row_id\nhello,3\n", encoding="utf-8")
    with pytest.raises(ValueError, match="no column"):
        read_stream(spark, str(bad), fmt="csv")


def test_score_csv_takes_any_text_column(spark, tmp_path, baseline):
    src = tmp_path / "in.csv"
    src.write_text("n,message\n1,grey skies\n", encoding="utf-8")
    out = score.score_csv(spark, str(src), str(tmp_path / "out"), baseline, 0.47, text_col="message")
    assert [r.text for r in out.collect()] == ["grey skies"]
    with pytest.raises(ValueError, match="no column"):
        score.score_csv(spark, str(src), str(tmp_path / "out2"), baseline, 0.47)


def test_vectors_need_their_length(spark, sf_small):
    docs = fx.reviews(spark, sf_small).withColumnRenamed("text", "clean_text")
    with pytest.raises(ValueError, match="max_features"):
        feat.fit_features(docs, feat.FeatureSpec("word", (feat.TfidfConfig(),)))


def test_vocabulary_cut_breaks_ties_by_term(spark):
    rows = [("b", 3, 5), ("a", 3, 5), ("d", 2, 4), ("c", 2, 4), ("e", 2, 4), ("f", 1, 1)]
    terms = spark.createDataFrame(rows, "term string, df long, tf_total long")
    for k, want in ((1, "a"), (2, "ab"), (3, "abc"), (4, "abcd"), (5, "abcde"), (6, "abcdef"), (9, "abcdef")):
        cfg = feat.TfidfConfig(min_df=1, max_df=10, max_features=k)
        assert sorted(r.term for r in feat.vocabulary(terms, 10, cfg).collect()) == list(want)


def test_default_stop_is_close_to_the_optimum(spark, sf_small):
    docs = fx.reviews(spark, sf_small).withColumnRenamed("text", "clean_text")
    fv = models.prepare_variant("basic", feat.VARIANTS["basic_unigram"], docs, docs)
    for name in ("logistic_regression", "sgd_classifier"):
        probabilities = []
        for tol in (models.DEFAULT_TOL, 1e-10):
            cfg = dict(models.MODEL_CONFIGS[name], tol=tol)
            fitted, _ = models.fit_classifier(fv, name, cfg)
            rows = models.predict(fitted, docs).select("row_id", "positive_probability").collect()
            probabilities.append({r[0]: r[1] for r in rows})
        assert max(abs(probabilities[0][i] - probabilities[1][i]) for i in probabilities[0]) < 1e-3, name


def test_operators_load_without_the_package_on_executors(tmp_path):
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "elsewhere.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import functions as F
from polarity.session import get_session
from polarity.functions.accents import strip_accents, stripped
from polarity.operators import linear
from pyspark.ml.linalg import Vectors
spark = get_session("local[2]", 2)
words = ["na\u00efve \ufb01n", "\u00bd", "\ud55c", "\u2019quote\u2019", "plain"]
rows = spark.createDataFrame([(w,) for w in words], "t string").repartition(2)
got = {{r.t: r.o for r in rows.select("t", strip_accents(F.col("t")).alias("o")).collect()}}
assert got == {{w: stripped(w) for w in words}}, got
vectors = spark.createDataFrame([(Vectors.sparse(2, [i % 2], [1.0]), i % 2) for i in range(9)], ["features", "sentiment"])
fit = linear.solve(linear.blocks(vectors, "features", "sentiment"), 2, {{"lr": linear.Objective("logistic", 1.0, 1.0)}})["lr"]
assert fit.converged and fit.weights[1] > 0 > fit.weights[0]
""", encoding="utf-8")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
