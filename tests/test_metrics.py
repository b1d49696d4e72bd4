"""Metrics, sweep and errors against brute-force definitions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from polarity.operators import metrics as mx


def py_metrics(y, p):
    labels = sorted(set(y) | set(p))
    out = {}
    per = {}
    for c in (0, 1):
        tp = sum(1 for a, b in zip(y, p) if a == c and b == c)
        pred = sum(1 for b in p if b == c)
        sup = sum(1 for a in y if a == c)
        prec = tp / pred if pred else 0.0
        rec = tp / sup if sup else 0.0
        f1 = 2 * tp / (sup + pred) if sup + pred else 0.0
        per[c] = (prec, rec, f1, sup)
    n = len(y)
    out["accuracy"] = sum(a == b for a, b in zip(y, p)) / n
    for i, name in enumerate(("precision", "recall", "f1")):
        out[f"macro_{name}"] = sum(per[c][i] for c in labels) / len(labels)
        out[f"weighted_{name}"] = sum(per[c][i] * per[c][3] for c in (0, 1)) / n
    return out


def frame(spark, y, proba):
    return spark.createDataFrame([(i, a, 1 - q, q) for i, (a, q) in enumerate(zip(y, proba))],
                                 "row_id long, sentiment int, negative_probability double, positive_probability double")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_metrics_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    y = [rnd.randint(0, 1) for _ in range(200)]
    p = [rnd.randint(0, 1) for _ in range(200)]
    df = spark.createDataFrame(list(zip(y, p)), "sentiment int, prediction int")
    got = mx.evaluate(df).first().asDict()
    for k, v in py_metrics(y, p).items():
        assert math.isclose(got[k], v, abs_tol=1e-12), k


def test_single_class_and_zero_division(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 0)], "sentiment int, prediction int")
    got = mx.evaluate(df).first()
    assert got.negative_precision == 0.0 and got.negative_recall == 0.0
    want = py_metrics([1, 1, 1], [1, 1, 0])
    assert math.isclose(got.macro_f1, want["macro_f1"])
    only = mx.evaluate(spark.createDataFrame([(1, 1)], "sentiment int, prediction int")).first()
    assert only.macro_f1 == 1.0 and only.negative_f1 == 0.0


def test_decision_moves_with_the_threshold(spark):
    df = frame(spark, [1, 0, 1], [0.31, 0.52, 0.88])
    for t, want in ((0.3, [1, 1, 1]), (0.5, [0, 1, 1]), (0.88, [0, 0, 1]), (0.9, [0, 0, 0])):
        got = df.withColumn("d", mx.decide(F.col("positive_probability"), t)).orderBy("row_id").collect()
        assert [r.d for r in got] == want


def test_sweep_refuses_an_empty_grid_and_missing_probabilities(spark):
    df = frame(spark, [0, 1], [0.2, 0.8])
    with pytest.raises(ValueError, match="at least one threshold"):
        mx.threshold_sweep(df, [])
    with pytest.raises(ValueError, match="lacks column"):
        mx.threshold_sweep(df.drop("positive_probability"))
    with pytest.raises(Exception, match="model with probabilities"):
        mx.threshold_sweep(df.withColumn("positive_probability", F.lit(None).cast("double"))).collect()


def test_threshold_is_inclusive_and_nan_safe(spark):
    df = spark.createDataFrame([(0.47,), (float("nan"),), (None,)], "p double")
    assert [r.d for r in df.select(mx.decide(F.col("p"), 0.47).alias("d")).collect()] == [1, 0, 0]


def test_sweep_equals_per_threshold_evaluation(spark):
    rnd = random.Random(7)
    y = [rnd.randint(0, 1) for _ in range(300)]
    q = [round(rnd.random(), 2) for _ in range(300)]
    df = frame(spark, y, q)
    sweep = {round(r.threshold, 2): r for r in mx.threshold_sweep(df).collect()}
    assert len(sweep) == 41
    for t in (0.3, 0.47, 0.5, 0.7):
        pred = [1 if v >= t else 0 for v in q]
        want = py_metrics(y, pred)
        row = sweep[t]
        assert math.isclose(row.macro_f1, want["macro_f1"], abs_tol=1e-12)
        assert row.false_positives == sum(1 for a, b in zip(y, pred) if a == 0 and b == 1)
        assert row.false_negatives == sum(1 for a, b in zip(y, pred) if a == 1 and b == 0)


def test_best_threshold_selection(spark):
    rows = [(round(0.3 + i / 100, 2), f) for i, f in enumerate((0.71, 0.84, 0.84, 0.2, 0.8399))]
    results = spark.createDataFrame(rows, "threshold double, macro_f1 double")
    assert mx.best_row(results).first().threshold == 0.31
    with pytest.raises(ValueError, match="have no column"):
        mx.best_row(results, "nope")


def test_error_table_types_and_confidence(spark):
    df = spark.createDataFrame(
        [(4, "so so", "so so", 1, 0, 0.55, 0.45), (6, "it  rained", "it rained", 0, 0, 0.9, 0.1),
         (9, "what a day", "what a day", 0, 1, 0.02, 0.98), (11, "", "", 1, 0, 0.5, 0.5)],
        "row_id long, text string, clean_text string, sentiment int, prediction int, "
        "negative_probability double, positive_probability double")
    errs = mx.error_table(df).orderBy("row_id").collect()
    assert [(e.row_id, e.error_type) for e in errs] == [(4, "false_negative"), (9, "false_positive"), (11, "false_negative")]
    assert [e.confidence for e in errs] == [0.55, 0.98, 0.5]
    assert [e.word_count for e in errs] == [2, 3, 0]


def test_gates_and_variant_comparison(spark):
    from polarity.operators import quality
    good = spark.createDataFrame([(0.8, 0.79)], "accuracy double, macro_f1 double")
    weak = spark.createDataFrame([(0.9, 0.7)], "accuracy double, macro_f1 double")
    assert not quality.quality_gate(good).first().below_quality_gate
    assert quality.quality_gate(weak).first().below_quality_gate
    g = mx.regression_gate(weak, good).first()
    assert g.candidate_macro_f1 == 0.7 and g.baseline_macro_f1 == 0.79 and g.below_baseline
    board = spark.createDataFrame(
        [("a", "real_word_char_hybrid", 0.80), ("b", "real_word_char_hybrid", 0.78), ("c", "unigram_bigram", 0.79)],
        "experiment_name string, tfidf_variant string, macro_f1 double")
    rows = {r.tfidf_variant: r for r in mx.variant_comparison(board).collect()}
    assert rows["real_word_char_hybrid"].best_macro_f1 == 0.80
    assert abs(rows["unigram_bigram"].real_word_char_hybrid_minus_unigram_bigram - 0.01) < 1e-12


def test_absent_columns_are_named(spark):
    from polarity.operators import features as feat, score
    df = spark.createDataFrame([(1, "x")], "row_id long, text string")
    for fn, what in ((lambda: mx.error_table(df), "clean_text"), (lambda: score.guard_inputs(df, "body"), "body"),
                     (lambda: feat.fit_vocabulary(df, feat.TfidfConfig()), "clean_text")):
        with pytest.raises(ValueError, match=what):
            fn()
