"""Distributed Newton fits against dense full Newton steps, and their scans."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from polarity.operators import linear, models
from polarity.operators.linear import Objective

OBJECTIVES = {
    "lr": Objective("logistic", 1.0, 1.0, negative=0.7, positive=1.8),
    "svc": Objective("squared_hinge", 1.0, 1.0, negative=0.7, positive=1.8),
    "sgd": Objective("logistic", 1e-3, 1 / 200, free_intercept=True),
}


def table(n=200, d=30, seed=3):
    rng = np.random.default_rng(seed)
    x = (rng.random((n, d)) < 0.2) * rng.random((n, d))
    y = ((x @ rng.normal(size=d) * 3 + rng.normal(size=n) * 0.4) > 0.1).astype(int)
    x[5] = 0.0                                                  # a row without features
    return x, y, rng.random(n) + 0.5


def frame(spark, x, y, w, dense=False):
    vec = lambda row: Vectors.dense(row) if dense else Vectors.sparse(len(row), np.flatnonzero(row).tolist(), row[row != 0].tolist())
    rows = [(vec(r), int(a), float(b)) for r, a, b in zip(x, y, w)]
    return spark.createDataFrame(rows, ["features", "sentiment", "w"]).repartition(5)


def value_and_gradient(o, x, y, w, at):
    x = np.hstack([x, np.ones((len(x), 1))])
    sign = np.where(y == 1, 1.0, -1.0)
    c = o.scale * w * np.where(y == 1, o.positive, o.negative)
    m = sign * (x @ at)
    ridge = np.full(len(at), o.penalty)
    if o.free_intercept:
        ridge[-1] = 0.0
    if o.loss == "logistic":
        loss, first, second = np.logaddexp(0, -m), -1 / (1 + np.exp(m)), 1 / (2 + np.exp(m) + np.exp(-m))
    else:
        short = np.maximum(1 - m, 0)
        loss, first, second = short ** 2, -2 * short, 2.0 * (short > 0)
    hessian = x.T @ (x * (c * second)[:, None]) + np.diag(ridge)
    return 0.5 * ridge @ at ** 2 + c @ loss, ridge * at + x.T @ (c * sign * first), hessian


def optimum(o, x, y, w):
    """Full Newton steps with halving, on the whole matrix."""
    at = np.zeros(x.shape[1] + 1)
    for _ in range(200):
        f, g, h = value_and_gradient(o, x, y, w, at)
        if np.linalg.norm(g) < 1e-11:
            break
        step, t = np.linalg.solve(h, g), 1.0
        while value_and_gradient(o, x, y, w, at - t * step)[0] > f and t > 1e-12:
            t /= 2
        at = at - t * step
    return at


@pytest.mark.parametrize("dense", [False, True])
def test_fits_reach_the_optimum(spark, dense):
    x, y, w = table()
    data = linear.blocks(frame(spark, x, y, w, dense), "features", "sentiment", "w")
    for name, fit in linear.solve(data, x.shape[1], OBJECTIVES, tol=1e-9).items():
        best = optimum(OBJECTIVES[name], x, y, w)
        found = np.append(fit.weights, fit.intercept)
        assert np.abs(found - best).max() < 1e-5, name
        f, g, _ = value_and_gradient(OBJECTIVES[name], x, y, w, found)
        g0 = value_and_gradient(OBJECTIVES[name], x, y, w, np.zeros_like(found))[1]
        assert np.isclose(fit.loss, f) and np.isclose(fit.gradient, np.linalg.norm(g) / np.linalg.norm(g0), atol=1e-12)
        assert fit.converged and fit.gradient <= 1e-9


def test_one_scan_a_round_and_converged_models_leave(spark):
    x, y, w = table()
    data = linear.blocks(frame(spark, x, y, w), "features", "sentiment", "w")
    rounds = []
    fits = linear.solve(data, x.shape[1], OBJECTIVES, tol={"lr": 1e-2, "svc": 1e-8, "sgd": 1e-3}, log=rounds.append)
    assert len(rounds) == max(f.passes for f in fits.values()) < sum(f.passes for f in fits.values())
    assert set(rounds[0]) == {"lr", "svc", "sgd"} and len(rounds[-1]) < 3
    for name, fit in fits.items():
        assert sum(name in r for r in rounds) == fit.passes


def test_sums_of_many_tasks_and_small_blocks_agree(spark, monkeypatch):
    x, y, w = table(seed=4)
    df = frame(spark, x, y, w)
    whole = linear.solve(linear.blocks(df, "features", "sentiment", "w"), x.shape[1], OBJECTIVES, tol=1e-8)
    monkeypatch.setattr(linear, "BLOCK_CELLS", 7)
    monkeypatch.setattr(linear, "DIRECT_TASKS", 1)
    monkeypatch.setattr(linear, "SLICES", 4)
    data = linear.blocks(df, "features", "sentiment", "w")
    assert data.count() > 50
    cut = linear.solve(data, x.shape[1], OBJECTIVES, tol=1e-8)
    for name in OBJECTIVES:
        assert np.allclose(whole[name].weights, cut[name].weights, atol=1e-5)


def test_tables_without_rows_and_steps_that_run_out(spark):
    x, y, w = table()
    df = frame(spark, x, y, w)
    none = linear.solve(linear.blocks(df.filter("w < 0"), "features", "sentiment", "w"), x.shape[1], OBJECTIVES)
    assert all(f.converged and not f.weights.any() for f in none.values())
    short = linear.solve(linear.blocks(df, "features", "sentiment"), x.shape[1], {"svc": OBJECTIVES["svc"]}, tol=1e-12, max_steps=2)
    assert not short["svc"].converged and 0 < short["svc"].gradient < 1


def test_spark_models_score_as_the_fit_does(spark):
    x, y, w = table()
    df = frame(spark, x, y, w)
    fits = linear.solve(linear.blocks(df, "features", "sentiment", "w"), x.shape[1], OBJECTIVES)
    raw = lambda row, f: float(row.features.toArray() @ f.weights + f.intercept)
    for row in models.linear_stage("logistic_regression", fits["lr"]).transform(df).collect():
        assert np.isclose(row.probability[1], 1 / (1 + np.exp(-raw(row, fits["lr"]))))
    for row in models.linear_stage("linear_svc", fits["svc"]).transform(df).collect():
        assert np.isclose(row.rawPrediction[1], raw(row, fits["svc"])) and row.prediction == (raw(row, fits["svc"]) > 0)
