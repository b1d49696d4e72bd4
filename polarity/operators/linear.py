"""Linear models by distributed trust-region Newton steps.

All models of a feature variant are fitted side by side.  A solver is a small
generator that asks for what it needs next - loss, gradient and Hessian
diagonal at a point, or a Hessian-vector product - and every scan of the rows
answers the open questions of all models at once; a model that has converged
asks no more.  Rows lie in blocks (compressed sparse rows in binary columns),
tasks add up their blocks, and with many tasks a second stage adds up the
sums, slice by slice, so the driver gets one vector per question whatever the
number of rows.  Losses: logistic, and the squared hinge over the rows inside
the margin.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polarity.session import materialize, ship_with_tasks

ship_with_tasks(__name__)

BLOCK_CELLS = 1 << 20       # non-zero cells of a block, about 12 MB
DIRECT_TASKS = 16           # above this, sums of tasks are added up in a stage of their own
SLICES = 32
BLOCKS = "rows int, starts binary, places binary, cells binary, signs binary, weights binary"


@dataclass(frozen=True)
class Objective:
    """penalty/2 * |w|^2 + scale * sum(weight_i * loss(sign_i * margin_i)).

    The last coordinate is the intercept; it is penalised like the others
    (a constant feature) or left free.  ``negative`` and ``positive`` multiply
    the weights of the rows of a class.
    """

    loss: str                   # "logistic" or "squared_hinge"
    penalty: float
    scale: float
    free_intercept: bool = False
    negative: float = 1.0
    positive: float = 1.0

    def __post_init__(self):
        if self.loss not in LOSSES:
            raise ValueError(f"no such loss: {self.loss}")
        if not (self.penalty > 0 and self.scale > 0):
            raise ValueError("penalty and scale must be positive")


@dataclass
class Fit:
    weights: np.ndarray
    intercept: float
    loss: float
    gradient: float             # norm at the end as a share of the norm at zero
    steps: int
    passes: int                 # scans that worked for this model
    task_seconds: float         # time of its own sums in all tasks
    converged: bool


# --- losses of the signed margin m: (loss, derivative, second derivative) -----------

def _logistic(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    e = np.exp(-np.abs(m))
    p = np.where(m > 0, e, 1.0) / (1.0 + e)         # 1 / (1 + exp(m))
    return np.log1p(e) + np.maximum(-m, 0.0), -p, p * (1.0 - p)


def _squared_hinge(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    short = np.maximum(1.0 - m, 0.0)
    return short * short, -2.0 * short, 2.0 * (short > 0)


LOSSES = {"logistic": _logistic, "squared_hinge": _squared_hinge}


# --- blocks of rows ----------------------------------------------------------------

def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column(0)
        sparse = np.asarray(vectors.field("type")) == 0
        places, cells = vectors.field("indices"), vectors.field("values")
        counts = np.diff(np.asarray(cells.offsets)) if len(batch) else np.zeros(0, np.int64)
        flat = np.asarray(cells.flatten(), dtype=np.float64)
        starts = np.concatenate(([0], np.cumsum(counts)))
        if sparse.all():
            where = np.asarray(places.flatten(), dtype=np.int32)
        else:                   # dense vectors name no places
            own = places.to_pylist()
            where = np.concatenate([np.arange(n) if p is None else p for p, n in zip(own, counts)]).astype(np.int32)
        sign = np.where(np.asarray(batch.column(1)) == 1, 1.0, -1.0)
        weight = np.asarray(batch.column(2), dtype=np.float64)
        at = 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + BLOCK_CELLS, side="right")) - 1)
            a, b = starts[at], starts[to]
            row = [to - at, (starts[at:to + 1] - a).astype(np.int64), where[a:b], flat[a:b], sign[at:to], weight[at:to]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[0]], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in row[1:]]],
                names=["rows", "starts", "places", "cells", "signs", "weights"])
            at = to


def blocks(df: DataFrame, features: str, label: str, weight: str | None = None) -> DataFrame:
    """Training rows as blocks, written once.  Labels other than 1 are negative."""
    rows = df.select(features, label, (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("_w"))
    # read once a round: decompressing would cost more than the bytes it saves
    return materialize(rows.mapInArrow(_to_blocks, BLOCKS), "none")


class _Block:
    def __init__(self, row: dict):
        self.n = row["rows"]
        self.starts = np.frombuffer(row["starts"], np.int64)
        self.places = np.frombuffer(row["places"], np.int32)
        self.cells = np.frombuffer(row["cells"], np.float64)
        self.signs = np.frombuffer(row["signs"], np.float64)
        self.weights = np.frombuffer(row["weights"], np.float64)
        self.counts = np.diff(self.starts)
        self.filled = np.flatnonzero(self.counts)

    def margins(self, w: np.ndarray) -> np.ndarray:
        """x . w of every row, the intercept included."""
        out = np.full(self.n, w[-1])
        if len(self.cells):
            out[self.filled] += np.add.reduceat(self.cells * w[self.places], self.starts[:-1][self.filled])
        return out

    def back(self, r: np.ndarray, size: int, cells: np.ndarray | None = None) -> np.ndarray:
        """sum of r_i * x_i (or of r_i times ``cells``), the intercept last."""
        out = np.empty(size)
        out[:-1] = np.bincount(self.places, weights=(self.cells if cells is None else cells) * np.repeat(r, self.counts),
                               minlength=size - 1)
        out[-1] = r.sum()
        return out


def _answer(block: _Block, losses: tuple, asked: tuple) -> list[np.ndarray]:
    """Sums over one block: [loss], gradient and diagonal, or the product.
    ``losses``: the loss's name and the weights of negative and positive rows."""
    kind, w, *direction = asked
    loss, negative, positive = losses
    size = len(w)
    value, first, second = LOSSES[loss](block.signs * block.margins(w))
    weight = block.weights * np.where(block.signs > 0, positive, negative)
    if kind == "point":
        return [np.array([(weight * value).sum()]), block.back(weight * block.signs * first, size),
                block.back(weight * second, size, block.cells * block.cells)]
    return [block.back(weight * second * block.margins(direction[0]), size)]


def _sums(questions):
    """Task body: sums of all its blocks for every question, in slices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, slices = questions.value
        total: dict[int, list[np.ndarray]] = {}
        seconds = dict.fromkeys(asked, 0.0)
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(row)
                for q, (losses, question) in asked.items():
                    t = time.perf_counter()
                    found = _answer(block, losses, question)
                    total[q] = [a + b for a, b in zip(total[q], found)] if q in total else found
                    seconds[q] += time.perf_counter() - t
        for q, found in total.items():
            flat = np.concatenate([[seconds[q]], *found])
            for s, piece in enumerate(np.array_split(flat, slices)):
                yield pa.RecordBatch.from_arrays([pa.array([q], pa.int32()), pa.array([s], pa.int32()),
                                                  pa.array([piece.tobytes()], pa.binary())], names=["question", "slice", "part"])

    return run


def _add(key, table):
    parts = [np.frombuffer(p.as_py(), np.float64) for p in table.column("part")]
    return pa.table({"question": pa.array([key[0].as_py()], pa.int32()), "slice": pa.array([key[1].as_py()], pa.int32()),
                     "part": pa.array([np.sum(parts, axis=0).tobytes()], pa.binary())})


def scan(data: DataFrame, tasks: int, asked: dict[int, tuple[Objective, tuple]]) -> dict[int, tuple[float, list[np.ndarray]]]:
    """Answer all questions in one pass: {question: (task seconds, sums)}."""
    many = tasks > DIRECT_TASKS
    # plain values only: a broadcast is unpickled where this package isn't installed
    plain = {q: ((o.loss, o.negative, o.positive), question) for q, (o, question) in asked.items()}
    shared = data.sparkSession.sparkContext.broadcast((plain, SLICES if many else 1))
    schema = "question int, slice int, part binary"
    try:
        parts = data.mapInArrow(_sums(shared), schema)
        if many:
            parts = parts.groupBy("question", "slice").applyInArrow(_add, schema)
        rows = parts.toArrow().to_pylist()
    finally:
        shared.unpersist()
    grouped: dict[int, dict[int, list]] = {}
    for r in rows:
        grouped.setdefault(r["question"], {}).setdefault(r["slice"], []).append(np.frombuffer(r["part"], np.float64))
    out = {}
    for q, (_, question) in asked.items():
        size = len(question[1])
        length = 2 + 2 * size if question[0] == "point" else 1 + size
        flat = (np.concatenate([np.sum(ps, axis=0) for _, ps in sorted(grouped[q].items())]) if q in grouped
                else np.zeros(length))
        cuts = [1, 2, 2 + size] if question[0] == "point" else [1]
        seconds, *found = np.split(flat, cuts)
        out[q] = (float(seconds[0]), found)
    return out


# --- the solver --------------------------------------------------------------------

def newton(objective: Objective, size: int, tol: float, max_steps: int,
           max_cg: int = 200) -> Generator[tuple, list[np.ndarray], tuple]:
    """Trust-region Newton with preconditioned conjugate gradients.

    Yields ("point", w) or ("product", w, v) and is sent the data's sums for
    it; returns (w, loss, |gradient| / |gradient at zero|, steps, converged).
    """
    ridge = np.full(size, objective.penalty)
    if objective.free_intercept:
        ridge[-1] = 0.0

    def at(w, found):
        (value,), gradient, diagonal = found
        return (0.5 * float(ridge @ (w * w)) + objective.scale * float(value),
                ridge * w + objective.scale * gradient, np.maximum(ridge + objective.scale * diagonal, 1e-12))

    w = np.zeros(size)
    f, g, diagonal = at(w, (yield ("point", w)))
    first = float(np.linalg.norm(g))
    if first == 0.0:
        return w, f, 0.0, 0, True
    scaled = lambda v: float(np.sqrt(np.sum(v * v * diagonal)))
    radius = float(np.sqrt(np.sum(g * g / diagonal)))
    for step in range(max_steps):
        share = float(np.linalg.norm(g)) / first
        if share <= tol:
            return w, f, share, step, True
        # minimise the quadratic model inside the region |s| <= radius, where
        # |.| is the norm of the preconditioner
        s, r = np.zeros(size), -g
        z = r / diagonal
        p, rz = z, float(r @ z)
        enough = rz * min(0.25, np.sqrt(share)) ** 2
        edge = False
        for _ in range(max_cg):
            if rz <= enough:
                break
            (product,) = yield ("product", w, p)
            hp = ridge * p + objective.scale * product
            along = rz / float(p @ hp)
            longer = s + along * p
            if scaled(longer) > radius:
                edge = True
                pp, sp, ss = (float(np.sum(a * b * diagonal)) for a, b in ((p, p), (s, p), (s, s)))
                along = (-sp + np.sqrt(sp * sp + pp * (radius * radius - ss))) / pp
                longer = s + along * p
            s, r = longer, r - along * hp
            if edge:
                break
            z = r / diagonal
            new = float(r @ z)
            p, rz = z + (new / rz) * p, new
        promised = -0.5 * float(s @ (g - r))
        there = at(w + s, (yield ("point", w + s)))
        gained = f - there[0]
        ratio = gained / promised if promised > 0 else 0.0
        if promised <= 1e-10 * abs(f):      # rounding hides the gain: judge by the gradient
            if np.linalg.norm(there[1]) >= np.linalg.norm(g):
                break
            ratio = 1.0
        length = scaled(s)
        if ratio < 0.25:
            radius = 0.25 * min(radius, length)
        elif ratio > 0.75 and edge:
            radius *= 3.0
        if ratio > 1e-4:
            w = w + s
            f, g, diagonal = there
    share = float(np.linalg.norm(g)) / first
    return w, f, share, step + 1, share <= tol


@dataclass
class _Running:
    solver: Generator
    asked: tuple
    passes: int = 0
    seconds: float = 0.0
    fit: Fit | None = field(default=None)


def solve(data: DataFrame, length: int, objectives: dict[str, Objective], tol: float | dict[str, float] = 1e-4,
          max_steps: int | dict[str, int] = 200, log: Callable[[dict], None] | None = None) -> dict[str, Fit]:
    """Fit all objectives on ``blocks`` of vectors of ``length`` features.

    One scan per round for all that are still running.  The gradient norm of
    every result is measured, not estimated: it belongs to the last point.
    ``tol`` and ``max_steps`` may differ by model.  A table without rows gives
    zero weights.
    """
    per = lambda value, name: value[name] if isinstance(value, dict) else value
    running: dict[str, _Running] = {}
    for name, objective in objectives.items():
        solver = newton(objective, length + 1, per(tol, name), per(max_steps, name))
        running[name] = _Running(solver, next(solver))
    tasks = data.rdd.getNumPartitions()
    names = list(objectives)
    while any(r.fit is None for r in running.values()):
        asked = {i: (objectives[n], running[n].asked) for i, n in enumerate(names) if running[n].fit is None}
        if log:
            log({names[i]: q[0] for i, (_, q) in asked.items()})
        for i, (seconds, found) in scan(data, tasks, asked).items():
            run = running[names[i]]
            run.passes += 1
            run.seconds += seconds
            try:
                run.asked = run.solver.send(found)
            except StopIteration as end:
                w, f, share, steps, converged = end.value
                run.fit = Fit(w[:-1], float(w[-1]), f, share, steps, run.passes, run.seconds, converged)
    return {n: running[n].fit for n in names}
