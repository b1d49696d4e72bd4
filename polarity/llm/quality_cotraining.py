"""Quality classifier by co-training (operator 6).

Two views of a document: its text content (hashed character trigrams and
repetition) and its page metadata (length, layout, language, source).  A
logistic model per view learns from labelled rows; over some rounds each gives
its most confident pseudo-labels on an unlabelled pool to the other.  Each
view is calibrated on rows kept aside, and the calibrated views are combined.
Training uses bounded samples; scoring is a map over all whole texts.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polarity.llm import words as wd
from polarity.llm.tables import packed, unpacked
from polarity.llm.toxicity import held_out

LABELLED_ROWS = 2000        # of each class at most
POOL_ROWS = 4000            # unlabelled rows at most
SAMPLE_BYTES = 1 << 15      # no longer text is in a sample (scoring reads all)
ROUNDS = 4
GIVEN = 100                 # pseudo-labels a view gives in a round
CONFIDENT = 0.95
TRIGRAMS = 256
HASHED = 32                 # places for sources, and for languages


def views(texts: pa.Array, langs: list, sources: list) -> tuple[np.ndarray, np.ndarray]:
    """(content, metadata) rows of a batch; null texts count as empty."""
    content, meta = [], []
    for b in wd.blocks(texts):
        n = len(b.counts())
        raw, cut = b.raw.astype(np.int64), b.cuts
        size = np.maximum(np.diff(cut), 1)
        owner = np.repeat(np.arange(n), np.diff(cut))
        grams = np.zeros((n, TRIGRAMS))
        if len(raw) > 2:
            code = (raw[:-2] * 7919 + raw[1:-1] * 104729 + raw[2:] * 1299709) % 65521 % TRIGRAMS
            same = owner[:-2] == owner[2:]
            grams = np.bincount(owner[:-2][same] * TRIGRAMS + code[same], minlength=n * TRIGRAMS).reshape(n, TRIGRAMS)
        grams = np.sqrt(grams / size[:, None])
        words = np.maximum(b.counts(), 1)
        held = np.repeat(np.arange(n), b.counts()).astype(np.uint64)
        keys, times = np.unique((held << np.uint64(48)) | (b.hashes >> np.uint64(16)), return_counts=True)
        at = (keys >> np.uint64(48)).astype(np.int64)
        distinct = np.bincount(at, minlength=n)
        most = np.zeros(n)
        np.maximum.at(most, at, times)
        length = np.bincount(held.astype(np.int64), weights=(b.stop - b.start), minlength=n) / words
        content.append(np.column_stack([grams * 4, distinct / words, most / words, np.log1p(distinct), length / 8]))

        def share(mask):
            return np.bincount(owner[mask], minlength=n) / size

        lines = np.bincount(owner[raw == 10], minlength=n) + 1
        upper = (raw >= 65) & (raw <= 90)
        signs = ((raw > 32) & (raw < 48)) | ((raw > 57) & (raw < 65)) | ((raw > 90) & (raw < 97)) | ((raw > 122) & (raw < 127))
        meta.append(np.column_stack([np.log1p(np.diff(cut)), np.log1p(np.diff(cut)) ** 2 / 10, np.log(lines),
                                     np.log(size / lines), share(upper) * 5, share(signs) * 10,
                                     share((raw >= 48) & (raw <= 57)) * 10, share(raw == 32) * 5, share(raw >= 128) * 5]))
    tags = np.zeros((len(langs), 2 * HASHED))
    for i, (lang, source) in enumerate(zip(langs, sources)):
        tags[i, zlib.crc32(str(lang).encode()) % HASHED] = 0.3
        tags[i, HASHED + zlib.crc32(str(source).encode()) % HASHED] = 0.3
    if not content:
        return np.zeros((0, TRIGRAMS + 4)), np.zeros((0, 9 + 2 * HASHED))
    return np.concatenate(content), np.column_stack([np.concatenate(meta), tags])


@dataclass
class View:
    """Logistic model on standardised features, with its calibration."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return z @ self.weights[:-1] + self.weights[-1]

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * self.margin(x) + self.offset, -30, 30)


def _sigmoid(m: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(m, -500, 500)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Weights and intercept (last) by damped Newton steps."""
    z = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = _sigmoid(z @ w)
        grad = z.T @ (weight * (p - y)) + penalty * w
        hess = (z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 4 / max(1e-12, np.abs(z @ step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _fit_view(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> View:
    mean, scale = x.mean(axis=0), x.std(axis=0)
    view = View(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(x.shape[1] + 1))
    view.weights = _logistic(np.clip((x - view.mean) / view.scale, -8, 8), y, weight, ridge=3.0)
    return view


@dataclass
class Model:
    content: View | None
    meta: View | None
    mix: np.ndarray             # of the calibrated margins, and intercept
    constant: float = 0.0

    def score(self, content: np.ndarray, meta: np.ndarray) -> np.ndarray:
        if self.content is None:
            return np.full(len(content), self.constant)
        both = np.column_stack([self.content.calibrated(content), self.meta.calibrated(meta)])
        return _sigmoid(both @ self.mix[:2] + self.mix[2])


def cotrain(content: np.ndarray, meta: np.ndarray, y: np.ndarray, aside: np.ndarray,
            pool_content: np.ndarray, pool_meta: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Train both views; ``aside`` marks the rows that calibrate them.

    Each round a view hands its most confident pool rows, in the classes'
    shares, to the other view with weight one half."""
    if len(set(y.tolist())) < 2:
        return Model(None, None, np.zeros(3), float(y.mean()) if len(y) else 0.0)
    if len(set(y[aside].tolist())) < 2 or len(set(y[~aside].tolist())) < 2:
        aside = np.zeros(len(y), dtype=bool)
    fit, keep = ~aside, aside if aside.any() else np.ones(len(y), dtype=bool)
    own, pool = (content, meta), (pool_content, pool_meta)
    given: list[dict[int, int]] = [{}, {}]      # pseudo-labels that each view learns from
    share = y.mean()
    for turn in range(rounds + 1):
        trained = []
        for k in (0, 1):
            rows = sorted(given[k])
            extra = np.array([given[k][r] for r in rows], dtype=float)
            x = np.concatenate([own[k][fit], pool[k][rows]]) if rows else own[k][fit]
            trained.append(_fit_view(x, np.concatenate([y[fit], extra]),
                                     np.concatenate([np.ones(fit.sum()), np.full(len(rows), 0.5)])))
        if turn == rounds or len(pool_content) == 0:
            break
        for k in (0, 1):
            p = _sigmoid(trained[k].margin(pool[k]))
            for label, sure in ((1, p), (0, 1 - p)):
                quota = max(1, int(GIVEN * (share if label else 1 - share)))
                order = [i for i in np.argsort(-sure, kind="stable") if i not in given[1 - k]]
                for i in order[:quota]:
                    if sure[i] >= CONFIDENT:
                        given[1 - k][int(i)] = label
    margins = []
    for k in (0, 1):
        m = trained[k].margin(own[k][keep])
        w = _logistic(m[:, None], y[keep], np.ones(keep.sum()), ridge=1e-3)
        trained[k].slope, trained[k].offset = max(float(w[0]), 1e-3), float(w[1])
        margins.append(trained[k].calibrated(own[k][keep]))
    mix = _logistic(np.column_stack(margins), y[keep], np.ones(keep.sum()), ridge=1.0)
    return Model(trained[0], trained[1], np.append(np.maximum(mix[:2], 0), mix[2]))


def _sample(docs: DataFrame, ids: DataFrame) -> pa.Table:
    """Rows of the chosen ids (a bounded table)."""
    return docs.join(F.broadcast(ids), F.col("id") == F.col("chosen")).select(
        "id", "text", "lang", "source", "label").orderBy("id", "text").toArrow()


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> Model:
    """Learn from bounded samples by hash of the id; held-out labels unused.

    One class only: the constant share of label 1 (0.0 without labels)."""
    short = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"),
                        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")
                        ).filter(F.octet_length("text") <= SAMPLE_BYTES)
    marked = (labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col("doc_id").alias("of"))
              .agg(F.min(label_col).cast("int").alias("label")))
    known = short.select("id").distinct().join(marked, F.col("id") == F.col("of"), "left").select("id", "label")
    key = F.xxhash64("id")
    chosen = []
    for which, rows in ((F.col("label") == 0, LABELLED_ROWS), (F.col("label") == 1, LABELLED_ROWS),
                        (F.col("label").isNull(), POOL_ROWS)):
        wanted = which if rows == POOL_ROWS else which & ~held_out(F.col("id"))
        chosen.append(known.filter(wanted).orderBy(key, "id").limit(rows))
    picked = chosen[0].unionByName(chosen[1]).unionByName(chosen[2]).withColumnRenamed("id", "chosen")
    table = _sample(short, picked)
    content, meta = views(table.column("text"), table.column("lang").to_pylist(), table.column("source").to_pylist())
    label = np.array([-1 if v is None else v for v in table.column("label").to_pylist()], dtype=int)
    aside = np.array([zlib.crc32(str(i).encode()) % 5 == 1 for i in table.column("id").to_pylist()], dtype=bool)
    has = label >= 0
    return cotrain(content[has], meta[has], label[has].astype(float), aside[has], content[~has], meta[~has])


def score(df: DataFrame, model: Model, carry: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``carry`` columns (default: all) plus held_out, score, predicted, kept.

    A map over all rows and whole texts; null or empty texts get the score of
    their metadata and an empty content.  kept is predicted = 1 as boolean.
    Carried columns named like an added one are replaced."""
    carry = list(carry or df.columns)
    rows = packed(df, carry, out=held_out(df[id_col]), text=df[text_col].cast("string"),
                  lang=df[lang_col].cast("string"), source=df[source_col].cast("string"))

    def run(batches):
        for batch in batches:
            content, meta = views(batch.column("text"), batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("out"), pa.array(model.score(content, meta), pa.float64())],
                names=["row", "out", "score"])

    scored = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, out boolean, score double")
    good = F.col("score") >= 0.5
    return unpacked(scored, carry, held_out=F.col("out"), score=F.col("score"), predicted=good.cast("int"), kept=good)
