"""Toxicity by a subsequence string kernel SVM with Nystroem landmarks (operator 1).

Texts are read as units: the letters of each white-space chunk, so that signs
put between letters vanish, and runs of single letters ("i d i o t") joined.
The gap-weighted subsequence kernel compares a unit with landmarks; gaps and
inserted letters only cost a decay.  A linear SVM in the Nystroem space of the
landmarks gives each unit a margin, a document has that of its worst unit, and
a logistic curve turns margins into scores.  Training uses a bounded sample of
labelled rows; scoring is a map over all rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polarity.llm.tables import packed, unpacked, written

SAMPLE_ROWS = 2000          # labelled training rows of each class at most
SAMPLE_TASKS = 12           # that read the sample
SAMPLE_BYTES = 1 << 15      # no longer text is in the sample (scoring reads all)
LANDMARKS = 48              # of toxic strings at most
STEMS = range(4, 9)         # letters of the beginnings that are counted
COUNTER_LANDMARKS = 16      # of clean look-alikes at most
DECAY = 0.6                 # a skipped letter, on either side
INSERTED = b"aeox"          # letters put into landmarks to make training examples
ORDERS = (3, 4)             # subsequence lengths
LEAST_G2 = 20.0             # log-likelihood ratio that makes a string a landmark,
LEAST_SHARE = 0.1           # and at least so much of the best string's (words of a language in which
                            # toxic texts are common have small ratios too)
SPELLED = 1.0               # weight of all made examples, as a share of that of the texts
RIDGE = 1e-4                # of the SVM, per row
CHUNK = 64                  # letters of a unit that the kernel sees at once
BLOCK_BYTES = 1 << 20
CACHE = 1 << 18             # unit margins that a task remembers


def _letters():
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    kind = np.full(256, 2, np.uint8)                # signs and digits
    kind[97:123] = kind[128:] = 1                   # letters
    kind[[9, 10, 11, 12, 13, 32]] = 0               # white space
    bit = np.zeros(256, np.uint32)
    bit[97:123] = 1 << np.arange(26, dtype=np.uint32)
    bit[128:] = np.uint32(1) << (26 + np.arange(128) % 6).astype(np.uint32)
    return lower, kind, bit


LOWER, KIND, BIT = _letters()


@dataclass
class Units:
    """Units of some texts: unit i is letters[head[i]:head[i] + size[i]]."""
    letters: np.ndarray
    head: np.ndarray
    size: np.ndarray
    text: np.ndarray

    def get(self, i: int) -> bytes:
        return self.letters[self.head[i]:self.head[i] + self.size[i]].tobytes()

    def masks(self) -> np.ndarray:
        """The set of letters of each unit, as bits."""
        if len(self.head) == 0:
            return np.zeros(0, np.uint32)
        return np.bitwise_or.reduceat(BIT[self.letters], self.head)


def units_of(texts: list[bytes]) -> Units:
    low = LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    ends = np.cumsum([len(t) + 1 for t in texts])
    kind = KIND[low]
    kept = np.flatnonzero(kind != 2)
    letter = kind[kept] == 1
    start = letter & ~np.concatenate(([False], letter[:-1]))
    letters, place = low[kept[letter]], np.cumsum(letter) - 1
    head = place[start]
    text = np.searchsorted(ends, kept[start], side="right")
    size = np.diff(np.append(head, len(letters)))
    # join runs of single letters within a text
    linked = (size[1:] == 1) & (size[:-1] == 1) & (text[1:] == text[:-1])
    first = np.concatenate(([True], ~linked))[:len(head)]
    head, text = head[first], text[first]
    return Units(letters, head, np.diff(np.append(head, len(letters))), text)


def text_blocks(texts: list[str | None], block_bytes: int = BLOCK_BYTES):
    """(first, encoded texts) runs of about ``block_bytes``; null is empty."""
    block, first, size = [], 0, 0
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        if block and size + len(raw) > block_bytes:
            yield first, block
            block, first, size = [], i, 0
        block.append(raw)
        size += len(raw)
    if block:
        yield first, block


def kernel(units: list[bytes], marks: list[bytes], decay: float = DECAY, orders: tuple[int, ...] = ORDERS) -> np.ndarray:
    """Gap-weighted subsequence kernel, summed over ``orders``.

    Every common subsequence counts decay ** (letters skipped on both sides).
    One row per unit, one column per mark, float64.
    """
    out = np.zeros((len(units), len(marks)))
    order = np.argsort([len(u) for u in units], kind="stable")
    widths = np.array([-(-len(m) // 4) * 4 for m in marks])
    for width in np.unique(widths):       # marks of like length together
        own = np.flatnonzero(widths == width)
        t = np.full((len(own), width), -2, np.int16)
        for row, j in enumerate(own):
            t[row, :len(marks[j])] = np.frombuffer(marks[j], np.uint8)
        for at in range(0, len(order), 256):
            part = order[at:at + 256]
            out[np.ix_(part, own)] = _kernel([units[i] for i in part], t, decay, orders)
    return out


def own_norms(units: list[bytes], decay: float = DECAY, orders: tuple[int, ...] = ORDERS) -> np.ndarray:
    """Root of each unit's kernel with itself."""
    out = np.zeros(len(units))
    order = np.argsort([len(u) for u in units], kind="stable")
    for at in range(0, len(order), 256):
        part = order[at:at + 256]
        t = np.full((len(part), 1, max(1, max(len(units[i]) for i in part))), -2, np.int16)
        for row, i in enumerate(part):
            t[row, 0, :len(units[i])] = np.frombuffer(units[i], np.uint8)
        out[part] = _kernel([units[i] for i in part], t, decay, orders)[:, 0]
    return np.sqrt(np.maximum(out, 1e-9))


def _kernel(units: list[bytes], t: np.ndarray, decay: float, orders: tuple[int, ...]) -> np.ndarray:
    """The kernel of a few units and marks ``t`` of one width, all at once;
    ``t`` holds the same marks for all units, or (units, 1, width) one for each."""
    marks, width = t.shape[-2:]
    gaps = np.triu(decay ** np.abs(np.subtract.outer(np.arange(width), np.arange(width)))).astype(np.float32)
    longest = max(1, max(map(len, units)))
    u = np.full((len(units), longest), -1, np.int16)
    for row, unit in enumerate(units):
        u[row, :len(unit)] = np.frombuffer(unit, np.uint8)
    # ways[i][..., j]: subsequences of length i open at the end of both, within
    # the first j letters of the mark
    ways = [np.ones((len(units), marks, width + 1), np.float32)]
    ways += [np.zeros_like(ways[0]) for _ in range(max(orders) - 1)]
    total = np.zeros((len(units), marks))
    for a in range(longest):
        same = (u[:, a][:, None, None] == t).astype(np.float32)
        for p in orders:
            total += (same * ways[p - 1][..., :-1]).sum(axis=2)
        for i in range(len(ways) - 1, 0, -1):
            ways[i][..., 1:] *= decay
            ways[i][..., 1:] += (same * ways[i - 1][..., :-1]) @ gaps
    return total


def _in_order(units: Units, which: np.ndarray, mark: bytes, spare: int) -> np.ndarray:
    """Whether ``mark`` is a subsequence of each unit, ``spare`` letters aside."""
    letters = np.append(np.frombuffer(mark, np.uint8), 0)
    order = np.argsort(-units.size[which], kind="stable")
    head, size = units.head[which][order], units.size[which][order]
    # reach[s]: letters of the mark met so far when s of them may be left out
    reach = [np.full(len(which), min(s, len(mark)), np.int64) for s in range(spare + 1)]
    for a in range(int(size.max(initial=0))):
        n = int(np.searchsorted(-size, -a))         # units longer than a
        letter = units.letters[head[:n] + a]
        for s in range(spare, -1, -1):
            r = reach[s][:n]
            r += (letters[r] == letter) & (r < len(mark))
        for s in range(1, spare + 1):
            np.maximum(reach[s][:n], np.minimum(reach[s - 1][:n] + 1, len(mark)), out=reach[s][:n])
    whole = np.zeros(len(which), dtype=bool)
    whole[order] = reach[spare] >= len(mark)
    return whole


@dataclass
class Model:
    """Landmarks, weights and the logistic curve; small enough for a closure."""
    toxic: list[bytes]
    clean: list[bytes]
    weights: np.ndarray     # of the landmark kernel values, plain and normalised
    bias: float
    slope: float
    offset: float
    constant: float | None = None

    def gate(self, units: Units) -> np.ndarray:
        """Units that hold the letters of a toxic landmark in their order, with
        anything in between; of every four letters one may lack (masked and
        replaced letters arrive as gaps).  Others have the margin of an empty
        unit: they share too few subsequences for the kernel to see."""
        masks, passed = units.masks(), np.zeros(len(units.head), dtype=bool)
        for mark in self.toxic:
            need = np.bitwise_or.reduce(BIT[np.frombuffer(mark, np.uint8)])
            spare = len(mark) // 4
            maybe = np.flatnonzero((np.bitwise_count(need & ~masks) <= spare) & ~passed)
            passed[maybe[_in_order(units, maybe, mark, spare)]] = True
        return np.flatnonzero(passed)

    def features(self, units: list[bytes]) -> np.ndarray:
        """Kernel with each landmark, scaled by the landmark's own norm, and
        the same scaled by the unit's as well (short units that lack a letter
        stand out there); long units are read in overlapping chunks and keep
        the greatest values."""
        marks = self.toxic + self.clean
        chunks, owner = [], []
        for i, unit in enumerate(units):
            for at in range(0, max(1, len(unit) - CHUNK // 2), CHUNK // 2):
                chunks.append(unit[at:at + CHUNK])
                owner.append(i)
        values = kernel(chunks, marks) / self.norms()
        values = np.concatenate([values, values / own_norms(chunks)[:, None]], axis=1)
        out = np.zeros((len(units), 2 * len(marks)))
        np.maximum.at(out, np.array(owner, dtype=np.int64), values)
        return out

    def norms(self) -> np.ndarray:
        own = [kernel([m], [m])[0, 0] for m in self.toxic + self.clean]
        return np.sqrt(np.maximum(own, 1e-9))

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.offset, -500, 500)))


class Scorer:
    """Scores of texts in a task, with a bounded memory of unit margins."""

    def __init__(self, model: Model):
        self.model, self.margin = model, {}
        self.norms = None if model.constant is not None else model.norms()
        if self.norms is not None:
            model.norms = lambda: self.norms

    def margins(self, texts: list[bytes]) -> np.ndarray:
        best = np.full(len(texts), self.model.bias)
        units = units_of(texts)
        passed = self.model.gate(units)
        names = [units.get(i) for i in passed]
        fresh = [n for n in dict.fromkeys(names) if n not in self.margin]
        if len(self.margin) + len(fresh) > CACHE:
            self.margin.clear()
            fresh = list(dict.fromkeys(names))
        for at in range(0, len(fresh), 4096):
            part = fresh[at:at + 4096]
            values = self.model.features(part) @ self.model.weights + self.model.bias
            self.margin.update(zip(part, values.tolist()))
        if names:
            np.maximum.at(best, units.text[passed], np.array([self.margin[n] for n in names]))
        return best

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.model.constant is not None:
            return np.full(len(texts), self.model.constant)
        out = np.zeros(len(texts))
        for first, block in text_blocks(texts):
            out[first:first + len(block)] = self.model.probability(self.margins(block))
        return out


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from (null ids are held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, label) of at most ``rows`` rows of each class, by hash of the id.

    Only rows that aren't held out; an id labelled both ways counts as 1.
    Texts above SAMPLE_BYTES are not sampled, so the sample is bounded."""
    marked = (labels.filter(F.col(label_col).isin(0, 1)).groupBy(F.col("doc_id").alias("of"))
              .agg(F.max(label_col).cast("int").alias("label")).filter(~held_out(F.col("of"))))
    short = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text")).filter(
        F.octet_length("text") <= SAMPLE_BYTES)
    ids = short.select("id").join(marked, F.col("id") == F.col("of")).select("id", "label").distinct()
    key = F.xxhash64("id")
    chosen = ids.filter("label = 0").orderBy(key, "id").limit(rows).unionByName(
        ids.filter("label = 1").orderBy(key, "id").limit(rows))
    picked = chosen.select(F.col("id").alias("chosen"), "label")
    # at most 2 * rows ids
    found = short.join(F.broadcast(picked), F.col("id") == F.col("chosen")).select("text", "label")
    return written(found.repartition(SAMPLE_TASKS))


def _stems(units: Units, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first n letters packed in a number, unit) of units of n letters up."""
    which = np.flatnonzero(units.size >= n)
    letters = units.letters[units.head[which][:, None] + np.arange(n)].astype(np.uint64)
    return (letters << (np.uint64(8) * np.arange(n, dtype=np.uint64))).sum(axis=1, dtype=np.uint64), which


def _stem_counts(batches):
    """Texts of each class that hold a stem: (stem, n, toxic, clean)."""
    for batch in batches:
        label = np.array(batch.column("label").to_pylist(), dtype=np.int64)
        for first, texts in text_blocks(batch.column("text").to_pylist()):
            units = units_of(texts)
            for n in STEMS:
                stem, which = _stems(units, n)
                text = units.text[which]
                order = np.lexsort((text, stem))
                stem, text = stem[order], text[order]
                new = np.ones(len(stem), dtype=bool)
                new[1:] = (stem[1:] != stem[:-1]) | (text[1:] != text[:-1])
                keys, place = np.unique(stem[new], return_inverse=True)
                y = label[first + text[new]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), n, np.int32)),
                     pa.array(np.bincount(place, weights=y, minlength=len(keys)).astype(np.int64)),
                     pa.array(np.bincount(place, weights=1 - y, minlength=len(keys)).astype(np.int64))],
                    names=["stem", "n", "toxic", "clean"])


def landmarks_of(sample: DataFrame, totals: dict[int, int]) -> list[bytes]:
    """Strings that tell toxic training texts from clean ones, best first.

    Beginnings of units (4 to 8 letters) are counted once per text; those with
    a high log-likelihood ratio stay, the longest of equals, none part of
    another.  A stem that mostly comes as one word becomes that word."""
    n0, n1 = float(totals[0]), float(totals[1])
    counts = (sample.mapInArrow(_stem_counts, "stem bigint, n int, toxic bigint, clean bigint")
              .groupBy("stem", "n").agg(F.sum("toxic").alias("p"), F.sum("clean").alias("q")))
    share = (F.col("p") + F.col("q")) / (n0 + n1)
    g2 = 2 * (F.col("p") * F.log(F.col("p") / n1 / share)
              + F.when(F.col("q") > 0, F.col("q") * F.log(F.col("q") / n0 / share)).otherwise(0.0))
    telling = (counts.filter(F.col("p") / n1 > 10 * F.col("q") / n0).withColumn("g2", g2).filter(F.col("g2") >= LEAST_G2)
               .orderBy(F.desc("p"), F.desc("n"), "stem").limit(64 * LANDMARKS).collect())
    telling = [r for r in telling if r.g2 >= LEAST_SHARE * max(t.g2 for t in telling)]
    chosen: list[bytes] = []
    for r in telling:
        stem = int(r.stem).to_bytes(8, "little", signed=True)[:r.n]
        if len(chosen) < LANDMARKS and not any(stem in c or c in stem for c in chosen):
            chosen.append(stem)
    return _whole_words(sample, chosen)


def _whole_words(sample: DataFrame, stems: list[bytes]) -> list[bytes]:
    def words(batches):
        for batch in batches:
            seen: Counter = Counter()
            toxic = [t for t, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()) if y]
            for _, texts in text_blocks(toxic):
                units = units_of(texts)
                for n in {len(s) for s in stems}:
                    keys, which = _stems(units, n)
                    wanted = np.array([int.from_bytes(s, "little") for s in stems if len(s) == n], np.uint64)
                    seen.update(units.get(i)[:CHUNK] for i in which[np.isin(keys, wanted)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    rows = (sample.mapInArrow(words, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "word").limit(100 * LANDMARKS).collect())
    whole = []
    for stem in stems:
        own = [(r.n, bytes(r.word)) for r in rows if bytes(r.word).startswith(stem)]
        total = sum(n for n, _ in own)
        whole.append(own[0][1] if own and own[0][0] * 2 > total else stem)
    return whole


def _suspects(sample: DataFrame, model: Model, clean: int) -> list:
    """(label, unit, features) of the most suspicious unit of toxic texts and
    of the ``clean`` most suspicious ones of clean texts."""
    def run(batches):
        fixed = Scorer(model).model
        for batch in batches:
            found = []
            labels = batch.column("label").to_pylist()
            for first, texts in text_blocks(batch.column("text").to_pylist()):
                units = units_of(texts)
                passed = fixed.gate(units)
                names = [units.get(i) for i in passed]
                own = list(dict.fromkeys(names))
                values = fixed.features(own)
                place = {n: i for i, n in enumerate(own)}
                by_text: dict[int, set] = {}
                for t, n in zip(units.text[passed].tolist(), names):
                    by_text.setdefault(t, set()).add(n)
                for t, units_ in by_text.items():
                    order = sorted(units_, key=lambda n: (-values[place[n]].max(), n))
                    found += [(labels[first + t], n[:CHUNK], values[place[n]].tolist())
                              for n in order[:1 if labels[first + t] else clean]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.binary()),
                 pa.array([f[2] for f in found], pa.list_(pa.float64()))], names=["label", "unit", "features"])

    rows = sample.mapInArrow(run, "label int, unit binary, features array<double>").collect()
    return sorted((r.label, bytes(r.unit), r.features) for r in rows)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic") -> Model:
    """Learn from a bounded labelled sample, whose texts stay in the tasks.

    With one class only, or no telling string, the model is the constant
    share of label 1 (0.0 without any labels)."""
    sample = training_sample(docs, labels, label_col)
    totals = {0: 0, 1: 0} | {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = sum(totals.values())
    toxic = landmarks_of(sample, totals) if all(totals.values()) else []
    if not toxic:
        return Model([], [], np.zeros(0), 0.0, 1.0, 0.0, constant=totals[1] / rows if rows else 0.0)
    model = Model(toxic, [], np.zeros(2 * len(toxic)), 0.0, 1.0, 0.0)
    alike = {}
    for label, unit, values in _suspects(sample, model, 3):
        if label == 0:
            alike[unit] = max(values)
    model.clean = [u for u, _ in sorted(alike.items(), key=lambda x: (-x[1], x[0])) if u not in toxic and len(u) <= 12][:COUNTER_LANDMARKS]
    model.weights = np.zeros(2 * len(model.toxic + model.clean))
    suspects = _suspects(sample, model, 3)
    spelled = _spelled_around(model, suspects)
    _fit_margin(model, suspects, spelled)
    flat = Model(model.toxic, model.clean, model.weights, model.bias, 1.0, 0.0)

    def margins(batches):
        scorer = Scorer(flat)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            values = np.concatenate([scorer.margins(block) for _, block in text_blocks(texts)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([pa.array(values), batch.column("label")], names=["margin", "label"])

    known = sample.mapInArrow(margins, "margin double, label int").collect()
    # the made examples are toxic texts of one unit
    made = np.maximum(np.array([f for _, _, f in spelled]).reshape(len(spelled), len(model.weights)) @ model.weights + model.bias, model.bias)
    model.slope, model.offset = _curve(np.append([r.margin for r in known], made),
                                       np.append([r.label for r in known], np.ones(len(spelled))))
    return model


def _spelled_around(model: Model, suspects: list) -> list:
    """Toxic training examples with a letter put into each landmark or taken
    from it, where they are closer to it than any suspect unit of a clean text is."""
    n = len(model.toxic + model.clean)
    clean = np.array([f for label, _, f in suspects if label == 0]).reshape(-1, 2 * n)
    reach = clean.max(axis=0, initial=0.0)
    units = [(j, m[:i] + bytes([c]) + m[i:]) for j, m in enumerate(model.toxic) for i in range(1, len(m)) for c in INSERTED]
    units += [(j, m[:i] + m[i + 1:]) for j, m in enumerate(model.toxic) for i in range(len(m))]
    features = model.features([u for _, u in units])
    return [(1, u, f.tolist()) for (j, u), f in zip(units, features) if f[n + j] > reach[n + j]]


def _fit_margin(model: Model, suspects: list, spelled: list) -> None:
    """Linear SVM (squared hinge, Newton steps) on Nystroem features K_mm^(-1/2) k(unit).

    The made examples weigh SPELLED times as much as the texts together: each
    is one of the many ways to write around a landmark."""
    texts, suspects = len(suspects), suspects + spelled
    marks, norms = model.toxic + model.clean, model.norms()
    between = kernel(marks, marks) / np.outer(norms, norms)
    value, vector = np.linalg.eigh((between + between.T) / 2)
    root = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
    both = np.kron(np.eye(2), root)
    space = np.array([f for _, _, f in suspects]).reshape(len(suspects), 2 * len(marks)) @ both
    # a quarter as many texts without any suspicious unit
    space = np.concatenate([space, np.zeros((max(1, len(suspects) // 4), 2 * len(marks)))])
    x = np.column_stack([space, np.ones(len(space))])
    y = np.full(len(x), -1.0)
    y[[i for i, (label, _, _) in enumerate(suspects) if label]] = 1.0
    weight = np.ones(len(x))
    weight[texts:len(suspects)] = max(1.0, SPELLED * texts / max(1, len(spelled)))
    penalty = np.diag(np.append(np.full(2 * len(marks), RIDGE), 1e-9)) * len(x)
    w, active = np.zeros(x.shape[1]), np.ones(len(x), dtype=bool)
    for _ in range(50):
        inside = x[active]
        scaled = inside * weight[active][:, None]
        w = np.linalg.solve(inside.T @ scaled + penalty, scaled.T @ y[active])
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    model.weights, model.bias = both @ w[:-1], float(w[-1])


def _curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve (Newton steps, Platt's targets)."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        grad = x.T @ (p - target) + 1e-6 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def score(df: DataFrame, model: Model, carry: list[str] | None = None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``carry`` columns (default: all) plus held_out, score, predicted.

    A map over all rows and whole texts.  Null and empty texts have no units
    and so the score of a text without suspicious ones.  Equal texts score
    alike; carried columns named like an added one are replaced."""
    carry = list(carry or df.columns)
    rows = packed(df, carry, out=held_out(df[id_col]), text=df[text_col].cast("string"))

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            values = scorer.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("out"), pa.array(values)],
                                             names=["row", "out", "score"])

    scored = rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, out boolean, score double")
    return unpacked(scored, carry, held_out=F.col("out"), score=F.col("score"),
                    predicted=(F.col("score") >= 0.5).cast("int"))
