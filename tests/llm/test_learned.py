"""Toxicity and quality: kernel by enumeration, held-out accuracy, awkward rows."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from polarity.llm import quality_cotraining as qc
from polarity.llm import toxicity as tx
from polarity.llm.tables import load
from tests.llm import cases

SF = "/root/testdata/sf0.01"
INSULTS = ("idiot", "moron", "scum", "clown")
LABELS = "doc_id long, quality int, toxic int"


def brute_kernel(a, b, decay, p):
    total = 0.0
    for i in combinations(range(len(a)), p):
        for j in combinations(range(len(b)), p):
            if all(a[x] == b[y] for x, y in zip(i, j)):
                total += decay ** (i[-1] - i[0] + 1 - p + j[-1] - j[0] + 1 - p)
    return total


def test_kernel_counts_gapped_subsequences():
    rng = random.Random(11)
    units = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 9))) for _ in range(30)]
    marks = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(3, 6))) for _ in range(5)]
    got = tx.kernel(units, marks, 0.5, (3, 4))
    for i, u in enumerate(units):
        for j, m in enumerate(marks):
            assert got[i, j] == pytest.approx(sum(brute_kernel(u, m, 0.5, p) for p in (3, 4)), rel=1e-5)


def test_units_drop_signs_and_join_single_letters():
    units = tx.units_of([b"You I.D.I.O.T a b c!", "é12x y".encode(), b"", b"z"])
    assert [(int(t), units.get(i)) for i, t in enumerate(units.text)] == [
        (0, b"you"), (0, b"idiot"), (0, b"abc"), (1, "éx".encode()), (1, b"y"), (3, b"z")]


def test_gate_wants_the_letters_in_order():
    model = tx.Model([b"idiot", b"worthless"], [], np.zeros(2), 0.0, 1.0, 0.0)
    words = ["idiot", "ixdxiot", "toidi", "idio", "worthless", "worhless", "wrthlss", "xworthlesss", "sselhtrow", "", "i"]
    units = tx.units_of([w.encode() for w in words])
    assert [units.get(i).decode() for i in model.gate(units)] == [
        "idiot", "ixdxiot", "idio", "worthless", "worhless", "wrthlss", "xworthlesss"]
    rng = random.Random(17)
    for _ in range(300):
        mark = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 6)))
        unit = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 12)))
        for spare in (0, 1):
            it = {mark[:i] + mark[i + 1:] for i in range(len(mark))} if spare else {mark}
            want = any(all(c in rest for c in m) for m in it for rest in [iter(unit)])
            u = tx.units_of([b"zz " + unit]) if len(unit) > 1 else tx.units_of([unit])
            got = tx._in_order(u, np.array([len(u.head) - 1]), mark, spare)[0]
            assert got == want, (mark, unit, spare)


@pytest.fixture(scope="module")
def insulted(spark):
    """Invented texts; label 1 where an insult was put in."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(600):
        w = cases.sentence(rng, rng.randint(5, 120)).split(" ")
        toxic = i % 4 == 0
        if toxic:
            w[rng.randrange(len(w)):0] = [rng.choice(INSULTS)]
        rows.append((i, " ".join(w), "s", "en"))
        labels.append((i, 1, int(toxic)))
    docs = cases.frame(spark, rows)
    return docs, spark.createDataFrame(labels, LABELS)


def test_gapped_and_inserted_insults_are_found(spark, insulted):
    docs, labels = insulted
    model = tx.fit(docs, labels)
    assert {m.decode() for m in model.toxic} == set(INSULTS)
    scored = {r.doc_id: r for r in tx.score(docs, model).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert all(scored[i].predicted == truth[i] for i in truth)
    odd = ["lo ka i d i o t mi", "ka m-o-r-o-n", "s.c.u.m lo", "cloxwn ren", "IDIOT!", "idi#ot", "ka idiiot"]
    odd += ["1d10t no: id1ot", "m*ron ka", "cl0wn", "sc*m", "ka mor0n lo", "c1own"]
    fine = ["lo ka mi", "", "tu ren sop", None, "!!!", "a b c"]
    out = tx.score(cases.frame(spark, [(i, t, "s", "en") for i, t in enumerate(odd + fine)]), model).orderBy("doc_id").collect()
    assert [r.predicted for r in out] == [1] * len(odd) + [0] * len(fine)
    assert all(0 <= r.score <= 1 for r in out)


def test_toxicity_of_awkward_rows(spark, insulted):
    docs, labels = insulted
    model = tx.fit(docs, labels)
    df = cases.clashing(cases.frame(spark, cases.awkward() + [(99, "ka " * 20000 + "moron", "a", "en")]), "score", "text_", "out")
    out = tx.score(df, model).collect()
    assert len(out) == len(cases.awkward()) + 1 and {r.out for r in out} == {"mine"}
    assert [r.doc_id for r in out if r.predicted] == [99]
    assert tx.score(cases.empty(spark), model).count() == 0
    for few in (labels.filter("toxic = 0"), labels.limit(0)):
        flat = tx.fit(docs, few)
        assert flat.constant == 0.0 and {r.score for r in tx.score(docs, flat).collect()} == {0.0}
    nulls = spark.createDataFrame([(None, None, None), (1, None, None)], LABELS)
    assert tx.fit(cases.empty(spark), nulls).constant == 0.0


def test_no_held_out_label_is_learned(spark, insulted):
    docs, labels = insulted
    from pyspark.sql import functions as F
    turned = labels.withColumn("toxic", F.when(tx.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = tx.fit(docs, labels), tx.fit(docs, turned)
    assert a.toxic == b.toxic and np.allclose(a.weights, b.weights) and a.slope == b.slope


def test_quality_on_held_out_rows(spark):
    docs, labels = load(spark, SF, "documents"), load(spark, SF, "labels")
    out = qc.score(docs, qc.fit(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.quality for r in out)
    assert right / len(out) > 0.9 and len(out) > 50
    clean = [r for r in out if r.quality == 1]
    assert sum(r.kept for r in clean) / len(clean) > 0.97


def test_cotraining_spreads_labels_between_views():
    rng = np.random.default_rng(13)
    y = rng.integers(0, 2, 400).astype(float)
    content = rng.normal(size=(400, 6)) + 3 * y[:, None]
    meta = rng.normal(size=(400, 3)) + 3 * y[:, None]
    few = np.arange(400) < 24
    aside = np.zeros(24, dtype=bool)
    aside[::4] = True
    model = qc.cotrain(content[few], meta[few], y[few], aside, content[~few], meta[~few])
    assert ((model.score(content[~few], meta[~few]) >= 0.5) == (y[~few] == 1)).mean() > 0.97


def test_quality_of_awkward_rows(spark):
    docs, labels = load(spark, SF, "documents"), load(spark, SF, "labels")
    model = qc.fit(docs, labels)
    df = cases.clashing(cases.frame(spark, cases.awkward()), "kept", "row", "score")
    out = qc.score(df, model).collect()
    assert len(out) == len(cases.awkward()) and {r.row for r in out} == {"mine"}
    assert all(0 <= r.score <= 1 and r.kept == (r.predicted == 1) for r in out)
    assert qc.score(cases.empty(spark), model).count() == 0
    one = qc.fit(docs, labels.filter("quality = 1"))
    assert one.constant == 1.0
    assert qc.fit(cases.empty(spark), labels).constant == 0.0
    content, meta = qc.views(pa.array([None, "a b"]), [None, "en"], [None, "s"])
    assert np.isfinite(content).all() and np.isfinite(meta).all()
