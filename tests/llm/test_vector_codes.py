"""Codes, errors and codebooks against plain integer k-means."""

import hashlib
import math
import random

import numpy as np
import pytest

from polarity.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """The contract in Python integers, one vector at a time."""
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], l) for i, v, l in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // 8
    part = lambda v, p: v[p * width:(p + 1) * width]
    books = [[part(v, p) for _, v, _ in kept[:16]] for p in range(8)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    def code(v):
        best = [min(range(len(books[p])), key=lambda e: (dist(part(v, p), books[p][e]), e)) for p in range(8)]
        return best, sum(dist(part(v, p), books[p][e]) for p, e in enumerate(best))
    for _ in range(6):
        codes = [code(v)[0] for _, v, _ in kept]
        new = []
        for p in range(8):
            book = []
            for e in range(len(books[p])):
                own = [part(v, p) for (_, v, _), c in zip(kept, codes) if c[p] == e]
                book.append([sum(col) // len(own) for col in zip(*own)] if own else books[p][e])
            new.append(book)
        books = new
    out = {i: ("".join(f"{c:02x}" for c in code(v)[0]), code(v)[1], l) for i, v, l in kept}
    per_label = {}
    for _, error, l in out.values():
        per_label[l] = per_label.get(l, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return {i: (c, e, per_label[l], digest) for i, (c, e, l) in out.items()}


def ran(df, **kw):
    return {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in vc.compress(df, **kw).collect()}


@pytest.mark.parametrize("spread", [0.3, 9000.0])
def test_equals_plain_integers(spark, spread):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, spread) for _ in range(24)], rng.choice([1, 2, 3, None])) for i in rng.sample(range(1000), 150)]
    rows += [(2000 + i, rows[0][1], 1) for i in range(80)]          # a group of equal vectors
    rows += [(3000, None, 1), (3001, [float("nan")] * 24, 1), (3002, [None] * 24, 2), (3003, [float("inf")] + [0.0] * 23, 2)]
    assert ran(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_limbs_are_exact():
    rng = np.random.default_rng(0)
    for width, top, bits in [(8, 1 << 13, 4), (8, 1 << 27, None), (64, 1 << 27, None), (3, 1 << 29, 7), (0, 4, None)]:
        x, c = (rng.integers(-top, top + 1, (n, width)) for n in (40, 16))
        x[0], c[0] = -top, top
        assert np.array_equal(vc.exact_products(x, c, bits), (x.astype(object).dot(c.T.astype(object)) if width else np.zeros((40, 16))).astype(np.int64))
        assert sum(l.astype(object) * (1 << (i * (bits or vc.limb_bits(width)))) for i, l in enumerate(vc.limbs(x, bits or vc.limb_bits(width)))).tolist() == x.tolist()
    for width in (1, 2, 8, 9, 4096, 100_000):
        assert width * 4 ** vc.limb_bits(width) <= 2 ** 53


def test_first_of_equal_entries_wins():
    x = np.array([[0, 0], [5, 5]])
    c = np.array([[3, 0], [0, 3], [-3, 0], [5, 5], [5, 5]])
    assert [a.tolist() for a in vc.nearest(x, c)] == [[0, 3], [9, 0]]
    assert [a.tolist() for a in vc.nearest(x.astype(object), c)] == [[0, 3], [9, 0]]
    huge = np.array([[1 << 40, -(1 << 40)]])
    assert vc.nearest(huge, huge - 1)[1].tolist() == [2]


def test_awkward_tables(spark):
    assert vc.compress(spark.createDataFrame([], SCHEMA)).count() == 0
    assert vc.compress(spark.createDataFrame([(1, None, 1)], SCHEMA)).count() == 0
    few = [(5, [0.5] * 16, None), (2, [-0.25] * 16, 3), (None, [1.0] * 16, None), (2, [-0.25] * 16, 3)]
    df = spark.createDataFrame(few, SCHEMA).selectExpr("*", "'mine' as code", "'mine' as row", "'mine' as id", "1 as _salt")
    out = vc.compress(df).collect()
    assert len(out) == 4 and {r.row for r in out} == {"mine"} and {r.error for r in out} == {0}
    assert {(r.vec_id, r.code) for r in out} == {(5, "02" * 8), (2, "00" * 8), (None, "03" * 8)}
    odd = spark.createDataFrame([(1, [1.0] * 8, 1), (2, [1.0] * 9, 1), (3, [], 1)], SCHEMA)
    assert {r.vec_id: (r.code, r.error) for r in vc.compress(odd).collect()} == {1: ("00" * 8, 0), 2: (None, None), 3: (None, None)}
    assert [(r.code, r.error) for r in vc.compress(spark.createDataFrame([(1, [], 1)], SCHEMA)).collect()] == [("00" * 8, 0)]
    assert vc.compress(spark.createDataFrame([(1, [1.0] * 5, 1)], SCHEMA)).count() == 1
    with pytest.raises(ValueError):
        vc.compress(odd, entries=0)
