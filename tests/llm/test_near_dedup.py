"""Near duplicates against all pairs; weighted draws against the similarity."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from polarity.llm import near_dedup as nd
from polarity.llm import words as wd
from polarity.llm.components import components
from tests.llm import cases


def bags(texts, idf):
    out = []
    for b in wd.blocks(pa.array(texts)):
        text, ids, weight = nd.shingles(b, idf)
        for i in range(len(b.counts())):
            out.append(dict(zip(ids[text == i].tolist(), weight[text == i].tolist())))
    return out


def jaccard(a, b):
    shared = sum(min(w, b[s]) for s, w in a.items() if s in b)
    return shared / (sum(a.values()) + sum(b.values()) - shared) if a and b else 0.0


def brute(rows, idf):
    bag = bags([r[1] for r in rows], idf)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in combinations(range(len(rows)), 2):
        if jaccard(bag[i], bag[j]) >= nd.SIMILAR:
            root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    return {frozenset(g) for g in groups.values()}


def copies(rng, text, n):
    out = []
    for _ in range(n):
        w = text.split(" ")
        for _ in range(rng.randint(0, max(1, len(w) // 60))):
            w[rng.randrange(len(w))] = cases.sentence(rng, 1)
        out.append(" ".join(w))
    return out


def test_classes_equal_all_pairs(spark):
    rng = random.Random(14)
    rows = []
    for _ in range(40):
        base = cases.sentence(rng, rng.randint(30, 400))
        rows += copies(rng, base, rng.randint(1, 5))
    passage = cases.sentence(rng, 60)       # shared by texts that are no copies
    rows += [cases.sentence(rng, 150) + " " + passage for _ in range(30)]
    rows += copies(rng, cases.sentence(rng, 120), 60) + ["one two", "One, two!", "three"] + [rows[0].upper()] * 5
    rng.shuffle(rows)
    rows = [(i, t, "s", "en") for i, t in enumerate(rows)]
    df = cases.frame(spark, rows).repartition(5)
    idf = nd.word_weights(df)
    want = brute(rows, idf)
    out = nd.classes(df).collect()
    groups = {}
    for r in out:
        groups.setdefault(r.class_id, []).append(r)
    assert {frozenset(r.doc_id for r in g) for g in groups.values()} == want
    for class_id, g in groups.items():
        assert class_id == min(r.doc_id for r in g) and {r.class_size for r in g} == {len(g)}
        assert [r.doc_id for r in g if r.kept] == [class_id]


def test_awkward_rows(spark):
    rows = cases.awkward()
    df = cases.clashing(cases.frame(spark, rows), "kept", "rid", "keys", "class_id", "first")
    out = nd.classes(df).collect()
    assert len(out) == len(rows) and {r.rid for r in out} == {"mine"} and out[0].__fields__[:4] == ["doc_id", "text", "source", "lang"]
    size = {}
    for r in out:
        size.setdefault((r.doc_id, r.text), set()).add((r.class_id, r.class_size))
    assert size[1, rows[0][1]] == size[2, rows[0][1]] == size[10, rows[11][1]] == {(1, 4)}
    assert all(size[d, t] == {(d, 1)} for d, t, _, _ in rows if not cases.words(t))
    assert sum(r.kept for r in out) == len(rows) - 3
    assert nd.classes(cases.empty(spark)).count() == 0


def test_equal_draws_estimate_the_weighted_similarity():
    rng = random.Random(15)
    idf = np.abs(np.random.default_rng(1).normal(5, 2, nd.FEATURES)).astype(np.float32) + 0.5
    for changed in (0, 1, 3, 10):
        base = cases.sentence(rng, 300).split(" ")
        other = list(base)
        for _ in range(changed):
            other[rng.randrange(300)] = "changed"
        texts = [" ".join(base), " ".join(other)]
        block, = wd.blocks(pa.array(texts))
        codes = nd.draws(*nd.shingles(block, idf), 2, nd.FINE)
        true = jaccard(*bags(texts, idf))
        assert abs((codes[0] == codes[1]).mean() - true) < 0.07, (changed, true)


def test_idf_counts_every_text_once(spark):
    df = cases.frame(spark, [(i, "ka ka lo" if i % 2 else "ka", "s", "en") for i in range(10)]).repartition(3)
    idf = nd.word_weights(df)
    block, = wd.blocks(pa.array(["ka lo"]))
    ka, lo = (block.hashes % np.uint64(nd.FEATURES)).astype(int)
    assert idf[ka] == pytest.approx(1.0) and idf[lo] == pytest.approx(np.log(11 / 6) + 1)


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(200, 100 + i) for i in range(30)] + [(5, 5), (300, 301), (301, 300), (301, 300)]
    rng = random.Random(16)
    rng.shuffle(links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(30)}, 200: 100, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def chains(rng, lengths, words=110, edits=2):
    """Texts that are each an edited copy of the one before."""
    out = []
    for n in lengths:
        w = cases.sentence(rng, words).split(" ")
        for _ in range(n):
            out.append(" ".join(w))
            for at in rng.sample(range(len(w)), edits):
                w[at] = cases.sentence(rng, 1)
    return out


def test_chains_of_edited_copies_hold_together(spark):
    rng = random.Random(18)
    rows = [(i, t, "s", "en") for i, t in enumerate(chains(rng, [5, 6, 7, 8, 9, 10, 11, 12] * 3))]
    df = cases.frame(spark, rows).repartition(4)
    want = brute(rows, nd.word_weights(df))
    groups = {}
    for r in nd.classes(df).collect():
        groups.setdefault(r.class_id, set()).add(r.doc_id)
    assert {frozenset(g) for g in groups.values()} == want


def test_draws_of_short_texts_follow_the_weights():
    """Some heavy shingles shared, light ones in one text only, and the other way round."""
    rng = np.random.default_rng(19)
    ids = rng.integers(1, 1 << 48, 2000, dtype=np.uint64)
    for shared, heavy, own, light, passed in ((100, 6.0, 60, 2.0, True), (12, 10.0, 10, 2.4, True),
                                              (100, 2.0, 20, 30.0, False), (1, 9.3, 0, 1.0, True)):
        total, equal, banded, tries = 0.0, 0.0, 0, 60
        true = shared * heavy / (shared * heavy + own * light)
        for t in range(tries):
            s = rng.choice(ids, shared + own, replace=False)
            text = np.concatenate([np.zeros(shared, np.int64), np.ones(shared + own, np.int64)])
            weight = np.concatenate([np.full(shared, heavy), np.full(shared, heavy), np.full(own, light)])
            ids_ = np.concatenate([s[:shared], s])
            fine = nd.draws(text, ids_, weight, 2, nd.FINE)
            codes = nd.draws(text, ids_, weight, 2)
            same = (fine[0] == fine[1]).mean()
            assert abs(same - true) <= 5 * (true * (1 - true) / nd.FINE) ** 0.5
            banded += (codes[0] == codes[1]).reshape(nd.BANDS, nd.ROWS).all(axis=1).any()
        assert banded == tries or not passed, (shared, own, banded)


def test_draws_depend_on_the_own_text_only():
    rng = np.random.default_rng(20)
    ids = np.sort(rng.integers(1, 1 << 48, 3000, dtype=np.uint64))
    weight = np.round(rng.uniform(1, 40, 3000), 4)
    alone = nd.draws(np.zeros(50, np.int64), ids[:50], weight[:50], 1)
    among = nd.draws(np.concatenate([np.zeros(50, np.int64), np.ones(2950, np.int64)]), ids, weight, 3)
    assert (alone[0] == among[0]).all() and (among[1] != 0).all() and (among[2] == 0).all()


def test_texts_before_trailing_empty_ones_keep_their_last_word(spark):
    block, = wd.blocks(pa.array(["a b c", "", None, "d", "!", ""]))
    assert nd._sums(np.array([1, 2, 3, 4], np.uint64), block).tolist() == [6, 0, 0, 4, 0, 0]
    rows = [(i, t, "s", "en") for i, t in enumerate(["ka lo mi", "", "ka lo tu", None])]
    idf = np.ones(nd.FEATURES, np.float32)
    digests = set()
    for part in (rows[:2], rows[2:]):       # each ends with a text without words
        df = cases.frame(spark, part).coalesce(1)
        digests |= {(r.d1, r.d2) for r in nd.sketches(df, idf, ["doc_id"], "doc_id", "text").collect() if r.n_words}
    assert len(digests) == 2
