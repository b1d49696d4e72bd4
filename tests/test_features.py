"""Vocabulary by candidate places, and weights with and without a bound."""

import math
import random
from collections import Counter

import pytest

from polarity.operators import features as feat

WORDS = feat.TfidfConfig(ngram_range=(1, 2))


def texts(spark, n=300, seed=2, common=True):
    """Zipf-like words; one term in all rows; null, blank and long texts."""
    rng = random.Random(seed)
    rows = [(i, ("everywhere " if common else "") + " ".join(f"w{int(400 * rng.random() ** 3)}" for _ in range(rng.randint(0, 40))))
            for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, "everywhere " * 5000), (n + 3, "!! ..")]
    return spark.createDataFrame(rows, "row_id long, clean_text string").repartition(6), dict(rows)


def grams(text):
    words = [w for w in (text or "").lower().split() if len(w) >= 2 and w.isalnum()]
    return Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])


def brute_vocabulary(rows, cfg):
    df, tf = Counter(), Counter()
    for text in rows.values():
        own = grams(text)
        df.update(own.keys())
        tf.update(own)
    lo = cfg.min_df if isinstance(cfg.min_df, int) else math.ceil(cfg.min_df * len(rows))
    hi = cfg.max_df if isinstance(cfg.max_df, int) else cfg.max_df * len(rows)
    kept = sorted((t for t in df if lo <= df[t] <= hi), key=lambda t: (-tf[t], t))[:cfg.max_features]
    return {t: (df[t], tf[t]) for t in kept}


@pytest.mark.parametrize("limits", [dict(min_df=2, max_df=0.95, max_features=50), dict(min_df=1, max_features=7),
                                    dict(min_df=0.05, max_df=60), dict(min_df=2, max_df=0.9, max_features=100_000), dict(min_df=10_000)])
@pytest.mark.parametrize("pruned", [False, True])
def test_vocabulary_with_and_without_the_first_pass(spark, limits, pruned, monkeypatch):
    monkeypatch.setattr(feat, "SAMPLE", 3)
    df, rows = texts(spark)
    cfg = feat.TfidfConfig(ngram_range=(1, 2), **limits)
    vocab, n = feat.fit_vocabulary(df, cfg, pruned=pruned)
    assert n == len(rows)
    assert {r.term: (r.df, r.tf_total) for r in vocab.collect()} == brute_vocabulary(rows, cfg)


def test_crowded_places_lose_no_term_and_most_terms_are_ruled_out(spark, monkeypatch):
    monkeypatch.setattr(feat, "SAMPLE", 4)
    df, rows = texts(spark, seed=5)
    cfg = feat.TfidfConfig(ngram_range=(1, 2), min_df=2, max_features=20)
    counts, _ = feat.term_counts(df, cfg, pruned=True)
    assert counts.count() < 0.2 * len(brute_vocabulary(rows, feat.TfidfConfig(ngram_range=(1, 2))))
    monkeypatch.setattr(feat, "PLACES", 64)                    # every place is shared
    vocab, _ = feat.fit_vocabulary(df, cfg, pruned=True)
    assert {r.term: (r.df, r.tf_total) for r in vocab.collect()} == brute_vocabulary(rows, cfg)


@pytest.mark.parametrize("heavy", [1, 30, 1 << 16])
@pytest.mark.parametrize("bound", [None, 40])
def test_weights_equal_direct_computation(spark, heavy, bound):
    df, rows = texts(spark, n=80)
    cfg = feat.TfidfConfig(ngram_range=(1, 2), max_features=bound)
    vocab = brute_vocabulary(rows, cfg)
    idf = {t: math.log((1 + len(rows)) / (1 + d)) + 1 for t, (d, _) in vocab.items()}
    expected = {}
    for i, text in rows.items():
        w = {t: n * idf[t] for t, n in grams(text).items() if t in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        expected |= {(i, t): x / norm for t, x in w.items()}
    found = {(r.row_id, r.term): r.tfidf for r in feat.tfidf_long(df, cfg, heavy=heavy).collect()}
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[k], expected[k], rel_tol=1e-9) for k in expected)


def test_each_text_is_read_as_often_as_said(spark, tmp_path):
    """Scans of the input while a vocabulary is fitted, from the plans run."""
    df, _ = texts(spark)
    read = spark.sparkContext.accumulator(0)
    seen = df.rdd.map(lambda r: (read.add(1), tuple(r))[1]).toDF("row_id long, clean_text string")
    n = df.count()
    for pruned, times in ((False, 1), (True, 2)):
        before = read.value
        feat.fit_vocabulary(seen, feat.TfidfConfig(max_features=20), pruned=pruned)[0].collect()
        assert read.value - before == times * n


def test_empty_table(spark):
    nothing = spark.createDataFrame([], "row_id long, clean_text string")
    for cfg in (WORDS, feat.TfidfConfig(max_features=5)):
        assert feat.tfidf_long(nothing, cfg).count() == 0
        for pruned in (False, True):
            vocab, n = feat.fit_vocabulary(nothing, cfg, pruned=pruned)
            assert (vocab.count(), n) == (0, 0)
