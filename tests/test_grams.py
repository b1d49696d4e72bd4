"""Term counts and weights made inside tasks equal a direct computation."""

import math
import random
from collections import Counter

import pytest

from polarity.functions import grams
from polarity.operators import features as feat


def char_grams(text, lo, hi):
    out = Counter()
    for word in (text or "").lower().split():
        padded = f" {word} "
        for n in range(lo, hi + 1):
            out.update([padded[i:i + n] for i in range(len(padded) - n + 1)] or ([padded] if n == lo else []))
    return out


def texts(spark):
    rng = random.Random(3)
    letters = "abcde é\U0001f600漢字한\x00ﬀ \x85"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    rows += [(150, None), (151, ""), (152, " \t "), (153, "a"), (154, "word " * 3000), (155, "İstanbul ΣΑΣ")]
    return spark.createDataFrame(rows, "row_id long, clean_text string").repartition(5), dict(rows)


# KEYS and KEPT small: a task gives its sums back often; few bits: characters don't fit
@pytest.mark.parametrize("lo, hi", [(3, 5), (3, 3), (3, 20), (2, 4), (4, 5), (1, 1)])
def test_char_counts_and_weights(spark, lo, hi):
    df, rows = texts(spark)
    lowered = {r.row_id: r.t for r in df.selectExpr("row_id", "lower(clean_text) t").collect()}
    own = {i: char_grams(t, lo, hi) for i, t in lowered.items()}
    cfg = feat.TfidfConfig(analyzer="char_wb", ngram_range=(lo, hi), min_df=2, max_features=500)
    counts, n = feat.term_counts(df, cfg)
    dfs = Counter(t for c in own.values() for t in c)
    tfs = sum(own.values(), Counter())
    assert n == len(rows)
    assert {r.term: (r.df, r.tf_total) for r in counts.collect()} == {t: (dfs[t], tfs[t]) for t in tfs}
    kept = sorted((t for t in dfs if dfs[t] >= 2), key=lambda t: (-tfs[t], t))[:500]
    idf = {t: math.log((1 + n) / (1 + dfs[t])) + 1 for t in kept}
    found = {(r.row_id, r.term): r.tfidf for r in feat.tfidf_long(df, cfg).collect()}
    expected = {}
    for i, c in own.items():
        w = {t: k * idf[t] for t, k in c.items() if t in idf}
        expected |= {(i, t): x / math.sqrt(sum(y * y for y in w.values())) for t, x in w.items()}
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[k], expected[k], rel_tol=1e-9) for k in expected)


@pytest.mark.parametrize("analyzer, lo, hi", [("char_wb", 3, 5), ("char_wb", 2, 3), ("word", 1, 2)])
def test_sums_given_back_in_parts_add_up(analyzer, lo, hi, monkeypatch):
    import pyarrow as pa
    rng = random.Random(1)
    said = [" ".join(chr(rng.randint(97, 4500)) * rng.randint(1, 4) for _ in range(30)) for _ in range(400)]
    batches = lambda: iter([pa.RecordBatch.from_arrays([pa.array(said[i:i + 50])], ["t"]) for i in range(0, 400, 50)])

    def total():
        out, parts = Counter(), 0
        for b in grams.counting(analyzer, lo, hi)(batches()):
            parts += 1
            for r in b.to_pylist():
                for c in ("df", "tf_total", "docs"):
                    out[r["term"], c] += r[c]
        return out, parts
    whole, few = total()
    monkeypatch.setattr(grams, "KEYS", 100)
    monkeypatch.setattr(grams, "KEPT", 50)
    parted, many = total()
    assert whole == parted and many > few


def test_a_bounded_vocabulary_is_weighed_in_the_task(spark, sf_small):
    from polarity.sources import fixtures as fx
    cfg = feat.VARIANTS["real_word_char_hybrid"].parts[1]
    p = feat.tfidf_long(fx.texts(spark, sf_small), cfg, text_col="text")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in p and "Join" not in p and "lambdafunction" not in p


@pytest.mark.parametrize("heavy", [3, 1 << 16])
def test_an_unbounded_vocabulary_is_cut_in_the_task(spark, heavy):
    df, rows = texts(spark)
    cfg = feat.TfidfConfig(analyzer="char_wb", ngram_range=(3, 4))
    bounded = feat.tfidf_long(df, feat.TfidfConfig(analyzer="char_wb", ngram_range=(3, 4), max_features=1_000_000))
    out = feat.tfidf_long(df, cfg, heavy=heavy)
    p = out._jdf.queryExecution().executedPlan().toString()
    assert p.count("MapInArrow") == 2 and "lambdafunction" not in p
    found, expected = ({(r.row_id, r.term): r.tfidf for r in x.collect()} for x in (out, bounded))
    assert found.keys() == expected.keys() and found
    assert all(math.isclose(found[k], expected[k], rel_tol=1e-9) for k in expected)
