"""A vocabulary without a bound: blocks of rows exchange their terms for document frequencies."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from polarity.functions import termsets
from polarity.operators import features as feat
from polarity.sources import fixtures as fx

WORD12 = feat.TfidfConfig(ngram_range=(1, 2))


def test_row_and_term_pairs_are_not_shuffled(spark, sf_small):
    out = feat.tfidf_long(fx.texts(spark, sf_small), WORD12, text_col="text")
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in p and "Aggregate" not in p and "Window" not in p
    out.collect()
    p = out._jdf.queryExecution().executedPlan().toString()
    assert p.split("Initial Plan")[0].count("ReusedExchange") == 1      # the texts are dealt out once


def test_a_term_costs_few_bytes_once_a_block(spark, sf_small):
    rows = fx.texts(spark, sf_small).withColumn("_block", F.lit(7)).select("row_id", "_block", F.lower("text").alias("_text")).toArrow()
    b = termsets.block(rows.column(0).combine_chunks(), rows.column(2).combine_chunks(), "word", 1, 2)
    sent = list(termsets.asking("word", 1, 2, termsets.spark_places(8), 3)(iter(rows.to_batches())))
    assert sum(x.nbytes for x in sent) < 8 * len(b.df) < 8 * len(b.tf)


@pytest.mark.parametrize("n", [1, 2, 16, 301])
def test_places_fill_every_partition_once(spark, n):
    dealt = spark.createDataFrame([(p, i) for i, p in enumerate(termsets.spark_places(n))], "p int, i int").repartition(n, "p")
    assert sorted((r.i, r.at) for r in dealt.select("i", F.spark_partition_id().alias("at")).collect()) == [(i, i) for i in range(n)]


def test_rounds_as_spark_does(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.random(5000), 2.0 ** -np.arange(30), (rng.integers(0, 10 ** 6, 5000) * 10 + 5) / 1e7, [0.0, 1.0, 0.1234565, 0.9999995]])
    found = [r[0] for r in spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, v double").orderBy("i").select(F.round("v", 6)).collect()]
    assert termsets.rounded(x, 6).tolist() == found


def test_packed_numbers_and_units_come_back():
    numbers = [np.array(x, np.int64) for x in ([], [0], [255, 0], [256], [70000, 1], [1 << 40])]
    assert [x.tolist() for x in termsets._unpacked(termsets._packed(*numbers))] == [x.tolist() for x in numbers]
    units = pa.array(["", "a", "é漢", "\U0001f600", "end"])
    assert termsets._unpacked_units(termsets._packed_units(units.slice(1, 3))).to_pylist() == units.slice(1, 3).to_pylist()


def expected(rows, lo, hi, fitted, cfg):
    """By id, as the SQL groups; documents are the rows of ``fitted``."""
    def counts(rows):
        own = {}
        for i, t in rows:
            words = [w for w in (t or "").lower().split() if len(w) > 1]
            own.setdefault(i, Counter()).update(" ".join(words[k:k + n]) for n in range(lo, hi + 1) for k in range(len(words) - n + 1))
        return own
    df, n = Counter(t for c in counts(fitted).values() for t in c), len(fitted)
    low, high = feat._df_limits(cfg, n)
    idf = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in df.items() if low <= d <= high}
    out = {}
    for i, c in counts(rows).items():
        w = {t: k * idf[t] for t, k in c.items() if t in idf}
        out |= {(i, t): x / math.sqrt(sum(y * y for y in w.values())) for t, x in w.items()}
    return out


ROWS = [(1, "red car red car"), (2, "red bus"), (3, None), (4, ""), (5, "a b c"), (2, "bus red red"), (None, "car stop"), (None, "red stop"), (6, "only here"), (7, "car " * 300)]


@pytest.mark.parametrize("lo, hi", [(1, 1), (1, 2), (2, 2), (1, 3)])
@pytest.mark.parametrize("limits", [{}, {"min_df": 2}, {"max_df": 0.3}, {"min_df": 99}])
def test_weights_of_odd_rows(spark, lo, hi, limits):
    cfg = feat.TfidfConfig(ngram_range=(lo, hi), **limits)
    df = spark.createDataFrame(ROWS, "row_id long, clean_text string").repartition(3)
    found = [((r.row_id, r.term), r.tfidf) for r in feat.tfidf_long(df, cfg).collect()]
    right = expected(ROWS, lo, hi, ROWS, cfg)
    assert len(found) == len(right) and {k for k, _ in found} == right.keys()
    assert all(math.isclose(v, right[k], rel_tol=1e-9) for k, v in found)


def test_a_vocabulary_fitted_on_other_rows(spark):
    fitted = [(1, "red car"), (2, "car stop"), (3, "blue car")]
    df, fit = (spark.createDataFrame(x, "row_id long, clean_text string") for x in (ROWS, fitted))
    found = {(r.row_id, r.term): r.tfidf for r in feat.tfidf_long(df, WORD12, fit_df=fit).collect()}
    right = expected(ROWS, 1, 2, fitted, WORD12)
    assert found.keys() == right.keys() and all(math.isclose(found[k], right[k], rel_tol=1e-9) for k in right)


def test_many_blocks_equal_few(spark, sf_small, monkeypatch):
    texts = fx.texts(spark, sf_small)
    few = {(r.row_id, r.term): r.tfidf for r in feat.tfidf_long(texts, WORD12, text_col="text").collect()}
    monkeypatch.setattr(feat, "BLOCK_BYTES", 1 << 13)
    many = feat.tfidf_long(texts, WORD12, text_col="text", digits=6)
    assert many.rdd.getNumPartitions() > 2 * spark.sparkContext.defaultParallelism
    found = {(r.row_id, r.term): r.tfidf for r in many.collect()}
    assert found.keys() == few.keys() and all(abs(found[k] - few[k]) < 6e-7 for k in few)
