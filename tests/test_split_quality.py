"""Exact split quotas, determinism, leakage, histogram = numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from polarity.operators import quality, split
from polarity.plans.job import preprocess, split_dataset
from polarity.sources import fixtures as fx


def test_quotas_reproduce_recorded_split():
    q = split.quotas({0: 73801, 1: 99664}, split.SplitConfig())
    assert q[0] == (59041, 7380, 7380) and q[1] == (79731, 9966, 9967)


def test_split_sizes_must_sum_to_one():
    with pytest.raises(ValueError, match="do not sum to 1"):
        split.quotas({0: 10, 1: 10}, split.SplitConfig(train_size=0.7))


def test_class_with_one_row_cannot_be_split():
    with pytest.raises(ValueError, match="Cannot split"):
        split.quotas({0: 1, 1: 50}, split.SplitConfig())


def test_unstratified_quotas():
    q = split.quotas({0: 3, 1: 8}, split.SplitConfig(stratify=False))
    assert q == {"__all__": (8, 1, 2)}


def test_split_is_exact_deterministic_and_leak_free(spark):
    clean, _ = preprocess(fx.posts(spark, "/root/testdata/sf0.01"))
    table, report = split_dataset(clean)
    counts = {r[0]: r[1] for r in clean.groupBy("sentiment").count().collect()}
    q = split.quotas(counts, split.SplitConfig())
    for label, (t, v, s) in q.items():
        assert report["train_label_distribution"][str(label)] == t
        assert report["validation_label_distribution"][str(label)] == v
        assert report["test_label_distribution"][str(label)] == s
    again = split.assign_splits(clean.repartition(5), q).select("row_id", "split").collect()
    assert sorted(again) == sorted(table.select("row_id", "split").collect())
    assert split.split_leakage(table).first()[0] == 0


def test_histogram_matches_numpy(spark):
    lengths = [3, 5, 5, 9, 10, 17, 17, 17, 40, 41, 99]
    df = spark.createDataFrame([(i, 1, "x" * n) for i, n in enumerate(lengths)], "row_id long, sentiment int, text string")
    got = quality.length_histogram(df).orderBy("bin").collect()
    counts, edges = np.histogram(np.array(lengths), bins=50)
    assert [r["count"] for r in got] == counts.tolist()
    assert np.allclose([r.bin_start for r in got], edges[:-1])
    same = spark.createDataFrame([(0, 1, "abc"), (1, 1, "xyz")], "row_id long, sentiment int, text string")
    counts, _ = np.histogram(np.array([3, 3]), bins=50)
    assert [r["count"] for r in quality.length_histogram(same).orderBy("bin").collect()] == counts.tolist()


def test_profile_median_is_interpolated(spark):
    df = spark.createDataFrame([(0, 1, "ab"), (1, 0, "abcd"), (2, 1, "ab")], "row_id long, sentiment int, text string")
    p = quality.profile(df).first()
    assert p.median_text_length == 2.0 and p.duplicate_exact_rows == 1 and p.max_text_length == 4
    df2 = df.union(spark.createDataFrame([(3, 0, "abcdefg")], df.schema))
    assert quality.profile(df2).first().median_text_length == 3.0


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(i, 1 if i < 3 else 0, "t") for i in range(4)], "row_id long, sentiment int, text string")
    w = {r.sentiment: r.weight for r in split.class_weights(df).collect()}
    assert w == {1: 4 / (2 * 3), 0: 4 / (2 * 1)}


def test_refined_buckets_give_the_same_split(spark):
    clean, _ = preprocess(fx.posts(spark, "/root/testdata/sf0.01"))
    plain = split.stratified_split(clean).select("row_id", "split").collect()
    few, split.CUT_ROWS = split.CUT_ROWS, 2
    try:
        refined = split.stratified_split(clean).select("row_id", "split").collect()
    finally:
        split.CUT_ROWS = few
    assert sorted(plain) == sorted(refined)


def test_profile_approx_median(spark):
    df = spark.createDataFrame([(i, 1, "x" * (i + 1)) for i in range(9)], "row_id long, sentiment int, text string")
    assert quality.profile(df, approx=True).first().median_text_length == 5.0
    assert quality.profile(df).first().median_text_length == 5.0


def test_unstratified_split_sizes(spark):
    clean, _ = preprocess(fx.posts(spark, "/root/testdata/sf0.001"))
    cfg = split.SplitConfig(stratify=False)
    table = split.stratified_split(clean, cfg=cfg)
    n = clean.count()
    (t, v, s), = split.quotas({"__all__": n}, cfg).values()
    got = {r.split: r["count"] for r in table.groupBy("split").count().collect()}
    assert got == {"train": t, "validation": v, "test": s}


def test_split_loses_no_row(spark):
    rows = [(i, None if i % 5 == 0 else i % 2, f"t{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "row_id long, sentiment int, text string").selectExpr("*", "row_id AS _p")
    table = split.stratified_split(df)
    assert table.count() == 200 and table.where("split IS NULL").count() == 0
    counts = {None: 40, 0: 80, 1: 80}
    q = split.quotas(counts, split.SplitConfig())
    got = {(r.sentiment, r.split): r["count"] for r in table.groupBy("sentiment", "split").count().collect()}
    assert got == {(k, s): n for k, v in q.items() for s, n in zip(split.SPLITS, v)}
    with pytest.raises(Exception, match="row_id is null"):
        split.stratified_split(df.withColumn("row_id", F.when(F.col("row_id") > 3, F.col("row_id")))).count()


def test_repeated_id_at_a_cut_is_refused(spark):
    df = spark.createDataFrame([(7, i % 2, f"t{i}") for i in range(40)], "row_id long, sentiment int, text string")
    with pytest.raises(ValueError, match="unique"):
        split.stratified_split(df)


def test_shares_follow_the_rule():
    assert split.shares([5, 3, 2], 5) == [3, 1, 1]      # 2.5, 1.5, 1.0: the tie goes to the first
    assert split.shares([1, 1, 1], 2) == [1, 1, 0]
