"""Duplicate handling: copies and conflicts, counters, keep-first, partition invariance."""

import pytest

from polarity.operators import dedup
from polarity.plans.job import preprocess
from polarity.sources import fixtures as fx


def frame(spark, texts, labels):
    return spark.createDataFrame([(i, l, t) for i, (t, l) in enumerate(zip(texts, labels))],
                                 "row_id long, sentiment int, text string")


def test_three_exact_copies_leave_the_least_id(spark):
    rows = frame(spark, ["tea", "rain", "tea", "tea", "rain"], [0, 1, 0, 1, 1])
    out = {(r.text, r.sentiment): r.row_id for r in dedup.remove_exact_duplicates(rows).collect()}
    assert out == {("tea", 0): 0, ("rain", 1): 1, ("tea", 1): 3}


def test_conflict_needs_two_labels_under_one_key(spark):
    rows = frame(spark, ["salt &amp; oil", "SALT & oil", "salt  &  oil", "bread", "Bread"], [1, 1, 0, 0, 0])
    keyed = rows.withColumn("duplicate_key", dedup.duplicate_key("text"))
    found = dedup.find_conflicting_duplicate_texts(keyed, "duplicate_key")
    assert sorted(r.row_id for r in found.collect()) == [0, 1, 2]
    kept, gone = dedup.remove_conflicting_duplicate_texts(keyed, "duplicate_key")
    assert sorted(r.row_id for r in kept.collect()) == [3, 4] and gone.count() == 3


def test_bundle_counts_copies_and_conflicts(spark):
    rows = frame(spark, ["Fog", " fog", "FOG ", "fog", "sea", "Sea", "sea", "hill"], [1, 1, 1, 1, 0, 1, 0, 0])
    kept, report = dedup.handle_duplicates(rows)
    assert sorted((r.row_id, r.text) for r in kept.collect()) == [(0, "Fog"), (7, "hill")]
    r = report.first()
    assert (r.rows_before, r.exact_duplicate_rows_removed, r.conflicting_duplicate_text_groups) == (8, 1, 1)
    assert (r.conflicting_duplicate_rows_removed, r.same_label_duplicate_rows_removed, r.rows_after) == (2, 3, 2)


def test_user_columns_survive_whatever_they_are_called(spark):
    rows = frame(spark, ["a", "a", "b"], [1, 1, 0]).selectExpr("*", "concat('s', row_id) AS _source", "row_id AS n")
    out = dedup.remove_exact_duplicates(rows)
    assert {"_source", "n"} <= set(out.columns) and out.count() == 2
    clean = dedup.preprocess_plan(rows).clean
    assert sorted((r.row_id, r._source) for r in clean.collect()) == [(0, "s0"), (2, "s2")]
    with pytest.raises(ValueError, match="rename"):
        dedup.remove_exact_duplicates(rows.withColumnRenamed("n", "_first"))


def test_conflicts_are_listed_from_one_scan(spark, sf_small):
    listed = dedup.label_conflicts(fx.posts(spark, sf_small))
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in plan and listed.count() > 0


def test_null_label_counts_as_a_value(spark):
    df = spark.createDataFrame([(0, 1, "a"), (1, None, "A")], "row_id long, sentiment int, text string")
    kept, report = dedup.handle_duplicates(df)
    assert kept.count() == 0 and report.first().conflicting_duplicate_text_groups == 1


def test_counters_telescope_and_match_fixture(spark, sf_small):
    clean, rep = preprocess(fx.posts(spark, "/root/testdata/sf0.01"))
    d = rep["duplicate_report"]
    assert d["rows_before"] == 10000 and d["exact_duplicate_rows_removed"] == 1946
    assert d["conflicting_duplicate_text_groups"] == 453 and d["conflicting_duplicate_rows_removed"] == 1271
    assert d["same_label_duplicate_rows_removed"] == 344 and d["rows_after"] == 6439
    assert d["rows_before"] - d["exact_duplicate_rows_removed"] - d["conflicting_duplicate_rows_removed"] \
        - d["same_label_duplicate_rows_removed"] == d["rows_after"]
    assert rep["conflicting_clean_text_rows_removed"] == 3233
    assert rep["same_label_clean_text_duplicates_removed"] == 1115 and rep["rows_after"] == 2091
    assert d["rows_after"] - rep["empty_clean_text_rows_removed"] - rep["total_clean_text_duplicates_removed"] \
        == rep["rows_after"] == clean.count()
    assert d["conflicting_duplicate_rows"].count() == d["conflicting_duplicate_rows_removed"]


def test_result_does_not_depend_on_partitioning(spark, sf_small):
    posts = fx.posts(spark, sf_small)
    a = dedup.preprocess_plan(posts).clean.collect()
    b = dedup.preprocess_plan(posts.repartition(7, "text")).clean.collect()
    assert sorted(a) == sorted(b)


def test_validation_messages(spark):
    from polarity.operators.quality import validate_dataset
    with pytest.raises(ValueError, match="lacks column"):
        validate_dataset(spark.createDataFrame([(0, "good")], "row_id long, text string"))
    with pytest.raises(ValueError, match="1 row.s. of sentiment hold 1 label"):
        validate_dataset(frame(spark, ["good", "bad"], [1, 2]))
    with pytest.raises(ValueError, match="hold nulls"):
        validate_dataset(frame(spark, ["good", None], [1, 0]))
    with pytest.raises(ValueError, match="blank"):
        validate_dataset(frame(spark, ["good", " \t"], [1, 0]))
    summary = validate_dataset(frame(spark, ["good", "bad"], [1, 0]))
    assert summary["total_rows"] == 2 and summary["label_distribution"] == {"0": 1, "1": 1}


def test_remove_conflicts_and_same_label_steps(spark):
    df = frame(spark, ["Great", " great ", "Bad", "bad", "Ok"], [1, 0, 0, 0, 1]).withColumn(
        "duplicate_key", dedup.duplicate_key("text"))
    kept, conflicting = dedup.remove_conflicting_duplicate_texts(df, "duplicate_key")
    assert sorted(r.text for r in kept.collect()) == ["Bad", "Ok", "bad"]
    assert sorted(r.row_id for r in conflicting.collect()) == [0, 1]
    once = dedup.remove_duplicate_texts_same_label(kept, "duplicate_key").collect()
    assert sorted((r.row_id, r.text) for r in once) == [(2, "Bad"), (4, "Ok")]


def test_profile_missing_values_cover_every_column(spark):
    from polarity.operators.quality import profile_dict
    df = spark.createDataFrame([(0, 1, "a", None), (1, 0, "b", "x"), (2, 0, "b", "x")],
                               "row_id long, sentiment int, text string, source string")
    p = profile_dict(df)
    assert p["missing_values"] == {"sentiment": 0, "text": 0, "source": 1}
    assert p["total_columns"] == 3 and p["duplicate_exact_rows"] == 1
