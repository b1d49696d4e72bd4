"""Plan-shape invariants: the scaling properties the design relies on."""

from polarity.operators import dedup, features as feat, metrics as mx, split
from polarity.session import materialize
from polarity.sources import fixtures as fx


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_preprocess_is_three_shuffles_no_window_no_join(spark, sf_small):
    p = plan(dedup.preprocess_plan(fx.posts(spark, sf_small)).clean)
    assert p.count("Exchange hashpartitioning") == 3
    assert "Window" not in p and "Join" not in p
    assert "Python" not in p


def test_scan_prunes_columns(spark, sf_small):
    p = plan(dedup.preprocess_plan(fx.posts(spark, sf_small)).clean)
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in p


def test_split_is_one_expression_over_one_scan(spark, sf_small):
    clean = materialize(dedup.preprocess_plan(fx.posts(spark, sf_small)).clean)
    table = split.stratified_split(clean)
    p = plan(table)
    assert p.count("FileScan") == 1 and "Join" not in p and "Exchange" not in p and "Window" not in p
    assert plan(split.split_report(table)).count("FileScan") == 1


def test_sweep_is_one_aggregation_over_the_data(spark, sf_small):
    p = plan(mx.threshold_sweep(fx.scored(spark, sf_small)))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert p.count("Exchange hashpartitioning") == 1   # the bucket counts; the rest is <= 42 rows
    assert "lambdafunction" not in p


def test_bounded_tfidf_shuffles_no_terms(spark, sf_small):
    p = plan(feat.tfidf_long(fx.texts(spark, sf_small), feat.BASELINE_TFIDF, text_col="text"))
    assert p.count("Exchange hashpartitioning") == p.count("Exchange hashpartitioning(row_id") <= 1     # spreading a small source
    assert "SortMergeJoin" not in p and "Window" not in p and p.count("documents.parquet") == 1


def test_scoring_is_map_only(spark, sf_small):
    from polarity.operators import score
    from polarity.plans import job
    model, _ = job.posts_baseline(spark, sf_small)
    p = plan(score.score(fx.unlabelled(spark, sf_small), model, 0.47, keep=("row_id",)))
    assert "Exchange hashpartitioning" not in p and "SortMergeJoin" not in p


def jobs_of(spark, build):
    spark.sparkContext.setJobGroup("planned", "planning")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("planned"))
    finally:
        spark.sparkContext.setJobGroup("other", "")


def test_building_a_term_plan_runs_no_job(spark, sf_small):
    reviews = fx.reviews(spark, sf_small)
    assert jobs_of(spark, lambda: feat.doc_terms(reviews, feat.BASELINE_TFIDF, text_col="text")) == 0


def test_spread_deals_out_small_sources_only(spark, monkeypatch):
    from polarity import session
    cores = spark.sparkContext.defaultParallelism
    small = materialize(spark.range(1000).coalesce(1))
    assert session.spread(small, "id").rdd.getNumPartitions() >= cores
    monkeypatch.setattr(session, "TASK_BYTES", 1)
    assert session.spread(small) is small


def test_written_vectors_follow_their_bytes(spark, monkeypatch):
    from polarity import session
    table = materialize(spark.range(100000).repartition(16))
    assert session.merged(table).rdd.getNumPartitions() == 1
    monkeypatch.setattr(session, "TASK_BYTES", 1 << 10)
    assert session.merged(table).rdd.getNumPartitions() == table.rdd.getNumPartitions()
