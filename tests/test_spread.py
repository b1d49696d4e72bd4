"""A large source with one row group is dealt out by its bytes."""

from polarity import session
from polarity.sources import fixtures as fx


def test_tasks_follow_the_bytes(spark, sf_small, monkeypatch):
    docs = fx.texts(spark, sf_small)
    monkeypatch.setattr(session, "TASK_BYTES", 1 << 10)
    tasks = -(-session.source_bytes(docs) // session.TASK_BYTES)
    assert tasks > 2 * spark.sparkContext.defaultParallelism
    dealt = session.spread(docs, "row_id")
    assert dealt.rdd.getNumPartitions() == tasks
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, docs.collect()))
