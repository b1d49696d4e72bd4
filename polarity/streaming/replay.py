"""Drive the scoring stream from the driver tables (used by the registered query).

Unlabelled rows derived from ``events`` are written as several Parquet files
under the shared checkpoint folder, replayed through the L1/L2 queries with an
``availableNow`` trigger, and the scored sink is read back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from polarity.plans import job
from polarity.session import ensure_checkpoint_dir
from polarity.sources import fixtures as fx
from polarity.streaming.scoring import read_paired, run_to_completion, start_paired_scoring, start_scoring


def replay_unlabelled(spark: SparkSession, sf_dir: str, threshold: float | None = 0.47,
                      files: int = 4, model=None) -> tuple[DataFrame, str]:
    """(scored stream output, scratch folder) for the posts of ``sf_dir``."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    fx.unlabelled(spark, sf_dir).repartition(files).write.parquet(f"{root}/input")
    model = job.posts_baseline(spark, sf_dir)[0] if model is None else model
    queries = start_scoring(spark, f"{root}/input", model, f"{root}/out", f"{root}/checkpoints", threshold)
    run_to_completion(queries)
    return spark.read.parquet(f"{root}/out/scored"), root


def stream_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay_unlabelled(spark, sf_dir)[0].drop("scored_at", "request_id")


def replay_paired(spark: SparkSession, sf_dir: str, threshold: float | None = 0.47, files: int = 4, model=None) -> DataFrame:
    """The log of ``start_paired_scoring`` over the posts of ``sf_dir``, one file a
    micro-batch, read back from its JSON sink."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/paired-{uuid.uuid4().hex}"
    fx.unlabelled(spark, sf_dir).repartition(files).write.parquet(f"{root}/input")
    model = job.posts_baseline(spark, sf_dir)[0] if model is None else model
    run_to_completion([start_paired_scoring(spark, f"{root}/input", model, f"{root}/out", f"{root}/checkpoint", threshold,
                                            max_files_per_trigger=1)])
    return read_paired(spark, f"{root}/out", "prediction_log")
