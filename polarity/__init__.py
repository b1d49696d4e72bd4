"""Spark-native curation, training and scoring of labelled short texts.

Every stage is a DataFrame -> DataFrame function: native Column expressions,
partial aggregations and ``pyspark.ml`` stages.  Python runs in tasks for the
sums of the linear solver and for CSV records with quoted line breaks only.
See README.md for the operator map.

Main entry points (submodules; ``import polarity`` loads only the session)::

    polarity.get_session()                      session with AQE, UTC, checkpoint folder
    polarity.plans.job.run_job(spark, raw)      the end-to-end job
    polarity.plans.job.preprocess(raw)          validate + clean + dedup (+ report)
    polarity.plans.job.split_dataset(clean)     exact stratified split (+ report)
    polarity.operators.models.run_experiments   the model x feature grid
    polarity.operators.score.score              batch scoring with a fitted model
    polarity.streaming.scoring.start_scoring    the same scoring as a stream
    polarity.streaming.scoring.start_paired_scoring    rows and log committed together
"""

from polarity.session import get_session, materialize, spread

__all__ = ["get_session", "materialize", "spread"]
