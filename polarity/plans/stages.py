"""Committed stages of a job: a rerun starts at the first one that is missing.

Results lie under ``root/<key>/<name>``, where the key is a digest of the input
files (path, size, time of change), the columns and the settings, so other
input or other settings never meet old results.  A table or report counts
once its writer has left the success marker, a model once its marker table
is there; what a lost run left half written is written again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from polarity.session import materialize
from polarity.sources import io


def input_key(df: DataFrame, settings: str) -> str:
    """Digest of what ``df`` reads (one row per file), its schema and the settings."""
    files = df.inputFiles()
    listed = (df.sparkSession.read.format("binaryFile").load(files).selectExpr("path", "length", "unix_micros(modificationTime) t")
              .distinct().collect() if files else [])
    said = json.dumps([sorted(map(list, listed)), df.schema.json(), settings])
    return hashlib.sha256(said.encode()).hexdigest()[:24]


class Stages:
    """``root`` None: nothing is kept, tables are only written for this run."""

    def __init__(self, spark: SparkSession, root: str | None = None, key: str = ""):
        self.spark, self.folder, self.run = spark, root and f"{root.rstrip('/')}/{key}", []

    def _done(self, name: str) -> bool:
        return bool(self.folder) and io._exists(self.spark, f"{self.folder}/{name}/_SUCCESS")

    def has(self, *names: str) -> bool:
        return all(self._done(n) for n in names)

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if not self.folder:
            return materialize(build())
        path = f"{self.folder}/{name}"
        if not self._done(name):
            self.run.append(name)
            build().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def report(self, name: str, build: Callable[[], dict]) -> dict:
        if not self.folder:
            return build()
        if not self._done(name):
            self.run.append(name)
            said = json.dumps(build(), default=float)
            self.spark.createDataFrame([(said,)], "report string").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return json.loads(self.spark.read.parquet(f"{self.folder}/{name}").first().report)

    def models(self, name: str, build: Callable[[], dict[str, PipelineModel]]) -> dict[str, PipelineModel]:
        """Fitted pipelines by name; the list of names is written last."""
        if not self.folder:
            return build()
        path = f"{self.folder}/{name}"
        if not self._done(name):
            self.run.append(name)
            fitted = build()
            for n, model in fitted.items():
                model.write().overwrite().save(f"{self.folder}/{name}-models/{n}")
            self.spark.createDataFrame([(n,) for n in fitted], "name string").coalesce(1).write.mode("overwrite").parquet(path)
            return fitted
        return {r.name: PipelineModel.load(f"{self.folder}/{name}-models/{r.name}") for r in self.spark.read.parquet(path).collect()}
