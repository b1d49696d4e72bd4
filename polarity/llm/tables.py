"""Reading the input tables, cutting lineage and keeping user columns apart."""

from __future__ import annotations

import sys
import uuid
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from polarity.session import ensure_checkpoint_dir

# UDF bodies of this subpackage travel by value, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules["polarity.llm"])


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh path under the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: later stages read files that every executor sees, so the
    loss of an executor never recomputes what came before.
    """
    path = new_folder(df.sparkSession, "table")
    for made in _recording:
        made.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_recording: list[list[str]] = []


@contextmanager
def recorded():
    """The paths of the tables that ``written`` makes inside the block."""
    made: list[str] = []
    _recording.append(made)
    try:
        yield made
    finally:
        _recording.remove(made)


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that ``written`` made and that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def packed(df: DataFrame, carry: list[str], **own: Column) -> DataFrame:
    """The columns ``carry`` of ``df`` in one struct ``row`` beside the
    operator's ``own``.

    Helper names can then never clash with the user's columns.
    """
    return df.select(F.struct(*[df[f"`{c}`"] for c in carry]).alias("row"),
                     *[c.alias(name) for name, c in own.items()])


def unpacked(df: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """Undo ``packed``: the user's columns, then ``new`` ones, which replace
    user columns of the same name (compared without case, as Spark does)."""
    taken = {n.lower() for n in new}
    kept = [F.col("row").getField(c).alias(c) for c in columns if c.lower() not in taken]
    return df.select(*kept, *[c.alias(n) for n, c in new.items()])
