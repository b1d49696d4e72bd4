"""Session construction and lineage cutting.

Stages are joined lazily; where a result is read more than once (survivors and
their report, the split and its report, feature vectors) it is written once as
Parquet into the shared folder named by ``spark.checkpoint.dir``.  That folder is read from the session; a temporary
one is created only for local sessions that have none (tests, laptops).
"""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of frames nobody references any more are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # checkpoints and shuffles of rows serialise faster and smaller with Kryo
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "polarity", extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and UTC time.

    ``master`` defaults to ``local[$BENCH_CPUS or *]`` when no master is set by
    spark-submit; on a cluster pass nothing and let the launcher decide.
    """
    builder = SparkSession.builder.appName(app_name)
    # spark-submit starts the JVM first and hands Python a gateway port; only a
    # bare ``python`` process needs a master picked here.
    if master is None and "PYSPARK_GATEWAY_PORT" not in os.environ:
        cpus = os.environ.get("BENCH_CPUS", "*")
        master = f"local[{cpus}]"
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` must name shared storage (HDFS, S3,
    ...); a machine-local folder would not survive executor loss, so we refuse
    to invent one there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
        configured = tempfile.mkdtemp(prefix="polarity-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet into the checkpoint folder and cut its lineage.

    The files lie on shared storage, so they survive executor loss, and later
    jobs read only the columns they need.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


TASK_BYTES = 8 << 20
UNKNOWN_BYTES = 1 << 60     # Spark gives a source of unknown size more than this


def source_bytes(df: DataFrame) -> int:
    """Bytes of the files (or rows held by the driver) that ``df`` starts from.

    Read from the plan's leaves: no job runs."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def merged(df: DataFrame) -> DataFrame:
    """A written table (``materialize``) in tasks of at least TASK_BYTES: small
    files are read together, a large table keeps its splits."""
    tasks = max(1, -(-source_bytes(df) // TASK_BYTES))
    return df.coalesce(tasks) if df.rdd.getNumPartitions() > tasks else df


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Give CPU-heavy per-row text work at least one task per core.

    A small source (one Parquet row group, say) lands in fewer tasks than
    there are cores; it is dealt out anew.  With a ``key`` a large source is too,
    in tasks of TASK_BYTES: a row group can't be split, so a large file with few
    of them gives few tasks that grow with it.  Without one, a source of more
    than TASK_BYTES per core is left as it is, and so is one of unknown size in
    either case.  Only the plan is looked at: its input is not run.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = source_bytes(df)
    if key and size < UNKNOWN_BYTES:
        return df.repartition(max(cores * 2, -(-size // TASK_BYTES)), key)
    return df if size >= cores * TASK_BYTES else df.repartition(cores * 2)


def ship_with_tasks(module: str) -> None:
    """Task functions of ``module`` travel by value: executors need no install."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
