"""Structured Streaming scoring (L1) and prediction metadata log (L2).

The reference scored requests one at a time behind an HTTP endpoint; here
rows arrive as files, are guarded (C7), scored once with the same fitted
pipeline as the batch job (K1) and written by file sinks, each query with its
own checkpoint, so every row lands exactly once even if executors are lost.
Stateless: no watermark or state store is needed.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from polarity.operators.score import guard_inputs, prediction_log, request_of, score
from polarity.sources import io

INPUT_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("text", T.StringType()),
])


def read_stream(spark: SparkSession, source_dir: str, schema: T.StructType = INPUT_SCHEMA,
                max_files_per_trigger: int | None = None, fmt: str = "parquet", multi_line: bool = False) -> DataFrame:
    """Parquet (or header CSV) files as a stream; ``maxFilesPerTrigger`` is
    the rate control that replaces the online batch-size cap.

    CSV columns are found by name in the header of the files that are there
    at the start; a later file with another header fails the query."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if fmt == "csv":
        header = io.csv_columns(spark, source_dir)
        as_read = io.by_name(header, schema, source_dir)
        raw = (reader.schema(as_read).option("header", True).option("enforceSchema", as_read.names != header)
                     .option("multiLine", multi_line).option("mode", "FAILFAST")
                     .option("quote", '"').option("escape", '"').csv(source_dir))
        return io.typed(raw, schema)
    if fmt != "parquet":
        raise ValueError(f"no such stream format: {fmt}")
    return reader.schema(schema).parquet(source_dir)


def scored_stream(stream: DataFrame, model: PipelineModel, threshold: float | None = None,
                  keep: tuple[str, ...] = ("row_id",)) -> tuple[DataFrame, DataFrame]:
    """(scored accepted rows, rejected rows with reason) - both still streams."""
    guarded = guard_inputs(stream)
    accepted = guarded.where(F.col("accepted"))
    rejected = guarded.where(~F.col("accepted")).select("row_id", "text", "rejection_reason")
    return score(accepted, model, threshold, keep=keep), rejected


def start_scoring(spark: SparkSession, source_dir: str, model: PipelineModel, out_dir: str,
                  checkpoint_root: str, threshold: float | None = None, available_now: bool = True,
                  max_files_per_trigger: int | None = None, schema: T.StructType = INPUT_SCHEMA,
                  event_time: str | None = None, fmt: str = "parquet") -> list[StreamingQuery]:
    """L1 + L2: three sinks (scored parquet, rejected parquet, metadata JSON).

    The model runs once per row: the log is a stream over the scored sink, a
    projection of what was written, and carries the same ``request_id``.  Its
    timestamp is ``event_time`` when the input has one, else the time at which
    the row was scored.  With ``available_now`` the log starts when scoring
    has ended, so this call then waits for it."""
    stream = read_stream(spark, source_dir, schema, max_files_per_trigger, fmt)
    keep = ("row_id", event_time) if event_time else ("row_id",)
    scored, rejected = scored_stream(stream, model, threshold, keep)
    scored = scored.withColumn("request_id", request_of("row_id"))
    if not event_time:
        scored = scored.withColumn("scored_at", F.current_timestamp())

    def sink(df: DataFrame, fmt: str, name: str) -> StreamingQuery:
        w = (df.writeStream.format(fmt).outputMode("append")
               .option("checkpointLocation", f"{checkpoint_root}/{name}"))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
        return w.start(f"{out_dir}/{name}")

    # the log's source folder must exist before its first file does
    spark.createDataFrame([], scored.schema).write.mode("ignore").parquet(f"{out_dir}/scored")
    queries = [sink(scored, "parquet", "scored"), sink(rejected, "parquet", "rejected")]
    if available_now:
        run_to_completion(queries[:1])
    sent = spark.readStream.schema(scored.schema).parquet(f"{out_dir}/scored")
    log = prediction_log(sent, event_time=event_time or "scored_at", request_id="request_id")
    return [*queries, sink(log, "json", "prediction_log")]


def run_to_completion(queries: list[StreamingQuery]) -> None:
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"streaming query {q.name or q.id} failed: {q.exception()}")


# --- scored rows and their log, committed together -------------------------------------

PAIRED = ("scored", "rejected", "prediction_log")


def start_paired_scoring(spark: SparkSession, source_dir: str, model: PipelineModel, out_dir: str, checkpoint: str,
                         threshold: float | None = None, available_now: bool = True, max_files_per_trigger: int | None = None,
                         schema: T.StructType = INPUT_SCHEMA, event_time: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """L1 + L2 as one query: every micro-batch is scored once and its scored
    rows, rejected rows and log lines are written under the batch's number.

    A batch that is replayed after a failure overwrites what its first attempt
    left, in every sink, with the same request ids; the number is added to
    ``commits`` last, and ``read_paired`` shows committed batches only.  So a
    reader never sees a row without its log line, nor one twice."""
    keep = ("row_id", event_time) if event_time else ("row_id",)

    def commit(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession

        def put(df: DataFrame, name: str, fmt: str = "parquet") -> str:
            path = f"{out_dir}/{name}/batch={number}"
            df.write.mode("overwrite").format(fmt).save(path)
            return path

        scored, rejected = scored_stream(batch, model, threshold, keep)
        scored = scored.withColumn("request_id", request_of("row_id"))
        if not event_time:
            scored = scored.withColumn("scored_at", F.current_timestamp())
        sent = own.read.schema(scored.schema).parquet(put(scored, "scored"))     # the model runs once
        put(rejected, "rejected")
        put(prediction_log(sent, event_time=event_time or "scored_at", request_id="request_id"), "prediction_log", "json")
        put(own.range(1).select(F.lit(number).cast("long").alias("number")), "commits")

    stream = read_stream(spark, source_dir, schema, max_files_per_trigger, fmt)
    w = stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


LOG_SCHEMA = ("timestamp timestamp, request_id string, predicted_label int, predicted_sentiment string, positive_probability double, "
              "negative_probability double, threshold double, text_length long")


def read_paired(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """The rows of one sink (``scored``, ``rejected`` or ``prediction_log``) in
    committed batches, with the column ``batch``."""
    if name not in PAIRED:
        raise ValueError(f"no such sink: {name}")
    numbers = spark.read.parquet(f"{out_dir}/commits").select("number")
    rows = (spark.read.schema(LOG_SCHEMA + ", batch int").json(f"{out_dir}/{name}") if name == "prediction_log"
            else spark.read.parquet(f"{out_dir}/{name}"))
    return rows.join(numbers, F.col("batch") == F.col("number"), "left_semi")
