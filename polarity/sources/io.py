"""Sources and sinks.

Explicit schemas, never inference.  Stages exchange Parquet; CSV is the
interchange format of the reference and is read by column name with RFC-4180
quoting (quoted commas, doubled quotes; embedded newlines when asked for).
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polarity.session import materialize, ship_with_tasks

ship_with_tasks(__name__)

RAW_SCHEMA = T.StructType([
    T.StructField("sentiment", T.IntegerType()),
    T.StructField("text", T.StringType()),
])
SCORING_SCHEMA = T.StructType([T.StructField("text", T.StringType())])
# The keys of the threshold file.
THRESHOLD_SCHEMA = T.StructType([
    T.StructField("threshold", T.DoubleType()),
    T.StructField("selected_metric", T.StringType()),
    T.StructField("selected_metric_value", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("macro_f1", T.DoubleType()),
    T.StructField("weighted_f1", T.DoubleType()),
    T.StructField("false_positives", T.LongType()),
    T.StructField("false_negatives", T.LongType()),
])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """The header of a CSV file (of the first of several, by path)."""
    least = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .agg(F.min("path")).first()[0])
    if least is None:
        raise ValueError(f"{path} holds no file")
    head = spark.read.option("quote", '"').option("escape", '"').option("header", False).csv(least).first()
    return [] if head is None else [(v or "").lstrip("\ufeff") for v in head]


def by_name(header: list[str], schema: T.StructType, path: str) -> T.StructType:
    """An all-string schema in file order; raises for a missing or doubled column."""
    missing = [f.name for f in schema if f.name not in header]
    if missing:
        raise ValueError(f"{path} has no column(s) {missing}; its header is {header}")
    doubled = sorted({f.name for f in schema if header.count(f.name) > 1})
    if doubled:
        raise ValueError(f"{path} names column(s) {doubled} twice")
    plain = len({h.lower() for h in header}) == len(header) and all(header)
    known = {f.name for f in schema}
    return T.StructType([T.StructField(name if plain or name in known else f"_extra{i}", T.StringType())
                         for i, name in enumerate(header)])


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns of an all-string table, cast (a bad value raises)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA,
             with_row_id: bool = True, multi_line: bool = False) -> DataFrame:
    """A1/A2: header CSV, columns found by their names.

    The header may hold the schema's columns in any order and others besides,
    which are left out; every file must have the header of the first (by
    path).  ``multi_line`` allows line breaks inside quotes; it makes one task
    per file, so it is off unless asked for: without it such a file raises.

    ``row_id`` follows path and place in the file, whatever the sizes of the
    files: it is the keep-first order of every dedup step.  It is the rank of
    (file, block start) in the high bits and the place in the block below.
    """
    if not _exists(spark, path):
        raise FileNotFoundError(f"no such dataset: {path}")
    try:
        header = csv_columns(spark, path)
        as_read = by_name(header, schema, path)
        raw = (spark.read.schema(as_read).option("header", True)
               # checks every file's header, unless a blank or doubled name had to be replaced
               .option("enforceSchema", as_read.names != header)
               .option("multiLine", multi_line).option("quote", '"').option("escape", '"')
               .option("mode", "FAILFAST").csv(path))
        df = typed(raw, schema)
        if with_row_id:
            df = _in_file_order(raw, schema)
        df.limit(1).collect()  # an unreadable file fails here, not in a later job
    except FileNotFoundError:
        raise
    except Exception as exc:
        raise ValueError(f"{path} is no readable CSV dataset: {exc}") from exc
    return df


# --- splittable CSV with line breaks inside quotes ----------------------------------

def _open_quote(text: str, inside: bool) -> bool:
    return inside ^ (text.count('"') % 2 == 1)


def _records(starts):
    """Task body: lines of blocks, in order, into records.

    ``starts``: {(path, block): whether the block begins inside quotes}.  The
    lines of a record that began in an earlier block, and of one that ends in a
    later one, are sent on as fragments."""
    def run(batches):
        begun = starts.value
        block, inside, held, head = None, False, [], False

        def closed(kind):
            return [] if block is None or not held else [(block[0], block[1], first, kind, "\n".join(held))]

        for batch in batches:
            out = []
            for path, at, line_no, line in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (path, at) != block:
                    out += closed("head" if head else "tail" if inside else "whole")
                    block, held = (path, at), []
                    inside = head = begun[path, at]
                if not held:
                    first = line_no
                held.append(line)
                inside = _open_quote(line, inside)
                if not inside:
                    out += closed("head" if head else "whole")
                    held, head = [], False
            yield _record_batch(out)
        yield _record_batch(closed("head" if head else "tail" if inside else "whole"))

    return run


_RECORD = "path string, block long, line long, kind string, record string"


def _record_batch(rows):
    columns = list(zip(*rows)) or [()] * 5
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                      names=["path", "block", "line", "kind", "record"])


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(path, block, line, record): the records of header CSV files, whose
    quoted fields may hold line breaks, read block by block.

    A line break ends a record when an even number of quotes precedes it in the
    file.  A first pass counts the quotes of each block; running sums over the
    blocks of a file (one row each) tell which blocks begin inside quotes.  The
    second pass joins lines to records where they are read; only fragments at
    block edges, at most two per block, meet in a shuffle.
    """
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("line"), F.col("value").alias("record")))
    quotes = lines.groupBy("path", "block").agg(F.sum(F.length("record") - F.length(F.replace("record", F.lit('"'), F.lit("")))).alias("n"))
    ahead = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = quotes.select("path", "block", (F.coalesce(F.sum("n").over(ahead), F.lit(0)) % 2 == 1).alias("inside")).collect()
    starts = spark.sparkContext.broadcast({(r.path, r.block): r.inside for r in begun})
    made = materialize(lines.mapInArrow(_records(starts), _RECORD))
    # a fragment belongs to the record whose tail was seen last before it
    edges = made.filter("kind <> 'whole'")
    before = Window.partitionBy("path").orderBy("block", "line")
    numbered = edges.withColumn("of", F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(before))
    parts = F.array_sort(F.collect_list(F.struct("block", "line", "record")))
    joined = (numbered.groupBy("path", "of").agg(parts.alias("p"))
              .select("path", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["line"].alias("line"),
                      F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record")))
    return made.filter("kind = 'whole'").drop("kind").unionByName(joined)


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, with_row_id: bool = True) -> DataFrame:
    """A1/A2 for header CSV whose quoted fields hold line breaks: as
    ``read_csv(multi_line=True)``, but one large file is read by many tasks.

    Every file must have the header of the first (by path); blank lines are
    skipped.  Records are parsed by Spark's own CSV parser."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"no such dataset: {path}")
    records = csv_records(spark, path).withColumn("record", F.regexp_replace("record", "\\r$", ""))
    heads = records.groupBy("path").agg(F.min(F.struct("block", "line")).alias("at"), F.min_by("record", F.struct("block", "line")).alias("head"))
    kinds = [r[0] for r in heads.groupBy(F.regexp_replace("head", "^\ufeff", "")).agg(F.min("path").alias("p")).orderBy("p").collect()]
    if not kinds:
        raise ValueError(f"{path} holds no record")
    if len(kinds) > 1:
        raise ValueError(f"the files of {path} have different headers: {kinds[:2]}")
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true"}
    width = len(spark.range(1).select(F.from_csv(F.lit(kinds[0]), F.schema_of_csv(F.lit(kinds[0]), options), options).alias("h"))
                .select("h.*").columns)
    names = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    head = spark.range(1).select(F.from_csv(F.lit(kinds[0]), names.simpleString()[7:-1].replace(":", " "), options).alias("h")).first().h
    as_read = by_name([v or "" for v in head], schema, path)
    body = records.join(F.broadcast(heads.select(F.col("path").alias("_p"), F.col("at").alias("_at"))), F.col("path") == F.col("_p"))  # a row per file
    body = body.filter((F.struct("block", "line") != F.col("_at")) & (F.trim("record") != ""))
    parsed = body.select("path", "block", "line", F.from_csv("record", ", ".join(f"`{f.name}` string" for f in as_read), options).alias("r"))
    out = parsed.select("path", "block", "line", *[F.col("r").getField(f.name).cast(f.dataType).alias(f.name) for f in schema])
    return _numbered(out, schema) if with_row_id else out.select(*schema.names)


def _numbered(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``row_id`` by path, block and line: blocks are counted, then numbered."""
    rows = materialize(rows)
    counts = rows.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.orderBy("path", "block").rowsBetween(Window.unboundedPreceding, -1)     # a row per block
    before = counts.select(F.col("path").alias("_p"), F.col("block").alias("_b"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_n"))
    placed = rows.withColumn("_i", F.row_number().over(Window.partitionBy("path", "block").orderBy("line")) - 1)
    joined = placed.join(before, (F.col("path") == F.col("_p")) & (F.col("block") == F.col("_b")))
    return joined.select(*schema.names, (F.col("_n") + F.col("_i")).alias("row_id"))


def _in_file_order(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with an id that grows with (path, block start, place in the block).

    One Spark partition may hold blocks of several files, so the id is built
    from the block itself: blocks are listed (one row each) and numbered."""
    spot = raw.select("*", F.col("_metadata.file_path").alias("_path"),
                      F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    blocks = spot.groupBy("_path", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy("_path", "_block").rowsBetween(Window.unboundedPreceding, -1)
    numbered = blocks.select(F.col("_path").alias("_p"), F.col("_block").alias("_b"), "_first",
                             F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    joined = spot.join(numbered, (F.col("_path") == F.col("_p")) & (F.col("_block") == F.col("_b")))
    return joined.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema],
                         (F.col("_before") + F.col("_at") - F.col("_first")).alias("row_id"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A1 Parquet twin."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"no such dataset: {path}")
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """A3: overwrite a table; CSV gets a header, splits use ``partitionBy``."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        # the writer's default would trim the values
        (w.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
          .option("ignoreTrailingWhiteSpace", False).csv(path))
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"Unsupported table format: {fmt}")


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    """A4: a nested report as one JSON document (one-row DataFrame, one file)."""
    doc = json.dumps(report, default=float)
    row = spark.createDataFrame([(doc,)], "value string").select(
        F.from_json("value", F.schema_of_json(F.lit(doc))).alias("r")).select("r.*")
    row.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str) -> dict:
    """A5: read a JSON report back (first row)."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"no such report: {path}")
    row = spark.read.json(path).first()
    return row.asDict(recursive=True) if row else {}


def save_threshold_config(spark: SparkSession, best: dict, path: str, metric: str = "macro_f1") -> dict:
    """A4: the selected threshold and its validation metrics."""
    payload = {
        "threshold": float(best["threshold"]),
        "selected_metric": metric,
        "selected_metric_value": float(best[metric]),
        "accuracy": float(best["accuracy"]),
        "macro_f1": float(best["macro_f1"]),
        "weighted_f1": float(best["weighted_f1"]),
        "false_positives": int(best["false_positives"]),
        "false_negatives": int(best["false_negatives"]),
    }
    spark.createDataFrame([payload], THRESHOLD_SCHEMA).coalesce(1).write.mode("overwrite").json(path)
    return payload


def load_threshold_config(spark: SparkSession, path: str) -> dict:
    """A5 + C9: read the threshold file; the threshold must lie in [0, 1]."""
    if not _exists(spark, path):
        raise FileNotFoundError(f"no threshold file at {path}")
    row = spark.read.schema(THRESHOLD_SCHEMA).json(path).first()
    if row is None or row["threshold"] is None:
        raise ValueError(f"{path} holds no threshold")
    if not 0.0 <= row["threshold"] <= 1.0:
        raise ValueError(f"a threshold is a probability, not {row['threshold']}")
    return row.asDict()
