"""Corpus pipeline: documents in, a sharded training mix out.

Each stage is ``(name, function(spark, docs, sf_dir) -> DataFrame)``.  Its
result is written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polarity.llm import decontamination, mixing, near_dedup, sharding, toxicity
from polarity.llm.tables import drop_tables, load, recorded, written

SHARDS = 16
CARRY = ["rest", "text"]


def _boxed(docs: DataFrame) -> DataFrame:
    """The text, and all other columns in one struct: whatever they are
    called, no column that an operator adds can replace them."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != "text"]).alias("rest"),
                       "text", docs["doc_id"], docs["source"])


def _docs(boxed: DataFrame, docs: DataFrame) -> DataFrame:
    return boxed.select(*[F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel classifier doesn't reject."""
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    return _docs(toxicity.score(_boxed(docs), model, [*CARRY]).filter("predicted = 0"), docs)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of least id."""
    return _docs(near_dedup.classes(_boxed(docs), [*CARRY]).filter("kept"), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    marked = decontamination.contamination(_boxed(docs), load(spark, sf_dir, "benchmark"), [*CARRY])
    return _docs(marked.filter("not contaminated"), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (possibly not at all)."""
    return _docs(mixing.repeated(mixing.mix(_boxed(docs), carry=[*CARRY]), [*CARRY]), docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and place."""
    return sharding.shard_by_bytes(docs, SHARDS)


_helpers: dict[str, tuple[int, list[str]]] = {}     # by session: the last stage begun and its tables


def _in_turn(place: int, stage):
    """``stage``, which first drops the helper tables of the one before it.

    A stage gets what the one before it wrote, so those tables have been read
    for the last time.  Out of turn, or when ``docs`` itself still reads them,
    nothing is dropped."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        key = spark.sparkContext.applicationId
        last, tables = _helpers.pop(key, (None, []))
        own = [t.rsplit("/", 1)[-1] for t in tables]
        if last == place - 1 and not any(t in f for f in docs.inputFiles() for t in own):
            drop_tables(spark, tables)
        with recorded() as made:
            out = stage(spark, docs, sf_dir)
        _helpers[key] = (place, made)
        return out

    return run_stage


STAGES = [(name, _in_turn(place, stage)) for place, (name, stage) in enumerate([
    ("toxicity", drop_toxic),
    ("near_dedup", one_of_each_class),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
])]

# A learned score and similarity classes have no SQL form; tests/llm holds the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
