"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polarity.llm import (contextual_pii, conversation_repair, decontamination, exact_dedup, licences, mixing, near_dedup,
                          quality_cotraining, secret_ledger, sharding, toxicity, vector_codes, warc)
from polarity.llm.tables import load, new_folder, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_byte_shards(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    return sharding.shard_by_bytes(docs, 16, carry=["doc_id"])


@query
def op3_mix(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, carry=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


@query
def op4_secret_ledger(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    ledger = secret_ledger.BlobLedger.create(spark, new_folder(spark, "ledger"))
    ledger.update(docs)
    spans = secret_ledger.joined_spans()
    return ledger.findings(docs).select(
        "doc_id", *[F.size(f"{r.kind}_spans").cast("bigint").alias(f"n_{r.kind}") for r in secret_ledger.RULES],
        F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


@query
def op7_warc_salvage(spark, sf):
    manifest = warc.write_archives(load(spark, sf, "pages"), new_folder(spark, "warc"))
    # one short string per archive, as Spark's own file listing holds them
    paths = [r.path for r in manifest.select("path").collect()]
    return warc.read_archives(spark, paths).filter("kind = 'record'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op8_decontaminate(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    return decontamination.contamination(docs, load(spark, sf, "benchmark"), carry=["doc_id"])


@query
def op10_exact_dedup(spark, sf):
    """Half of the documents make the first snapshot, the rest come as a batch."""
    docs = load(spark, sf, "documents").select("doc_id", "text")
    return exact_dedup.deduplicate(docs, F.pmod(F.xxhash64("doc_id"), F.lit(2)), 2, carry=["doc_id"])


@query
def op1_toxicity(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, load(spark, sf, "labels"))
    return toxicity.score(docs, model, carry=["doc_id"])


@query
def op5_near_dedup(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    return near_dedup.classes(docs, carry=["doc_id"])


@query
def op6_quality_cotraining(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    model = quality_cotraining.fit(docs, load(spark, sf, "labels"))
    return quality_cotraining.score(docs, model, carry=["doc_id"])


@query
def op9_licences(spark, sf):
    """Documents as the files of a tree.  They have no paths, so the id gives
    one: 64 documents a folder, 16 folders a parent, by language; the first
    document of a folder, or of a parent, plays its LICENSE file."""
    docs = load(spark, sf, "documents").select("doc_id", "text", "lang")
    parent, folder = F.expr("doc_id div 1024").cast("string"), F.expr("doc_id div 64").cast("string")
    path = F.when(F.col("doc_id") % 1024 == 0, F.concat_ws("/", F.col("lang"), parent, F.lit("LICENSE"))).when(
        F.col("doc_id") % 64 == 0, F.concat_ws("/", F.col("lang"), parent, folder, F.lit("LICENSE"))).otherwise(
        F.concat_ws("/", F.col("lang"), parent, folder, F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))))
    return licences.scan(docs.withColumn("path", path), carry=["doc_id", "path"])


@query
def op11_conversation_repair(spark, sf):
    talks = load(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    rows = conversation_repair.damage(talks)
    found = written(conversation_repair.with_all(talks, conversation_repair.repairs(rows)))
    digests = conversation_repair.repaired_digests(rows, found).withColumnRenamed("conv_id", "of")
    return found.join(digests, F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "conv_id", *conversation_repair.COUNTS, "audit", "repaired_sha256")


@query
def op13_vector_codes(spark, sf):
    vectors = load(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    return vector_codes.compress(vectors, carry=["vec_id"])


@query
def op12_contextual_pii(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "text")
    base = contextual_pii.joined_spans(with_found=False)
    return contextual_pii.find(docs, carry=["doc_id"]).select(
        "doc_id", *[F.size(f"{k}_spans").cast("bigint").alias(f"n_{k}") for k in contextual_pii.KINDS],
        F.sha2(base, 256).alias("base_sha256"), contextual_pii.joined_spans(with_found=True).alias("spans"))
