"""Exact duplicates over immutable snapshots (operator 10).

Rows arrive in batches.  Each batch groups its own copies; the batch's
distinct digests are screened by the static binary fuse filters of the
snapshots before it.  Digests that pass join the snapshots' exact buckets,
where the normalised bytes are compared; the others are new and make the next
snapshot, with filters of its own.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polarity.llm import fuse
from polarity.llm.tables import packed, unpacked, written

BUCKET_KEYS = 1 << 16       # digests of a bucket, about
LEAST_BUCKETS = 16

# Fixed value: the characters that don't count (space and controls 09 to 0D).
SPACE = r"[\x20\x09-\x0D]+"


def normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, "")


def deduplicate(df: DataFrame, batch: Column, batches: int, carry: list[str] | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``carry`` columns (default: all) plus keep_id, group_size, kept, text_sha256.

    Texts are equal when they agree without white space (null: empty).  Of a
    group the row with most code points stays, then the least id (null last),
    then the first row.  ``batch`` gives each row its batch 0..batches-1; the
    result doesn't depend on it.  One row comes out per row that goes in, also
    for repeated rows and ids; an empty table gives an empty result.  Carried
    columns named like an added one are replaced.
    """
    carry = list(carry or df.columns)
    digest = F.unhex(F.sha2(normal(df[text_col]), 256))
    rows = written(packed(
        df, carry, id=df[id_col], rid=F.monotonically_increasing_id(), batch=batch.cast("int"), digest=digest,
        points=F.coalesce(F.length(df[text_col].cast("string")), F.lit(0))))
    # each batch's distinct texts once; copies collapse before the shuffle
    staged = written(
        df.select(batch.cast("int").alias("batch"), digest.alias("digest"), normal(df[text_col]).alias("bytes"))
        .groupBy("batch", "digest").agg(F.first("bytes").alias("bytes")))
    groups = _grow(staged, batches)
    best = F.min(F.struct((-F.col("points")).alias("points"), F.col("id").isNull().alias("void"),
                          F.col("id"), F.col("rid").alias("first")))
    per_batch = rows.groupBy("batch", "digest").agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
    elected = (per_batch.join(groups, ["batch", "digest"]).groupBy("digest", "origin")
               .agg(F.min("best").alias("best"), F.sum("n").alias("n"))
               .select(F.col("digest").alias("d"), F.col("origin").alias("o"), "best", "n"))
    placed = groups.select(F.col("digest").alias("d"), F.col("batch").alias("b"), F.col("origin").alias("o"))
    stays = placed.join(elected, ["d", "o"]).select("d", "b", "best", "n")
    joined = rows.join(stays, (F.col("digest") == F.col("d")) & (F.col("batch") == F.col("b")))
    return unpacked(joined, carry, keep_id=F.col("best.id"), group_size=F.col("n").cast("bigint"),
                    kept=F.col("rid") == F.col("best.first"), text_sha256=F.lower(F.hex("digest")))


def _grow(staged: DataFrame, batches: int) -> DataFrame:
    """(batch, digest, origin): the snapshot in which a batch's digest began."""
    found, snapshots = [], []
    for now in range(batches):
        fresh = staged.filter(F.col("batch") == now)
        seen = [_same_bytes(fresh, snap, screened(fresh.select("digest"), filters), now)
                for snap, filters in snapshots]
        if seen:
            # snapshots share no digest, so at most one of them matches
            old = written(reduce(DataFrame.unionByName, seen))
            found.append(old)
            fresh = fresh.join(old.select("digest"), "digest", "left_anti")
        found.append(fresh.select("batch", "digest", F.lit(now).alias("origin")))
        if now + 1 < batches:
            snapshots.append((fresh, written(filters_of(fresh.select("digest")))))
    return reduce(DataFrame.unionByName, found)


def _same_bytes(fresh: DataFrame, snapshot: DataFrame, passed: DataFrame, now: int) -> DataFrame:
    """Digests that passed the filters and whose bytes equal the snapshot's.

    Only rows of digests that are in both get their bytes read side by side.
    A digest whose bytes differ stays apart, as a text of this batch."""
    both = passed.join(snapshot.select("digest", F.col("batch").alias("origin")), "digest")
    mine = fresh.select("digest", F.col("bytes").alias("mine"))
    theirs = snapshot.select("digest", F.col("bytes").alias("theirs"))
    return (both.join(mine, "digest").join(theirs, "digest").filter("mine = theirs")
            .select(F.lit(now).alias("batch"), "digest", "origin"))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring("digest", 9, 4)), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def _keys(digests: pd.Series) -> np.ndarray:
    joined = b"".join(bytes(d) for d in digests)
    return np.frombuffer(joined, dtype=np.uint8).reshape(-1, 32)[:, :8].copy().view(np.uint64).ravel()


def filters_of(digests: DataFrame) -> DataFrame:
    """One filter per bucket: (bucket, buckets, seed, segment, starts, slots).

    Digests are spread evenly, so a bucket's size is bounded by the number of
    buckets, which follows the count."""
    buckets = max(LEAST_BUCKETS, -(-digests.count() // BUCKET_KEYS))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        f = fuse.build(_keys(part["digest"]))
        return pd.DataFrame({"bucket": [int(part["bucket"].iloc[0])], "buckets": [buckets], "seed": [f.seed],
                             "segment": [f.segment], "starts": [f.starts], "slots": [f.slots.tobytes()]})

    return digests.withColumn("bucket", _bucket(buckets)).groupBy("bucket").applyInPandas(
        build, "bucket int, buckets int, seed int, segment int, starts int, slots binary")


def screened(digests: DataFrame, filters: DataFrame) -> DataFrame:
    """Digests that a snapshot's filters hold (all that it has, few others)."""
    head = filters.select("buckets").first()
    if head is None:
        return digests.limit(0)

    def screen(incoming: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if len(own) == 0 or len(incoming) == 0:
            return incoming[["digest"]].iloc[:0]
        r = own.iloc[0]
        f = fuse.Fuse(int(r["seed"]), int(r["segment"]), int(r["starts"]), np.frombuffer(r["slots"], np.uint8))
        return incoming.loc[f.holds(_keys(incoming["digest"])), ["digest"]]

    return (digests.withColumn("bucket", _bucket(head[0])).groupBy("bucket")
            .cogroup(filters.groupBy("bucket")).applyInPandas(screen, "digest binary"))
