"""Contiguous shards of near-equal byte size (operator 2).

The table is ordered by id; global byte prefix sums come from per-partition
totals; a row belongs to the shard in which its first byte falls when all
bytes are cut into ``n_shards`` equal stretches.  Only DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polarity.llm.prefix import prefix_sums
from polarity.llm.tables import packed, unpacked


def shard_by_bytes(df: DataFrame, n_shards: int = 16, carry: list[str] | None = None, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``carry`` columns (default: all) plus size, text_crc32, law (``bytes``), shard, slot, grown_shard.

    size is the UTF-8 length of the text (null: 0) plus 1, so empty texts
    count too; text_crc32 of a null text is that of the empty one.  Null ids
    come first.  Ties and repeated rows take consecutive places.  slot counts
    from 0 in each shard without gaps.  grown_shard is null: this law says
    nothing of one more shard.  A text longer than a stretch leaves the
    shards that it covers empty; an empty table gives an empty result.
    Carried columns named like an added one are replaced.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    carry = list(carry or df.columns)
    rows = packed(df, carry, id=df[id_col], size=(F.octet_length(text) + 1).cast("bigint"),
                  crc=F.crc32(text.cast("binary")))
    return _cut(prefix_sums(rows, ["id", "crc", "size"], ["size"]), carry, n_shards)


def _cut(ranked: DataFrame, columns: list[str], n_shards: int) -> DataFrame:
    total = ranked.agg(F.max(F.col("size_before") + F.col("size"))).first()[0] or 1
    wide = F.col("size_before").cast("decimal(38,0)") * F.lit(n_shards)
    cut = ranked.withColumn("shard", F.floor(wide / F.lit(total)).cast("int"))
    # n_shards rows at most
    first = cut.groupBy(F.col("shard").alias("of")).agg(F.min("rank").alias("first"))
    return unpacked(
        cut.join(F.broadcast(first), F.col("shard") == F.col("of")), columns,
        size=F.col("size"), text_crc32=F.col("crc"), law=F.lit("bytes"), shard=F.col("shard"),
        slot=F.col("rank") - F.col("first"), grown_shard=F.lit(None).cast("int"))
