"""Mixing sources to target weights (operator 3).

Each document gets a hash-random key; rows are range-sorted by (source, key),
distributed prefix sums count the words before each, and every source is cut
at its budget: whole epochs first, then the documents before the cut once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polarity.llm.prefix import prefix_sums
from polarity.llm.tables import packed, unpacked

# Fixed value: what separates words (space and the ASCII controls 09 to 0D).
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, max_epochs: int = 3, weights: int = 3) -> DataFrame:
    """Word budget of each source: (source, source_size) -> + target.

    Sources in code-point order, null last, weigh 1..``weights`` in turn and
    share the sum of all sizes.  No target exceeds ``max_epochs`` times its
    source; what a capped source can't take goes to the others by weight.
    That level is found in closed form: sources sorted by cap per weight,
    the level is the largest (all - caps before) / (weights from here on).
    One row per source goes through one window.
    """
    place = Window.orderBy(F.col("source").isNull(), "source")
    capped = sizes.select(
        "source", "source_size",
        ((F.row_number().over(place) - 1) % weights + 1).cast("bigint").alias("weight"),
        (F.col("source_size") * max_epochs).alias("cap"))
    up = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything)
              - F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             / F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing)))
    return (capped.withColumn("level", level.cast("double"))
            .withColumn("level", F.max("level").over(everything))
            .select("source", "source_size",
                    F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target")))


def mix(df: DataFrame, seed: str = "mix", carry: list[str] | None = None, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", max_epochs: int = 3) -> DataFrame:
    """``carry`` columns (default: all) plus size, source_size, target, copies and taken.

    size counts the words of the text (null: 0).  copies says how often the
    mix takes the document, taken = copies * size.  The document that holds
    the cut is taken when more than half of it lies before, so a source
    misses its target by half a document at most.  The key is a hash of seed
    and id: reruns and other partitionings agree; repeated ids are told apart
    by size and then by position.  Null ids share the key of the word "null".
    Documents without words have taken 0.  An empty table stays empty.
    Carried columns named like an added one are replaced.
    """
    carry = list(carry or df.columns)
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(df[id_col].cast("string"), F.lit("null"))))
    rows = packed(df, carry, source=df[source_col].cast("string"), key=key,
                  size=F.regexp_count(text, F.lit(WORD)).cast("bigint"))
    ranked = prefix_sums(rows, ["key", "size"], ["size"], ["source"],
                         lambda totals: source_targets(totals.withColumnRenamed("size_total", "source_size"), max_epochs))
    epochs = F.floor(F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)))
    rest = F.col("target") - epochs * F.col("source_size")
    again = (F.col("size_before") * 2 + F.col("size") <= rest * 2) & (rest > 0)
    copies = (epochs + again.cast("bigint")).cast("bigint")
    return unpacked(
        ranked, carry,
        size=F.col("size"), source_size=F.col("source_size"), target=F.col("target"),
        copies=copies, taken=copies * F.col("size"))


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each document as many times as it is taken."""
    return mixed.filter("copies > 0").withColumn(
        "copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*columns)
