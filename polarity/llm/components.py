"""Connected components of a link table by large-star / small-star rounds.

Both rounds are a minimum per node (combined before the shuffle) and a join;
no adjacency list of a node is ever gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polarity.llm.tables import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v); root is the least node
    that it reaches.  Loops and repeated links don't matter; no links, no rows."""
    edges = written(_ordered(links.select("u", "v")))
    before = None
    while True:
        # every link (u, v) has v < u
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
        edges = written(_small_star(_large_star(edges)))
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its greater neighbours to its least one (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("n")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return _ordered(both.filter("v > u").join(least, F.col("u") == F.col("n"))
                    .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its lesser neighbours and itself to the least of them."""
    least = edges.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
    lesser = edges.join(least, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _ordered(lesser.unionByName(least.select(F.col("n").alias("u"), F.col("m").alias("v"))))
