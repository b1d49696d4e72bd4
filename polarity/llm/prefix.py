"""Prefix sums and ranks over a whole table without a one-task window.

Rows are range-partitioned on the order, each partition is totalled, the
totals (one row per partition and group) are summed up, and a window inside
each partition adds its rows to what came before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polarity.llm.tables import written


def prefix_sums(df: DataFrame, order: list[str], sums: list[str], group: list[str] | None = None,
                per_group: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Add ``rank`` (from 0) and ``<s>_before`` for every ``s`` in ``sums``.

    ``order`` and ``group`` name columns of ``df``; groups compare null-safe.
    Rows that tie in ``order`` are told apart by their input position, so a
    run of equal rows is spread over partitions like any other.  The ranged
    rows are written once, because the totals and the windows must see the
    very same partitions.  An empty table gives an empty result.

    ``per_group`` may turn the totals of the groups (group, ``<s>_total``) into
    further columns of the group.  They travel with the totals of partitions,
    so rows are not shuffled by a group that may hold a third of them.
    """
    group = list(group or [])
    tie, part = "_tie", "_part"
    placed = written(
        df.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(*[F.col(c) for c in [*group, *order, tie]])
        .withColumn(part, F.spark_partition_id()))
    ahead = Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(part, *group).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(s).alias(f"_s_{s}") for s in sums])
    offsets = totals.withColumnRenamed(part, "_p").select(
        "_p", *[F.col(g).alias(f"_g_{g}") for g in group],
        _total("_n", ahead).alias("_o_n"), *[_total(f"_s_{s}", ahead).alias(f"_o_{s}") for s in sums])
    extra: list[str] = []
    if per_group is not None:
        whole = totals.groupBy(*group).agg(*[F.sum(f"_s_{s}").cast("bigint").alias(f"{s}_total") for s in sums])
        added = per_group(whole)
        extra = [c for c in added.columns if c not in group]
        added = added.select(*[F.col(g).alias(f"_h_{g}") for g in group], *extra)
        own = F.lit(True)
        for g in group:
            own = own & F.col(f"_g_{g}").eqNullSafe(F.col(f"_h_{g}"))
        offsets = offsets.join(added, own).drop(*[f"_h_{g}" for g in group])
    inside = Window.partitionBy(part, *group).orderBy(*order, tie).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.select("*", _total(F.lit(1), inside).alias("_l_n"),
                          *[_total(s, inside).alias(f"_l_{s}") for s in sums])
    same = F.col(part) == F.col("_p")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return local.join(offsets, same).select(
        *[c for c in df.columns], (F.col("_o_n") + F.col("_l_n")).alias("rank"),
        *[(F.col(f"_o_{s}") + F.col(f"_l_{s}")).alias(f"{s}_before") for s in sums], *extra)


def _total(what: str | Column, window) -> Column:
    return F.coalesce(F.sum(what).over(window), F.lit(0)).cast("bigint")
