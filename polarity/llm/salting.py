"""Joins whose keys may be hot."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 8


def salted_join(rows: DataFrame, facts: DataFrame, on: list[str], salt: Column, how: str = "left",
                salts: int = SALTS) -> DataFrame:
    """``rows`` joined to ``facts`` (one row per key) on equal ``on``, nulls
    being equal to nulls.

    The rows of a key are dealt over ``salts`` tasks by ``salt`` (a bigint that
    differs between rows of a key); ``facts`` is repeated for each.
    """
    dealt = rows.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    keys = [F.col(c).alias(f"_on{i}") for i, c in enumerate(on)]
    repeated = facts.select(*keys, *[c for c in facts.columns if c not in on],
                            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_of"))
    equal = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_on{i}")) for i, c in enumerate(on)], F.col("_salt") == F.col("_of"))
    return dealt.join(repeated, equal, how).drop("_salt", "_of", *[f"_on{i}" for i in range(len(on))])
